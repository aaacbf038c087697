"""Proceedings of a trademark board as XML in three layouts, read into one set of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registers import read_xml

# The elements and attributes (with _) of the three layouts that are read.
_CODED = "struct<_VALUE:string,_name:string>"
_STAFF = "struct<_VALUE:string,`first-name`:string,`last-name`:string>"
_LINES = ",".join(f"`address-{k}`:string" for k in range(1, 5)) + ",city:string,state:string,country:string,postcode:string"
BULK = f"""number string, `type-code` string, `filing-date` string, `status-code` string, `status-update-date` string, `interlocutory-attorney-name` string, `location-code` string,
`party-information` struct<party:array<struct<identifier:string,`role-code`:string,name:string,orgname:string,`address-information`:struct<`proceeding-address`:struct<name:string,orgname:string,{_LINES}>>,
`property-information`:struct<property:array<struct<identifier:string,`serial-number`:string,`registration-number`:string,`mark-text`:string>>>>>>,
`prosecution-history` struct<`prosecution-entry`:array<struct<identifier:string,code:string,`date`:string,`history-text`:string,`due-date`:string>>>"""
_PARTY = f"""array<struct<_name:string,`_party-id`:string,_role:string,_organization:string,`party-info-from-db`:struct<_VALUE:string,_name:string,_orgname:string>,
`correspondence-info-from-db`:struct<_VALUE:string,_name:string,_orgname:string,_email:string,_phone:string>,
`ttab-properties`:struct<`ttab-property`:array<struct<`serial-number`:string,`registration-number`:string,`mark-explanation`:string,`application-status`:{_CODED}>>>>>"""
RAW = f"""`proceeding-attributes` struct<`proceeding-number`:string,`proceeding-type`:{_CODED},`proceeding-status`:{_CODED},`filing-date`:string,`proceeding-status-date`:string,`interlocutory-attorney`:{_STAFF}>,
`proceeding-parties` struct<plaintiffs:struct<party:{_PARTY}>,defendants:struct<party:{_PARTY}>,applicants:struct<party:{_PARTY}>>,
`prosecution-history` struct<`prosecution-history-event`:array<struct<_VALUE:string,_identifier:string,`_entry-code`:string,`_entry-date`:string,`_event-text`:string,`_due-date`:string>>>"""
_OLD = """array<struct<`party-name`:string,`correspondent-name`:string,property:array<struct<`serial-number`:string,`registration-number`:string,mark:string,status:string>>>>"""
LEGACY = f"""`proceeding-number` string, `proceeding-type` string, `status-text` string, `filing-date` string, `status-date` string, plaintiff {_OLD}, defendant {_OLD}, applicant {_OLD},
`history-entry` array<struct<`entry-number`:string,`history-text`:string,`filing-date`:string,`due-date`:string>>"""
SIDES = {"plaintiffs": "PLAINTIFF", "defendants": "DEFENDANT", "applicants": "APPLICANT"}


def board_date(raw: Column) -> Column:
    """A date written as yyyyMMdd, yyyy-MM-dd or MM/dd/yyyy, null for other texts."""
    bare = F.trim(raw)
    forms = (r"^\d{8}$", "yyyyMMdd"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy")
    return F.coalesce(*[F.when(bare.rlike(form), F.try_to_timestamp(bare, F.lit(pattern)).cast("date")) for form, pattern in forms])


def _text(*places: Column) -> Column:
    return F.coalesce(*[F.when(F.trim(p) != "", F.trim(p)) for p in places], F.lit(""))


def _name(staff: Column) -> Column:
    return _text(F.concat_ws(" ", staff["first-name"], staff["last-name"]), staff["_VALUE"])


def _side(parties: Column, side: str, made) -> Column:
    """The parties of a side as array of struct(side, ordinal, name, party_id, role, organization, correspondent, properties)."""
    shaped = F.transform(parties, lambda p, k: F.struct(F.lit(side).alias("side"), (k + 1).alias("ordinal"), *made(p)))
    return F.coalesce(shaped, F.array().cast(_PARTIES))


_PARTIES = """array<struct<side:string,ordinal:int,name:string,party_id:string,role:string,organization:string,correspondent:string,
properties:array<struct<serial_number:string,registration_number:string,mark:string,status:string>>>>"""
_DOCKET = "array<struct<identifier:string,code:string,filed:string,text:string,due:string>>"


def _properties(properties: Column, mark: str, status) -> Column:
    number = lambda c: F.regexp_replace(_text(c), " ", "")
    shaped = F.transform(properties, lambda p: F.struct(number(p["serial-number"]).alias("serial_number"), number(p["registration-number"]).alias("registration_number"), _text(p[mark]).alias("mark"), status(p).alias("status")))
    return F.coalesce(shaped, F.array().cast("array<struct<serial_number:string,registration_number:string,mark:string,status:string>>")).alias("properties")


def _entries(entries: Column, fields: tuple[str, str, str, str, str]) -> Column:
    names = ("identifier", "code", "filed", "text", "due")
    shaped = F.transform(entries, lambda e: F.struct(*[(_text(e[f]) if f else F.lit("")).alias(n) for f, n in zip(fields, names, strict=True)]))
    return F.coalesce(shaped, F.array().cast(_DOCKET)).alias("docket")


def _bulk(rows: DataFrame) -> DataFrame:
    def party(p: Column) -> list[Column]:
        address = p["address-information"]["proceeding-address"]
        return [
            _text(p["name"]).alias("name"), _text(p["identifier"]).alias("party_id"), _text(p["role-code"]).alias("role"), _text(p["orgname"]).alias("organization"), _text(address["name"]).alias("correspondent"),
            _properties(p["property-information"]["property"], "mark-text", lambda _: F.lit("")),
        ]

    parties = _side(F.col("`party-information`.party"), "OTHER", party)
    # role codes are kept as they are: they become the side without a reading of their meaning
    sided = F.transform(parties, lambda p: p.withField("side", F.when(p["role"] != "", F.concat(F.lit("ROLE_"), p["role"])).otherwise("OTHER")))
    return rows.select(
        F.col("number"), F.lit("").alias("type"), F.col("type-code").alias("type_code"), F.lit("").alias("status"), F.col("status-code").alias("status_code"), F.col("filing-date").alias("filed"),
        F.col("status-update-date").alias("status_on"), F.col("interlocutory-attorney-name").alias("attorney"), sided.alias("parties"), _entries(F.col("`prosecution-history`.`prosecution-entry`"), ("identifier", "code", "date", "history-text", "due-date")),
    )


def _raw(rows: DataFrame) -> DataFrame:
    def party(p: Column) -> list[Column]:
        own = p["party-info-from-db"]
        return [
            _text(p["_name"], own["_name"], own["_orgname"]).alias("name"), _text(p["_party-id"]).alias("party_id"), _text(p["_role"]).alias("role"), _text(p["_organization"], own["_orgname"]).alias("organization"),
            _text(p["correspondence-info-from-db"]["_name"]).alias("correspondent"), _properties(p["ttab-properties"]["ttab-property"], "mark-explanation", lambda x: _text(x["application-status"]["_name"], x["application-status"]["_VALUE"])),
        ]

    head = F.col("proceeding-attributes")
    sides = [_side(F.col(f"`proceeding-parties`.{s}.party"), side, party) for s, side in SIDES.items()]
    return rows.select(
        head["proceeding-number"].alias("number"), _text(head["proceeding-type"]["_name"], head["proceeding-type"]["_VALUE"]).alias("type"), head["proceeding-type"]["_VALUE"].alias("type_code"),
        _text(head["proceeding-status"]["_name"], head["proceeding-status"]["_VALUE"]).alias("status"), head["proceeding-status"]["_VALUE"].alias("status_code"), head["filing-date"].alias("filed"), head["proceeding-status-date"].alias("status_on"),
        _name(head["interlocutory-attorney"]).alias("attorney"), F.concat(*sides).alias("parties"), _entries(F.col("`prosecution-history`.`prosecution-history-event`"), ("_identifier", "_entry-code", "_entry-date", "_event-text", "_due-date")),
    )


def _legacy(rows: DataFrame) -> DataFrame:
    def party(p: Column) -> list[Column]:
        none = F.lit("")
        return [_text(p["party-name"]).alias("name"), none.alias("party_id"), none.alias("role"), none.alias("organization"), _text(p["correspondent-name"]).alias("correspondent"), _properties(p["property"], "mark", lambda x: _text(x["status"]))]

    sides = [_side(F.filter(F.col(s.removesuffix("s")), lambda p: F.trim(p["party-name"]) != ""), side, party) for s, side in SIDES.items()]
    return rows.select(
        F.col("proceeding-number").alias("number"), F.col("proceeding-type").alias("type"), F.lit("").alias("type_code"), F.col("status-text").alias("status"), F.lit("").alias("status_code"), F.col("filing-date").alias("filed"),
        F.col("status-date").alias("status_on"), F.lit("").alias("attorney"), F.concat(*sides).alias("parties"), _entries(F.col("history-entry"), ("entry-number", None, "filing-date", "history-text", "due-date")),
    )


LAYOUTS = {"proceeding-entry": (BULK, _bulk), "proceeding": (RAW, _raw), "proceeding-record": (LEGACY, _legacy)}


def read_proceedings(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """proceeding, party, property and docket of XML files in any of the three layouts, keyed by number.

    Numbers are six to eight digits; other elements are left out. Of elements with one number the first of the
    first file counts. Codes stay codes.
    """
    parts = []
    for k, (tag, (schema, shape)) in enumerate(LAYOUTS.items()):
        order = F.struct(F.input_file_name().alias("file"), F.lit(k).alias("layout"), F.monotonically_increasing_id().alias("place"))
        parts.append(shape(read_xml(spark, path, tag, schema)).withColumn("order", order))
    rows = reduce(DataFrame.unionByName, parts).withColumn("number", F.regexp_replace("number", r"\s", "")).where(F.col("number").rlike(r"^\d{6,8}$"))
    kept = [c for c in rows.columns if c not in ("number", "order")]
    first = rows.groupBy("number").agg(F.min_by(F.struct(*kept), "order").alias("r")).select("number", *[F.col(f"r.{c}").alias(c) for c in kept])
    party = first.select("number", F.explode("parties").alias("p")).select("number", "p.*")
    property_ = party.select("number", "side", F.col("ordinal").alias("party_ordinal"), F.posexplode("properties").alias("k", "x")).select("number", "side", "party_ordinal", (F.col("k") + 1).alias("ordinal"), "x.*")
    docket = first.select("number", F.posexplode("docket").alias("k", "e")).select("number", (F.col("k") + 1).alias("ordinal"), "e.*")
    return {
        "proceeding": first.drop("parties", "docket").withColumns({"filing_date": board_date(F.col("filed")), "status_date": board_date(F.col("status_on"))}),
        "party": party.drop("properties"),
        "property": property_,
        "docket": docket.withColumns({"filing_date": board_date(F.col("filed")), "due_date": board_date(F.col("due"))}),
    }


def proceeding_snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    """(number, type_code, status_code, status_date, parties, properties, entries, last_entry, next_due): a row per proceeding."""
    entries = tables["docket"].groupBy("number").agg(F.count("*").alias("entries"), F.max(F.struct("filing_date", "ordinal"))["filing_date"].alias("last_entry"), F.max("due_date").alias("next_due"))
    counts = [tables[n].groupBy("number").agg(F.count("*").alias(c)) for n, c in (("party", "parties"), ("property", "properties"))]
    rows = reduce(lambda df, right: df.join(right, "number", "left"), [*counts, entries], tables["proceeding"].select("number", "type_code", "status_code", "status_date"))
    return rows.fillna(0, ["parties", "properties", "entries"])


def proceedings_of(tables: dict[str, DataFrame], serials: DataFrame, serial: str = "serial_number") -> DataFrame:
    """(serial, number, side): the proceedings in which a serial number stands, each once."""
    held = tables["property"].where("serial_number <> ''").select(F.col("serial_number").alias(serial), "number", "side")
    return held.join(serials.select(serial).distinct(), serial, "left_semi").groupBy(serial, "number").agg(F.min("side").alias("side"))
