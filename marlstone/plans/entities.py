"""Queries of entities, items and countries over the domain tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import countries, text
from ..operators import dedupe, items, summaries, versioning
from ..session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def put(build):
        QUERIES[build.__name__], ORACLE[build.__name__] = build, sql
        return build

    return put


def _case(value: str, pairs, default: str = "''") -> str:
    return f"CASE {' '.join(f'WHEN {test} THEN {out}' for test, out in pairs)} ELSE {default} END" if not value else f"CASE {value} {' '.join(f'WHEN {test} THEN {out}' for test, out in pairs)} ELSE {default} END"


_PLAIN = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9一-鿿]+', '', 'g')"
_REACH = """reach(node, root) AS (SELECT a, a FROM edge UNION SELECT b, b FROM edge UNION
  SELECT e.b, r.root FROM reach r JOIN (SELECT a, b FROM edge UNION SELECT b, a FROM edge) e ON e.a = r.node),
part AS (SELECT node AS id, min(root) AS component FROM reach GROUP BY 1)"""
_COMPANIES = f"""WITH RECURSIVE member AS (
  SELECT lower(observation_id) AS id, {_PLAIN.format("company_name")} AS name, {_PLAIN.format("registered_address")} AS address, upper(trim(coalesce(unified_social_credit_code, ''))) AS code, row_id
  FROM cn_qcc_company_observation QUALIFY row_number() OVER (PARTITION BY lower(observation_id) ORDER BY row_id) = 1),
channel AS (
  SELECT m.id, kind, value FROM member m JOIN (
    SELECT row_id, 'PHONE' AS kind, lower(trim(phones)) AS value FROM cn_qcc_company_observation UNION ALL SELECT row_id, 'EMAIL', lower(trim(emails)) FROM cn_qcc_company_observation) USING (row_id)
  WHERE value <> ''),"""


def _companies(spark, d):
    rows = table(spark, d, "cn_qcc_company_observation").select(
        F.lower("observation_id").alias("id"), "row_id", "entity_id", "contact_name", text.match_text(F.col("company_name")).alias("name"), text.match_text(F.col("registered_address")).alias("address"),
        F.upper(F.trim(F.coalesce("unified_social_credit_code", F.lit("")))).alias("code"), F.lower(F.trim("phones")).alias("phone"), F.lower(F.trim("emails")).alias("email"),
    )
    rows = versioning.first_by(rows, ["id"], ["row_id"], [c for c in rows.columns if c != "id"])
    channels = rows.select("id", F.explode(F.array(F.struct(F.lit("PHONE").alias("kind"), F.col("phone").alias("value")), F.struct(F.lit("EMAIL").alias("kind"), F.col("email").alias("value")))).alias("c")).select("id", "c.kind", "c.value")
    return rows, channels


@query(f"""{_COMPANIES}
edge AS (
  SELECT min(id) OVER (PARTITION BY name, address) AS a, id AS b, 'EXACT_NAME_ADDRESS' AS evidence FROM member WHERE name <> '' AND length(address) >= 6
  UNION SELECT min(c.id) OVER (PARTITION BY name, kind, value), c.id, 'EXACT_NAME_CHANNEL' FROM channel c JOIN member m ON m.id = c.id WHERE name <> ''),
{_REACH},
judged AS (SELECT component, arg_max(id, (code <> '', id)) AS canonical, count(DISTINCT nullif(code, '')) > 1 AS conflict, count(*) AS n FROM member JOIN part USING (id) GROUP BY 1 HAVING count(*) > 1),
why AS (SELECT component, array_to_string(list_sort(list(DISTINCT evidence)), ',') AS evidence FROM edge JOIN part ON part.id = edge.a WHERE a <> b GROUP BY 1)
SELECT canonical, id AS duplicate, CASE WHEN conflict THEN 'BLOCKED' ELSE 'CANDIDATE' END AS status, CASE WHEN conflict THEN 'STRONG_IDENTIFIER_CONFLICT' ELSE '' END AS reasons, evidence
FROM part JOIN judged USING (component) JOIN why USING (component) WHERE id <> canonical""")
def entity_dedupe(spark, d):
    """B-54: companies of one name that share an address or a channel; different credit codes block the merge."""
    rows, channels = _companies(spark, d)
    edges = dedupe.entity_edges(rows.select("id", "name", "address"), channels)
    members = rows.select("id", "code", (F.col("code") != "").alias("coded"))
    out = dedupe.merge_decisions(members, edges, {"STRONG_IDENTIFIER_CONFLICT": dedupe.several(F.col("code"))}, ["coded"])
    return out.select("canonical", "duplicate", "status", F.array_join("reasons", ",").alias("reasons"), F.array_join("evidence", ",").alias("evidence"))


@query(f"""{_COMPANIES}
person AS (SELECT m.id, lower(entity_id) AS entity, lower(trim(contact_name)) AS name FROM member m JOIN cn_qcc_company_observation USING (row_id) WHERE trim(contact_name) <> ''),
edge AS (SELECT min(c.id) OVER (PARTITION BY entity, name, kind, value) AS a, c.id AS b FROM channel c JOIN person p ON p.id = c.id WHERE entity IS NOT NULL),
{_REACH},
judged AS (SELECT component, max(id) AS canonical FROM part GROUP BY 1 HAVING count(*) > 1)
SELECT canonical, id AS duplicate, 'CANDIDATE' AS status FROM part JOIN judged USING (component) WHERE id <> canonical""")
def person_dedupe(spark, d):
    """B-55: contacts of one company and name that share a channel."""
    rows, channels = _companies(spark, d)
    persons = rows.select("id", F.lower("entity_id").alias("entity"), F.lower(F.trim("contact_name")).alias("name")).where("entity is not null")
    out = dedupe.merge_decisions(persons, dedupe.person_edges(persons, channels), {}, [])
    return out.select("canonical", "duplicate", "status")


_CUT = "2025-01-01"
_ITEM = "sha256(coalesce(event_code, '') || '|' || coalesce(event_date::varchar, '') || '|' || coalesce(description_text, ''))"
_SIDE = f"""WITH v AS (SELECT event_key, source_rank, row_id, event_type_code AS status, source_package_id AS source, {_ITEM} AS content, observed_at >= TIMESTAMP '{_CUT}' AS late FROM us_event_history),
b AS (SELECT * FROM v WHERE NOT late QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY source_rank DESC, row_id DESC) = 1),
i AS (SELECT * FROM v WHERE late QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY source_rank DESC, row_id DESC) = 1),
x AS (SELECT event_key, b.event_key IS NOT NULL AS hb, i.event_key IS NOT NULL AS hi, b.source_rank AS br, i.source_rank AS ir, b.status AS bs, i.status AS iss, b.content AS bc, i.content AS ic, b.source AS bsrc, i.source AS isrc FROM b FULL JOIN i USING (event_key))"""


def _deliveries(spark, d):
    content = F.sha2(F.concat_ws("|", F.coalesce("event_code", F.lit("")), F.coalesce(F.col("event_date").cast("string"), F.lit("")), F.coalesce("description_text", F.lit(""))), 256)
    rows = table(spark, d, "us_event_history").select("event_key", "source_rank", "row_id", F.col("event_type_code").alias("status"), F.col("source_package_id").alias("source"), content.alias("content"), "observed_at")
    late = F.col("observed_at") >= F.expr(f"timestamp_ntz'{_CUT} 00:00:00'")
    latest = lambda part: versioning.latest_by(part, ["event_key"], ["source_rank", "row_id"]).drop("row_id", "observed_at")
    return latest(rows.where(~late)), latest(rows.where(late))


@query(_SIDE + """ SELECT event_key, ir AS source_rank, bs AS before, iss AS after, CASE WHEN NOT hb THEN 'FIRST_OBSERVED' WHEN bs IS DISTINCT FROM iss THEN 'STATUS_CHANGED' ELSE 'ITEM_DETAILS_CHANGED' END AS kind
FROM x WHERE hi AND (NOT hb OR (br <= ir AND (bs IS DISTINCT FROM iss OR bc IS DISTINCT FROM ic)))""")
def item_observations(spark, d):
    """B-9: what a later delivery says of each item."""
    current, incoming = _deliveries(spark, d)
    return items.item_observations(current, incoming, ["event_key"], "source_rank", "status", "content")


@query(_SIDE + """ SELECT event_key, CASE WHEN NOT hb OR (hi AND ir >= br) THEN ir ELSE br END AS source_rank, CASE WHEN NOT hb OR (hi AND ir >= br) THEN ic ELSE bc END AS content, CASE WHEN hb THEN bsrc ELSE isrc END AS first_source FROM x""")
def item_current(spark, d):
    """B-10: current items after a later delivery, the first source kept."""
    current, incoming = _deliveries(spark, d)
    return items.upserted_items(current.withColumn("first_source", F.col("source")), incoming, ["event_key"], "source_rank", "source").select("event_key", "source_rank", "content", "first_source")


@query(_SIDE + """ SELECT count(*) FILTER (hb) AS before, count(*) FILTER (hi) AS delivered, count(*) AS after, count(*) FILTER (hi AND NOT hb) AS added, count(*) FILTER (hi AND hb AND bc IS DISTINCT FROM ic) AS changed,
count(*) FILTER (hi AND hb AND bc IS NOT DISTINCT FROM ic) AS unchanged, count(*) FILTER (hb AND NOT hi) AS preserved, 0 AS lost FROM x""")
def delivery_reconciliation(spark, d):
    """Q-4: key coverage, transitions and preserved omissions of a delivery."""
    current, incoming = _deliveries(spark, d)
    after = items.upserted_items(current.withColumn("first_source", F.col("source")), incoming, ["event_key"], "source_rank", "source")
    return items.reconciled(current, incoming, after, ["event_key"], "content")


@query("""WITH e AS (SELECT serial_number, event_code, event_date, event_sequence, event_key FROM us_event_history),
m AS (SELECT *, rank() OVER (PARTITION BY serial_number, event_code ORDER BY event_date DESC NULLS LAST, event_sequence DESC NULLS LAST) AS r FROM e)
SELECT serial_number, event_code, any_value(event_date)::varchar AS event_date, any_value(event_sequence) AS event_sequence, max(event_key) AS event_key, count(DISTINCT event_key) AS contents FROM m WHERE r = 1 GROUP BY 1, 2""")
def filing_compaction(spark, d):
    """B-21, B-6: one filing per identity: the latest date, then the highest entry; how many contents compete."""
    rows = table(spark, d, "us_event_history").select("serial_number", "event_code", "event_date", "event_sequence", "event_key")
    coded = rows.withColumns({"serial_number": F.coalesce("serial_number", F.lit("")), "event_code": F.coalesce("event_code", F.lit(""))})
    out = items.compacted(coded, ["serial_number", "event_code"], ["event_date", "event_sequence"], strict=False)
    return out.select(F.nullif("serial_number", F.lit("")).alias("serial_number"), F.nullif("event_code", F.lit("")).alias("event_code"), F.col("event_date").cast("string").alias("event_date"), "event_sequence", "event_key", "contents")


@query("""WITH o AS (SELECT *, sha256(coalesce(party_type, '') || '|' || coalesce(party_name_norm, '') || '|' || coalesce(nationality_country, '')) AS h, trim(regexp_replace(party_name, '\\s+', ' ', 'g')) AS n FROM us_owner_current WHERE coalesce(is_deleted, 0) = 0)
SELECT serial_number, count(*) AS members, sha256(string_agg(h, '|' ORDER BY h)) AS set_hash, coalesce(array_to_string(list_sort(list(DISTINCT n) FILTER (n <> '')), '; '), '') AS names FROM o GROUP BY 1""")
def owner_fingerprints(spark, d):
    """B-24: the owners of each case as an order-free hash and their names."""
    rows = table(spark, d, "us_owner_current").where("coalesce(is_deleted, 0) = 0")
    return items.set_fingerprints(rows, ["serial_number"], [F.col("party_type"), F.col("party_name_norm"), F.col("nationality_country")], F.col("party_name"))


@query("""SELECT owner_key, coalesce(arg_max(trim(party_name), (source_rank, row_id, trim(party_name))) FILTER (trim(party_name) <> ''), owner_key) AS display, count(*) FILTER (trim(party_name) <> '') > 0 AS named FROM us_owner_current GROUP BY 1""")
def names_or_codes(spark, d):
    """R-11: the latest known name of each owner, else its key."""
    rows = table(spark, d, "us_owner_current").select("owner_key", F.col("owner_key").alias("code"), "party_name", F.coalesce("source_rank", F.lit(-1)).alias("source_rank"), "row_id")
    return items.named_or_code(rows, ["owner_key"], "party_name", "code", ["source_rank", "row_id"])


@query("""WITH o AS (SELECT serial_number, city, state FROM us_owner_current QUALIFY row_number() OVER (PARTITION BY serial_number ORDER BY source_rank, row_id) = 1),
n AS (SELECT serial_number, nullif(trim(city), '') AS city, nullif(trim(state), '') AS state FROM us_owner_current QUALIFY row_number() OVER (PARTITION BY serial_number ORDER BY source_rank DESC, row_id DESC) = 1)
SELECT serial_number, coalesce(n.city, o.city) AS city, coalesce(n.state, o.state) AS state FROM o JOIN n USING (serial_number)""")
def record_overlay(spark, d):
    """C-9: a case's latest owner row over its first one, field by field."""
    rows = table(spark, d, "us_owner_current").select("serial_number", "city", "state", "source_rank", "row_id").where("serial_number is not null")
    first = versioning.first_by(rows, ["serial_number"], ["source_rank", "row_id"], ["city", "state"])
    known = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    last = versioning.latest_by(rows, ["serial_number"], ["source_rank", "row_id"]).select("serial_number", known("city"), known("state"))
    return items.overlaid(first.select("serial_number", "city", "state"), last, ["serial_number"], ["city", "state"])


_ALIAS = _case(_PLAIN.format("country"), [(f"'{n}'", f"'{c}'") for c, names in countries.ALIASES.items() for n in names.split()], "CASE WHEN regexp_full_match(upper(trim(country)), '[A-Z]{2}') THEN upper(trim(country)) ELSE '' END")


@query(f"SELECT {_ALIAS} AS country_code, count(*) AS owners FROM us_owner_current GROUP BY 1")
def owners_by_country_code(spark, d):
    """F-10: owners by the code of the country as written."""
    return table(spark, d, "us_owner_current").groupBy(countries.country_code(F.col("country")).alias("country_code")).agg(F.count("*").alias("owners"))


_ADDRESS = "trim(coalesce(raw_address, ''))"
_TERMS = [(name, name, code) for name, code in countries.REGIONS.items()] + [(short, name, code) for short, (name, code) in countries.SHORT_REGIONS.items()]
_HAS = [(f"contains(a, '{t}')", f"'{c}'") for t, c in countries.SPECIAL.items()]
_ABROAD = [(f"contains(a, '{t}')", f"'{c}'") for t, c in countries.FOREIGN.items()]
_QUOTED = ", ".join(f"'{m}'" for m in countries.MUNICIPALITIES)


@query(f"""WITH r AS (SELECT row_id, {_ADDRESS} AS a FROM cn_stage_applicant),
p AS (SELECT *, {_case("", _HAS)} AS special, {_case("", _ABROAD)} AS abroad, {_case("", [(f"contains(a, '{t}')", f"'{n}'") for t, n, _ in _TERMS])} AS name, {_case("", [(f"contains(a, '{t}')", f"'{c}'") for t, _, c in _TERMS])} AS code, regexp_extract(a, '{countries.CITY}', 1) AS m FROM r)
SELECT row_id, CASE WHEN special <> '' THEN special WHEN abroad <> '' THEN abroad WHEN a <> '' THEN 'CN' ELSE '' END AS country, CASE WHEN special <> '' OR abroad <> '' THEN '' ELSE code END AS region,
CASE WHEN special <> '' THEN {_case("", [(f"contains(a, '{t}')", f"'{t}'") for t in countries.SPECIAL])} WHEN abroad <> '' OR a = '' THEN '' WHEN name IN ({_QUOTED}) THEN name WHEN m IN ({", ".join(f"'{n}'" for n in countries.REGIONS)}) THEN '' ELSE m END AS city,
CASE WHEN special <> '' THEN 0.95 WHEN abroad <> '' THEN 0.9 WHEN a = '' THEN 0.0 WHEN name IN ({_QUOTED}) THEN 0.95 WHEN code <> '' THEN 0.85 ELSE 0.6 END::double AS confidence FROM p""")
def geo_inference(spark, d):
    """F-6: country, region and city of each address, with a confidence."""
    rows = table(spark, d, "cn_stage_applicant").select("row_id", countries.infer_geo(F.col("raw_address")).alias("g"))
    return rows.select("row_id", "g.country", "g.region", "g.city", F.col("g.confidence").cast("double").alias("confidence"))


_PHONE = "regexp_extract(coalesce(phones, ''), '^\\s*(?:\\+|00)\\s*(" + "|".join(countries.CALLING) + ")', 1)"
_HOST = "regexp_extract(lower(trim(coalesce(websites, ''))), '^(?:[a-z]+://)?(?:[^/@\\s]*@)?(?:www\\.)?([a-z0-9\\-]+(?:\\.[a-z0-9\\-]+)+)', 1)"


@query(f"""WITH e AS (
  SELECT lower(observation_id) AS id, {_case(_PHONE, [(f"'{k}'", f"'{c}'") for k, c in countries.CALLING.items()])} AS country, 0.7 AS w FROM cn_qcc_company_observation
  UNION ALL SELECT lower(observation_id), CASE regexp_extract({_HOST}, '\\.([a-z]{{2}})$', 1) WHEN 'uk' THEN 'GB' ELSE upper(regexp_extract({_HOST}, '\\.([a-z]{{2}})$', 1)) END, 0.6 FROM cn_qcc_company_observation
  UNION ALL SELECT lower(observation_id), CASE WHEN regexp_matches(company_name, '[一-鿿]') THEN 'CN' ELSE '' END, 0.5 FROM cn_qcc_company_observation),
k AS (SELECT id, country, w FROM e WHERE country <> '' GROUP BY ALL),
s AS (SELECT id, country, round(1 - product(1 - w), 4) AS score FROM k GROUP BY 1, 2)
SELECT id, country, score, score >= 0.8 AND count(*) OVER (PARTITION BY id) = 1 AS accepted FROM s""")
def country_evidence(spark, d):
    """B-56, F-11: countries of companies from number, host and script by noisy-OR; accepted where one is sure and alone."""
    rows = table(spark, d, "cn_qcc_company_observation").select(
        F.lower("observation_id").alias("id"),
        F.array(
            F.struct(countries.country_of_phone(F.col("phones")).alias("country"), F.lit(0.7).alias("w")),
            F.struct(countries.country_of_host(text.website_host(F.col("websites"))).alias("country"), F.lit(0.6).alias("w")),
            F.struct(F.when(F.col("company_name").rlike("[一-鿿]"), "CN").otherwise("").alias("country"), F.lit(0.5).alias("w")),
        ).alias("e"),
    )
    known = rows.select("id", F.explode("e").alias("e")).select("id", "e.country", "e.w").where("country <> ''").distinct()
    scored = known.groupBy("id", "country").agg(F.round(summaries.noisy_or(F.col("w")), 4).alias("score"))
    alone = scored.groupBy("id").agg(F.count("*").alias("n"))
    return scored.join(alone, "id").select("id", "country", "score", ((F.col("score") >= 0.8) & (F.col("n") == 1)).alias("accepted"))


_SIGNAL = "regexp_matches(regexp_replace(regexp_replace(coalesce(raw_name, ''), '[\\s　，,。.;；]+$', ''), '[\\s　]', '', 'g'), '(?:" + "|".join(text.COMPANY_ENDS) + ")$') OR regexp_matches(regexp_replace(coalesce(raw_name, ''), '[\\s　，,。.;；]+$', ''), '" + text.COMPANY_WORDS + "')"


@query(f"SELECT coalesce(country_code, '') AS country_code, count(*) AS applicants, count(*) FILTER ({_SIGNAL}) AS companies FROM cn_stage_applicant GROUP BY 1")
def company_signals(spark, d):
    """F-13: applicants with the name of a company, by country."""
    rows = table(spark, d, "cn_stage_applicant").select(F.coalesce("country_code", F.lit("")).alias("country_code"), text.company_signal(F.col("raw_name")).alias("signal"))
    return rows.groupBy("country_code").agg(F.count("*").alias("applicants"), F.count_if("signal").alias("companies"))


_PROFILED = ("party_name", "address_1", "city", "state", "country", "nationality_country")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (trim({c}) <> '') AS filled, count(*) FILTER (trim({c}) = '') AS blank, count(*) FILTER ({c} IS NULL) AS missing, min({c}) FILTER (trim({c}) <> '') AS least, max({c}) FILTER (trim({c}) <> '') AS greatest FROM us_owner_current" for c in _PROFILED))
def owner_profile(spark, d):
    """Q-9: how the columns of the owners are filled."""
    return summaries.profile(table(spark, d, "us_owner_current"), _PROFILED)
