"""Layouts of the registers: columns of the delimited roles, nested schemas of the XML registers, and their readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archives import read_lines
from .records import logical_records, repaired_columns
from .registers import children, first_of, read_xml


@dataclass(frozen=True)
class Role:
    """marker: part of the member's name; columns in order; variable: the one that may hold stray delimiters; start: how a record begins."""

    marker: str
    columns: tuple[str, ...]
    variable: str
    start: str


_NUMBER = r"^\"?G?\d{3,}[A-Z]*\"?"
_CLASS = _NUMBER + r"[,\t]\"?\d{1,2}\"?"
# Roles of the members of a package and their columns.
ROLES = {
    "basic": Role(
        "注册商标基本信息",
        tuple(
            "application_number class_no filing_date mark_name mark_type_raw agent_code prelim_pub_issue prelim_pub_date registration_pub_issue registration_pub_date exclusive_start_date "
            "exclusive_end_date exclusive_period design_description color_description exclusive_rights_disclaimer is_3d_mark is_co_application mark_form_raw geo_indication_info color_mark_flag is_well_known_mark".split()
        ),
        "design_description",
        _CLASS + r"[,\t]\"?\d{4}",
    ),
    "applicant": Role("商标注册人信息", ("application_number", "class_no", "owner_name_cn", "owner_name_foreign", "owner_address_cn", "owner_address_foreign"), "owner_address_cn", _CLASS),
    "goods": Role("商标商品服务信息", ("application_number", "class_no", "similar_group", "goods_sequence", "goods_name", "goods_status_raw"), "goods_name", _CLASS),
    "coowner": Role("商标共有人信息", ("application_number", "coowner_name_cn", "coowner_name_foreign", "coowner_address_cn", "coowner_address_foreign"), "coowner_address_cn", _NUMBER),
    "priority": Role("商标优先权信息", ("application_number", "class_no", "priority_number", "priority_type", "priority_date", "priority_goods", "priority_country_region"), "priority_number", _CLASS),
    "agent": Role("商标代理人信息", ("agent_code", "agent_name"), "agent_name", r"^.+"),
}

# The elements of a case and of an assignment that are read.
CASE = """`serial-number` string, `transaction-date` string, `registration-number` string,
`case-file-header` struct<`filing-date`:string,`registration-date`:string,`status-code`:string,`status-date`:string,`mark-identification`:string,`attorney-name`:string,`attorney-docket-number`:string,`domestic-representative-name`:string>,
`case-file-owners` struct<`case-file-owner`:array<struct<`entry-number`:string,`party-type`:string,`party-name`:string,`address-1`:string,city:string,state:string,country:string>>>,
classifications struct<classification:array<struct<`primary-code`:string,`status-code`:string,`status-date`:string>>>,
`case-file-event-statements` struct<`case-file-event-statement`:array<struct<code:string,`date`:string,number:string,type:string,`description-text`:string>>>,
`case-file-statements` struct<`case-file-statement`:array<struct<`type-code`:string,text:string>>>,
correspondent struct<`address-1`:string,`address-2`:string,`address-3`:string,`address-4`:string,`address-5`:string>,
`design-searches` struct<`design-search`:array<struct<code:string>>>,
`prior-registration-applications` struct<`prior-registration-application`:array<struct<`relationship-type`:string,number:string>>>,
`foreign-applications` struct<`foreign-application`:array<struct<`entry-number`:string,`application-number`:string,country:string,`filing-date`:string,`foreign-priority-claim-in`:string>>>,
`madrid-international-filing-requests` struct<`madrid-international-filing-record`:array<struct<`entry-number`:string,`reference-number`:string,`original-filing-date-uspto`:string,
`international-registration-number`:string,`international-registration-date`:string,`international-status-code`:string,`international-status-date`:string,`international-renewal-date`:string,
`madrid-history-events`:struct<`madrid-history-event`:array<struct<`entry-number`:string,code:string,`date`:string,`description-text`:string>>>>>>"""
ASSIGNMENT = """assignment struct<`reel-no`:string,`frame-no`:string,`date-recorded`:string,`conveyance-text`:string>,
assignors struct<assignor:array<struct<`person-or-organization-name`:string,`execution-date`:string>>>, assignees struct<assignee:array<struct<`person-or-organization-name`:string,city:string,state:string>>>,
properties struct<property:array<struct<`serial-no`:string,`registration-no`:string>>>"""


def read_role(spark: SparkSession, folder: str, role: str, pattern: str = "*.zip", encoding: str | None = None, delimiter: str = ",") -> DataFrame:
    """The records of a role in all archives of a folder, with their lines and repair."""
    layout = ROLES[role]
    lines = read_lines(spark, folder, pattern, encoding, tuple(r.marker for r in ROLES.values())).where(F.contains("member", F.lit(layout.marker)))
    records = logical_records(lines, (F.col("line_no") > 1) & F.col("line").rlike(layout.start)).where("record > 0")
    return repaired_columns(records, "text", layout.columns, layout.variable, delimiter)


def read_cases(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Cases of an application register as tables: case, owner, classification, event, statement, correspondent, design,
    prior_registration, foreign_application, madrid_filing, madrid_event."""
    rows = read_xml(spark, path, "case-file", CASE)
    head = rows.withColumn("serial", first_of(rows, "serial-number")).where("serial is not null")
    fields = {f"{name.replace('-', '_')}": first_of(head, f"case-file-header.{name}") for name in ("filing-date", "registration-date", "status-code", "status-date", "mark-identification", "attorney-name")}
    kids = {
        "owner": ("`case-file-owners`.`case-file-owner`", ["entry-number", "party-type", "party-name", "address-1", "city", "state", "country"]),
        "classification": ("classifications.classification", ["primary-code", "status-code", "status-date"]),
        "event": ("`case-file-event-statements`.`case-file-event-statement`", ["code", "date", "number", "type", "description-text"]),
        "statement": ("`case-file-statements`.`case-file-statement`", ["type-code", "text"]),
        "design": ("`design-searches`.`design-search`", ["code"]),
        "prior_registration": ("`prior-registration-applications`.`prior-registration-application`", ["relationship-type", "number"]),
        "foreign_application": ("`foreign-applications`.`foreign-application`", ["entry-number", "application-number", "country", "filing-date", "foreign-priority-claim-in"]),
        "madrid_filing": (f"{_MADRID}", [*_FILING]),
    }
    case = head.select("serial", first_of(head, "transaction-date").alias("transaction_date"), first_of(head, "registration-number").alias("registration_number"), *[c.alias(n) for n, c in fields.items()])
    lines = [f"address-{k}" for k in range(1, 6)]
    spoken_for = ["attorney-name", "attorney-docket-number", "domestic-representative-name"]
    named = {n.replace("-", "_"): first_of(head, f"correspondent.{n}") for n in lines} | {n.replace("-", "_"): first_of(head, f"case-file-header.{n}") for n in spoken_for}
    correspondent = head.select("serial", *[c.alias(n) for n, c in named.items()]).where(F.coalesce(*named).isNotNull())
    filings = head.select("serial", F.explode(F.col(_MADRID)).alias("f"))
    events = filings.select("serial", F.col("f.`entry-number`").alias("filing_entry_number"), F.col("f.`reference-number`").alias("filing_reference_number"), F.explode("f.`madrid-history-events`.`madrid-history-event`").alias("e"))
    madrid_event = events.select("serial", "filing_entry_number", "filing_reference_number", *[F.col(f"e.`{n}`").alias(n.replace("-", "_")) for n in ("entry-number", "code", "date", "description-text")])
    tables = {name: children(head, ["serial"], path_, names) for name, (path_, names) in kids.items()}
    return {"case": case, **tables, "correspondent": correspondent, "madrid_event": madrid_event}


_MADRID = "`madrid-international-filing-requests`.`madrid-international-filing-record`"
_FILING = (
    "entry-number", "reference-number", "original-filing-date-uspto", "international-registration-number", "international-registration-date", "international-status-code", "international-status-date", "international-renewal-date",
)


def read_assignments(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Recorded assignments as tables: record, assignor, assignee, property, keyed by reel and frame."""
    rows = read_xml(spark, path, "assignment-entry", ASSIGNMENT)
    head = rows.withColumn("reel", first_of(rows, "assignment.reel-no")).withColumn("frame", first_of(rows, "assignment.frame-no"))
    record = head.select("reel", "frame", first_of(head, "assignment.date-recorded").alias("date_recorded"), first_of(head, "assignment.conveyance-text").alias("conveyance_text"))
    return {
        "record": record,
        "assignor": children(head, ["reel", "frame"], "assignors.assignor", ["person-or-organization-name", "execution-date"]),
        "assignee": children(head, ["reel", "frame"], "assignees.assignee", ["person-or-organization-name", "city", "state"]),
        "property": children(head, ["reel", "frame"], "properties.property", ["serial-no", "registration-no"]),
    }
