"""Read functions over stored tables, in place of a service: lookups, histories, feeds, directories, composites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import history, selection, versioning
from ..session import table

CAPS = {"feed": 1000, "history": 5000, "directory": 500}


def _limit(wanted: int, kind: str) -> int:
    if wanted < 1:
        raise ValueError("a limit is 1 or more")
    return min(wanted, CAPS[kind])


def serial_number(text: str) -> str:
    """An eight-figure serial number, or ValueError."""
    bare = "".join(text.split())
    if len(bare) != 8 or not bare.isdigit():
        raise ValueError(f"no serial number: {text!r}")
    return bare


def owners(spark: SparkSession, store: str, serial: str) -> DataFrame:
    """The living owners of a case, latest versions only; the filter reaches the scan."""
    rows = table(spark, store, "us_owner_current").where(F.col("serial_number") == serial)
    return versioning.latest_by(rows, ["owner_key"], ["source_rank", "row_id"], F.col("is_deleted") == 1)


def events(spark: SparkSession, store: str, serial: str, limit: int = 5000) -> DataFrame:
    """The events of a case in order, each once."""
    rows = table(spark, store, "us_event_history").where(F.col("serial_number") == serial)
    once = versioning.latest_by(rows, ["event_key"], ["source_rank", "row_id"])
    return once.orderBy(F.asc_nulls_first("event_date"), "event_sequence", "event_key").limit(_limit(limit, "history"))


def changes(spark: SparkSession, store: str, after: tuple[int, int] | None = None, limit: int = 1000) -> DataFrame:
    """A page of the event feed behind (source_rank, row_id), with has_more; go on from the last row."""
    rows = table(spark, store, "us_event_history").select("source_rank", "row_id", "serial_number", "event_code", "event_date")
    return history.feed_page(rows, ["source_rank", "row_id"], after, _limit(limit, "feed"))


def case_360(spark: SparkSession, store: str, serials: Sequence[str] | None = None, events_each: int = 5) -> DataFrame:
    """One nested row per serial: owners, the last events, images; of all serials or of some.

    Each family is reduced before it is nested: the owners to their latest versions, all of them, with their
    number in n_owners; the events to `events_each`, so a serial of very many events is never collected whole.
    """

    def of(name: str) -> DataFrame:
        rows = table(spark, store, name)
        return rows.where(F.col("serial_number").isin(list(serials))) if serials is not None else rows

    living = versioning.latest_by(of("us_owner_current").select("serial_number", "owner_key", "party_name", "country", "source_rank", "row_id", "is_deleted"), ["owner_key"], ["source_rank", "row_id"], F.col("is_deleted") == 1)
    own = living.groupBy("serial_number").agg(F.count("*").alias("n_owners"), F.array_sort(F.collect_list(F.struct("owner_key", "party_name", "country"))).alias("owners"))
    place = F.row_number().over(W.partitionBy("serial_number").orderBy(F.desc_nulls_last("event_date"), F.desc("source_rank"), F.desc("row_id")))
    last = of("us_event_history").select("serial_number", "event_date", "event_code", "source_rank", "row_id").withColumn("n", place).where(F.col("n") <= events_each)
    seen = last.groupBy("serial_number").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "event_date", "event_code"))), lambda e: e.dropFields("n")).alias("events"))
    images = of("trademark_asset").groupBy("serial_number").agg(F.max_by("asset_id", F.struct("source_rank", "row_id")).alias("asset_id"))
    return seen.join(own, "serial_number", "full").join(images, "serial_number", "full")


def directory(spark: SparkSession, store: str, country: str | None = None, contains: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of people by facets, with the total beside it."""
    rows = table(spark, store, "person").select("person_id", "canonical_name", "country_code", "status", "updated_at")
    if country:
        rows = rows.where(F.upper(F.trim("country_code")) == country.upper())
    if contains:
        rows = rows.where(F.contains(F.lower("canonical_name"), F.lit(contains.lower())))
    return selection.page_with_total(rows, [F.desc_nulls_last("updated_at"), F.asc("person_id")], _limit(limit, "directory"), offset)


def envelope(rows: DataFrame, domain: str, kind: str, version: str, keys: Sequence[str]) -> DataFrame:
    """rows as (domain, kind, version, subject, payload): a fact's envelope with its columns as JSON; a null subject raises when read."""
    subject = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    checked = F.when(F.concat(*[F.col(k).cast("string") for k in keys]).isNull(), F.raise_error(F.lit("a fact without a subject")).cast("string")).otherwise(subject)
    return rows.select(F.lit(domain).alias("domain"), F.lit(kind).alias("kind"), F.lit(version).alias("version"), checked.alias("subject"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("payload"))


def _case_360(spark: SparkSession, d: str) -> DataFrame:
    """case_360 of every serial, flattened to counts and its last event."""
    rows = case_360(spark, d)
    return rows.select("serial_number", F.coalesce(F.col("n_owners").cast("int"), F.lit(0)).alias("owners"), F.coalesce(F.size("events"), F.lit(0)).alias("events"), F.element_at("events", 1)["event_code"].alias("last_code"))


def _feed(spark: SparkSession, d: str) -> DataFrame:
    """The first page of the event feed; the limit is the page."""
    return changes(spark, d, (0, 0), 1000).select("source_rank", "row_id", "serial_number", "event_code", "has_more")


def _directory(spark: SparkSession, d: str) -> DataFrame:
    """A page of the directory of one country; the limit is the page."""
    return directory(spark, d, "us", None, 200, 0).select("person_id", "status", "total")


QUERIES = {"case_360": _case_360, "event_feed": _feed, "person_directory": _directory}
ORACLE = {
    "case_360": """WITH o AS (SELECT * FROM us_owner_current QUALIFY row_number() OVER (PARTITION BY owner_key ORDER BY source_rank DESC, row_id DESC) = 1), oc AS (SELECT serial_number, count(*)::int AS n FROM o WHERE coalesce(is_deleted, 0) = 0 GROUP BY 1),
e AS (SELECT serial_number, least(count(*), 5)::int AS n, first(event_code ORDER BY event_date DESC NULLS LAST, source_rank DESC, row_id DESC) AS code FROM us_event_history GROUP BY 1), t AS (SELECT DISTINCT serial_number FROM trademark_asset),
s AS (SELECT serial_number FROM oc UNION SELECT serial_number FROM e UNION SELECT serial_number FROM t)
SELECT s.serial_number, coalesce(oc.n, 0) AS owners, coalesce(e.n, 0) AS events, e.code AS last_code FROM s LEFT JOIN oc USING (serial_number) LEFT JOIN e USING (serial_number)""",
    "event_feed": "SELECT source_rank, row_id, serial_number, event_code, (SELECT count(*) > 1000 FROM us_event_history WHERE (source_rank, row_id) > (0, 0)) AS has_more FROM us_event_history WHERE (source_rank, row_id) > (0, 0) ORDER BY source_rank, row_id LIMIT 1000",
    "person_directory": "SELECT person_id, status, (SELECT count(*) FROM person WHERE upper(trim(country_code)) = 'US') AS total FROM person WHERE upper(trim(country_code)) = 'US' ORDER BY updated_at DESC NULLS LAST, person_id LIMIT 200",
}
