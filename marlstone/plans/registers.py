"""Queries of the register operators over the domain tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import history, rules, selection, summaries, versioning
from ..operators.references import uuid_key
from ..session import table
from ..sources import packages

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def put(build):
        QUERIES[build.__name__], ORACLE[build.__name__] = build, sql
        return build

    return put


@query("SELECT owner_key, row_id, serial_number, source_rank FROM us_owner_current QUALIFY row_number() OVER (PARTITION BY owner_key ORDER BY source_rank DESC NULLS LAST, row_id DESC) = 1 AND coalesce(is_deleted, 0) = 0")
def owner_current(spark, d):
    """R-1 over the owners: the version of the highest rank per owner, tombstones left out."""
    rows = table(spark, d, "us_owner_current").select("owner_key", "row_id", "serial_number", "source_rank", "is_deleted")
    return versioning.latest_by(rows, ["owner_key"], ["source_rank", "row_id"], F.col("is_deleted") == 1).drop("is_deleted")


@query("SELECT event_key, max(source_rank) AS source_rank, arg_max(row_id, (source_rank, row_id)) AS row_id, count(*) AS deliveries FROM us_event_history GROUP BY 1")
def event_history(spark, d):
    """Append-only history: an event delivered again counts once, by its highest rank."""
    rows = table(spark, d, "us_event_history").select("event_key", "source_rank", "row_id")
    return rows.groupBy("event_key").agg(F.max("source_rank").alias("source_rank"), F.max_by("row_id", F.struct("source_rank", "row_id")).alias("row_id"), F.count("*").alias("deliveries"))


@query("SELECT serial_number, count(DISTINCT event_key) AS events, min(event_date)::varchar AS first_date, max(event_date)::varchar AS last_date, count(DISTINCT event_code) AS codes FROM us_event_history GROUP BY 1")
def serial_summary(spark, d):
    """Events, codes and dates per serial number; two levels, so a serial of very many rows is spread first."""
    rows = table(spark, d, "us_event_history").groupBy("serial_number", "event_key", "event_code").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return rows.groupBy("serial_number").agg(F.count_distinct("event_key").alias("events"), F.min("lo").cast("string").alias("first_date"), F.max("hi").cast("string").alias("last_date"), F.count_distinct("event_code").alias("codes"))


@query("""WITH e AS (SELECT * FROM us_event_history QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY source_rank DESC, row_id DESC) = 1), x AS (SELECT row_id, serial_number, event_code, lag(event_code) OVER w AS p, lag(row_id) OVER w AS pid FROM e WINDOW w AS (PARTITION BY serial_number ORDER BY source_rank, row_id))
SELECT row_id, serial_number, p AS before, event_code AS after FROM x WHERE pid IS NOT NULL AND p IS DISTINCT FROM event_code""")
def event_code_changes(spark, d):
    """A-3, B-25 over a case's events: what follows what."""
    rows = versioning.latest_by(table(spark, d, "us_event_history").select("event_key", "row_id", "serial_number", "event_code", "source_rank"), ["event_key"], ["source_rank", "row_id"])
    out = history.with_changes(rows, ["serial_number"], ["source_rank", "row_id"], {"event_code": "EVENT_CODE_CHANGED"})
    return out.select("row_id", "serial_number", F.explode("changes").alias("c")).select("row_id", "serial_number", "c.before", "c.after")


@query("""SELECT lower(package_id) AS package_key, arg_max(status, last_seen_at) AS status, count(*) AS registrations FROM source_package GROUP BY 1""")
def package_in_force(spark, d):
    """S-2: the registration of each package that is in force."""
    rows = table(spark, d, "source_package").select(F.lower("package_id").alias("package_key"), "status", "last_seen_at", "package_sequence")
    return rows.groupBy("package_key").agg(F.max_by("status", F.struct("last_seen_at", "package_sequence")).alias("status"), F.count("*").alias("registrations"))


@query("""SELECT package_id, package_sequence, CASE package_kind WHEN 'MONTHLY' THEN 2000000000000000 + (year(source_period_start) * 100 + month(source_period_start)) * 1000000 + package_sequence WHEN 'BASE' THEN 1000000000000000 + package_sequence
WHEN 'DAILY' THEN 3000000000000000 + (year(source_period_start) * 10000 + month(source_period_start) * 100 + day(source_period_start)) * 1000000 + package_sequence WHEN 'HISTORY' THEN 1000000000000000 + (year(source_period_start) * 10000 + month(source_period_start) * 100 + day(source_period_start)) * 1000000 + package_sequence ELSE 500000000000000 + package_sequence END AS rank
FROM source_package WHERE source_period_start IS NOT NULL""")
def package_ranks(spark, d):
    """Package order by kind, period and sequence."""
    rows = table(spark, d, "source_package").where("source_period_start is not null")
    return rows.select("package_id", "package_sequence", packages.rank(F.col("package_kind"), F.col("source_period_start"), F.col("package_sequence")).alias("rank"))


@query("""SELECT row_id, sha256(concat_ws('|', coalesce(package_id, ''), coalesce(application_number, ''), coalesce(raw_name, ''), coalesce(raw_address, ''))) AS row_hash, regexp_extract(upper(replace(coalesce(application_number, ''), ' ', '')), '^(G?)(\\d+)([A-Z]*)$', 2) AS root,
regexp_extract(upper(replace(coalesce(application_number, ''), ' ', '')), '^(G?)(\\d+)([A-Z]*)$', 3) AS suffix FROM cn_stage_applicant""".replace("\\\\", "\\"))
def stage_applicants(spark, d):
    """P-1: staged rows with their hash and the parts of the application number."""
    number = text.application_number(F.col("application_number"))
    rows = table(spark, d, "cn_stage_applicant")
    return rows.select("row_id", hashing.sha256_parts("package_id", "application_number", "raw_name", "raw_address").alias("row_hash"), number["root"].alias("root"), number["suffix"].alias("suffix"))


@query("""SELECT raw_address, count(*) AS rows, count(DISTINCT class_no) AS classes, count(DISTINCT raw_name) AS names FROM cn_stage_applicant WHERE trim(coalesce(raw_address, '')) NOT IN ('', '-') GROUP BY 1 HAVING count(DISTINCT raw_name) > 1""")
def address_conflicts(spark, d):
    """Q-3: address texts that more than one name gives."""
    rows = table(spark, d, "cn_stage_applicant").select("raw_address", "class_no", "raw_name").where(~F.trim(F.coalesce("raw_address", F.lit(""))).isin("", "-"))
    return rows.groupBy("raw_address").agg(F.count("*").alias("rows"), F.count_distinct("class_no").alias("classes"), F.count_distinct("raw_name").alias("names")).where("names > 1")


@query("""SELECT coalesce(nullif(trim(country_code), ''), '?') AS country, count(*) AS people, count(*) FILTER (status = 'MERGED') AS merged FROM person GROUP BY 1""")
def people_by_country(spark, d):
    """B-57: people per country."""
    country = F.when(F.trim("country_code") != "", F.trim("country_code")).otherwise("?")
    return table(spark, d, "person").groupBy(country.alias("country")).agg(F.count("*").alias("people"), F.count_if(F.col("status") == "MERGED").alias("merged"))


@query("""WITH a AS (SELECT lower(asset_id) AS k, is_deleted FROM visual_asset), t AS (SELECT lower(replace(replace(trim(asset_id), '{', ''), '}', '')) AS k, serial_number, source_rank, row_id FROM trademark_asset)
SELECT serial_number, count(*) AS deliveries, count(DISTINCT t.k) AS images, count(*) FILTER (a.k IS NOT NULL AND a.is_deleted = 0) AS living FROM t LEFT JOIN a ON a.k = substr(t.k, 1, 36) GROUP BY 1""")
def mark_images(spark, d):
    """B-76: marks, their deliveries and the images that live."""
    assets = table(spark, d, "visual_asset").select(F.lower("asset_id").alias("k"), "is_deleted")
    marks = table(spark, d, "trademark_asset").select("serial_number", F.lower(F.regexp_replace(F.trim("asset_id"), r"[{}]", "")).alias("k"))
    joined = marks.join(assets, "k", "left")
    return joined.groupBy("serial_number").agg(F.count("*").alias("deliveries"), F.count_distinct("k").alias("images"), F.count_if(F.col("is_deleted") == 0).alias("living"))


@query("""SELECT bit_count(xor(('0x' || a.dhash64)::ubigint, ('0x' || b.dhash64)::ubigint))::int AS distance, count(*) AS pairs FROM (SELECT asset_id, dhash64, sha256, row_number() OVER (PARTITION BY left(asset_id, 2) ORDER BY asset_id) AS n FROM visual_asset WHERE regexp_full_match(dhash64, '[0-9a-f]{16}')) a JOIN (SELECT asset_id, dhash64, sha256, row_number() OVER (PARTITION BY left(asset_id, 2) ORDER BY asset_id) AS n FROM visual_asset WHERE regexp_full_match(dhash64, '[0-9a-f]{16}')) b ON left(a.asset_id, 2) = left(b.asset_id, 2) AND a.n = b.n - 1 GROUP BY 1""")
def image_hash_distance(spark, d):
    """M-4: Hamming distance of perceptual hashes between neighbouring assets."""
    from pyspark.sql import Window as W

    rows = table(spark, d, "visual_asset").where(F.col("dhash64").rlike("^[0-9a-f]{16}$")).select("asset_id", "dhash64", "sha256")
    before = F.lag("dhash64").over(W.partitionBy(F.left("asset_id", F.lit(2))).orderBy("asset_id"))
    half = lambda c, at: F.conv(F.substring(c, at, 8), 16, 10).cast("bigint")
    distance = F.bit_count(half(F.col("dhash64"), 1).bitwiseXOR(half(F.col("p"), 1))) + F.bit_count(half(F.col("dhash64"), 9).bitwiseXOR(half(F.col("p"), 9)))
    return rows.withColumn("p", before).where("p is not null").groupBy(distance.cast("int").alias("distance")).agg(F.count("*").alias("pairs"))


@query("""SELECT identifier_type, CASE WHEN trim(identifier_value) = '' THEN 'BLANK' WHEN trim(identifier_value) IN ('-', '--', '无', 'N/A') THEN 'NOTHING' WHEN contains(identifier_value, '*') THEN 'MASKED' ELSE 'USABLE' END AS quality, count(*) AS rows FROM entity_identifier GROUP BY 1, 2""")
def identifier_quality(spark, d):
    """Q-1: identifiers by usability."""
    value = F.trim("identifier_value")
    quality = rules.ladder([(value == "", "BLANK"), (value.isin("-", "--", "无", "N/A"), "NOTHING"), (F.contains(F.col("identifier_value"), F.lit("*")), "MASKED")], "USABLE")
    return table(spark, d, "entity_identifier").groupBy("identifier_type", quality.alias("quality")).agg(F.count("*").alias("rows"))


@query("""WITH l AS (SELECT serial_number, 0 AS lane_no, 'owner' AS lane FROM us_owner_current WHERE trim(country) = 'CN' UNION ALL SELECT serial_number, 1, 'event' FROM us_event_history WHERE event_code = 'ABN' UNION ALL SELECT serial_number, 2, 'image' FROM trademark_asset)
SELECT serial_number, min(lane_no) AS lane_no, arg_min(lane, lane_no) AS lane FROM l GROUP BY 1""")
def candidate_lanes(spark, d):
    """B-70: candidates of three lanes, the first lane wins."""
    owners = table(spark, d, "us_owner_current").where("trim(country) = 'CN'")
    events = table(spark, d, "us_event_history").where("event_code = 'ABN'")
    return selection.merge_lanes([("owner", owners), ("event", events), ("image", table(spark, d, "trademark_asset"))], "serial_number")


@query("""SELECT party_name_norm, country, n, total, n / total AS dominance FROM (SELECT party_name_norm, sum(n)::bigint AS total, max(n) AS n, arg_min(country, (-n, country)) AS country FROM (SELECT party_name_norm, country, count(*) AS n FROM us_owner_current WHERE party_name_norm IS NOT NULL AND country IS NOT NULL GROUP BY ALL) GROUP BY 1) WHERE total >= 3 AND n / total >= 0.9""")
def owner_country_model(spark, d):
    """R-30: owners whose rows nearly all name one country."""
    return summaries.dominant_value(table(spark, d, "us_owner_current"), "party_name_norm", "country", 3, 0.9)


@query("""SELECT source_package_id, count(*) AS rows FROM (SELECT lower(regexp_replace(trim(source_package_id), '[\\s{}()-]', '', 'g')) AS source_package_id FROM us_event_history WHERE trim(coalesce(source_package_id, '')) <> '' AND NOT regexp_full_match(trim(source_package_id), '[\\s{}()0-]*')) GROUP BY 1""".replace("\\\\", "\\"))
def rows_by_package(spark, d):
    """K-1: rows of each package, however its id is written."""
    rows = table(spark, d, "us_event_history").select(uuid_key(F.col("source_package_id")).alias("source_package_id"))
    return rows.where("source_package_id is not null").groupBy("source_package_id").agg(F.count("*").alias("rows"))
