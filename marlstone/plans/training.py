"""Queries p1 and p2 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed import delimiter_scores, explode_packed
from ..operators.references import References, orphan_report, orphans, uuid_key
from ..session import table

PACKED = ("phones", "emails", "websites")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every cell of phones, emails and websites with its place in the cell."""
    rows = table(spark, sf_dir, "cn_qcc_company_observation")
    found = explode_packed(rows, F.col("row_id"), F.col("source_result_path"), PACKED)
    return found.select(F.col("row_key").alias("row_id"), "field", "pos", "value")


def p1_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of each delimiter in each source and field."""
    rows = table(spark, sf_dir, "cn_qcc_company_observation")
    cells = rows.select(F.coalesce("source_result_path", F.lit("")).alias("src"), F.explode(F.create_map(*[x for f in PACKED for x in (F.lit(f), F.col(f))])).alias("field", "cell"))
    return delimiter_scores(cells, "src", "field", "cell").select("src", "field", "delimiter", "cells", F.round("score", 6).alias("score"), F.round("share", 6).alias("share"))


def _packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per package: the one in force, by last_seen_at and then by sequence."""
    rows = table(spark, sf_dir, "source_package").select(uuid_key(F.col("package_id")).alias("key"), "status", "first_seen_at", "last_seen_at", "package_sequence")
    force = F.max_by(F.struct("status", "first_seen_at"), F.struct("last_seen_at", "package_sequence", "first_seen_at"))
    return rows.groupBy("key").agg(force.alias("r")).select("key", (F.col("r.status") == "DELETED").alias("deleted"), F.col("r.first_seen_at").alias("since"))


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "visual_asset").select(uuid_key(F.col("asset_id")).alias("key"), "is_deleted", "created_at")
    return rows.groupBy("key").agg((F.max("is_deleted") == 1).alias("deleted"), F.min("created_at").alias("since"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to packages and images that are missing, deleted or came later."""
    packages = orphans(
        _packages(spark, sf_dir),
        [
            References("us_event_history", table(spark, sf_dir, "us_event_history"), "row_id", "source_package_id", "observed_at"),
            References("us_owner_current", table(spark, sf_dir, "us_owner_current"), "row_id", "last_source_package_id", "ingested_at"),
        ],
    )
    images = orphans(_assets(spark, sf_dir), [References("trademark_asset", table(spark, sf_dir, "trademark_asset"), "row_id", "asset_id", "first_observed_at")])
    return packages.unionByName(images)


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references counted by table, month and reason."""
    return orphan_report(p2_found(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p1_delimiters": p1_delimiters, "p2_found": p2_found, "p2_report": p2_report}

_KEY = r"CASE WHEN regexp_full_match(trim({0}), '[\s{{}}()0-]*') THEN NULL ELSE lower(regexp_replace(trim({0}), '[\s{{}}()-]', '', 'g')) END"
_P2 = f"""
WITH package AS (
  SELECT {_KEY.format("package_id")} AS key, arg_max(status, last_seen_at) = 'DELETED' AS deleted, arg_max(first_seen_at, last_seen_at) AS since
  FROM source_package GROUP BY 1),
image AS (SELECT {_KEY.format("asset_id")} AS key, is_deleted = 1 AS deleted, created_at AS since FROM visual_asset),
ref AS (
  SELECT 'us_event_history' AS source_table, row_id, observed_at AS t, {_KEY.format("source_package_id")} AS key FROM us_event_history
  UNION ALL SELECT 'us_owner_current', row_id, ingested_at, {_KEY.format("last_source_package_id")} FROM us_owner_current),
pic AS (SELECT 'trademark_asset' AS source_table, row_id, first_observed_at AS t, {_KEY.format("asset_id")} AS key FROM trademark_asset),
judged AS (
  SELECT r.source_table, r.row_id, strftime(r.t, '%Y-%m') AS period,
    CASE WHEN p.key IS NULL THEN 'missing' WHEN p.deleted THEN 'deleted' WHEN p.since > r.t THEN 'late' END AS reason
  FROM ref r LEFT JOIN package p USING (key) WHERE r.key IS NOT NULL
  UNION ALL
  SELECT r.source_table, r.row_id, strftime(r.t, '%Y-%m'),
    CASE WHEN p.key IS NULL THEN 'missing' WHEN p.deleted THEN 'deleted' WHEN p.since > r.t THEN 'late' END
  FROM pic r LEFT JOIN image p USING (key) WHERE r.key IS NOT NULL)
"""

ORACLE = {
    "p2_found": _P2 + "SELECT source_table, row_id, period, reason FROM judged WHERE reason IS NOT NULL",
    "p2_report": _P2 + "SELECT source_table, period, reason, count(*) AS orphans FROM judged WHERE reason IS NOT NULL GROUP BY ALL",
}
