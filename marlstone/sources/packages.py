"""Source packages: discovery, registration, description by file name, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.versioning import latest_by


def discover(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """(path, file_name, file_size, modified_at, sha256) of the files below a folder; contents are hashed where they lie."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("sha256"))


def register(known: DataFrame, found: DataFrame) -> DataFrame:
    """known packages with found files: one row per sha256, sequences given on in order of name, a missing file that came back is REGISTERED again.

    known: sha256, file_name, path, file_size, package_sequence, status. Only the new files are numbered, in one small window.
    """
    fresh = found.join(known.select("sha256"), "sha256", "left_anti").dropDuplicates(["sha256"])
    top = known.agg(F.coalesce(F.max("package_sequence"), F.lit(0))).scalar()
    numbered = fresh.withColumn("n", F.row_number().over(W.orderBy("file_name", "sha256")))
    added = numbered.select("sha256", "file_name", "path", "file_size", (top + F.col("n")).cast("bigint").alias("package_sequence"), F.lit("REGISTERED").alias("status"))
    seen = found.groupBy("sha256").agg(F.min(F.struct("file_name", "path", "file_size")).alias("f"))
    kept = known.join(seen, "sha256", "left").select(
        "sha256",
        *[F.coalesce(F.col("f")[c], F.col(c)).alias(c) for c in ("file_name", "path", "file_size")],
        "package_sequence",
        F.when((F.col("status") == "MISSING_FILE") & F.col("f").isNotNull(), "REGISTERED").otherwise(F.col("status")).alias("status"),
    )
    return kept.unionByName(added)


def describe(name: Column, family: str) -> Column:
    """struct(kind, period_start, period_end, part) of a package's file name; family is base_monthly or history_daily.

    base_monthly: 2000.zip is a BASE year, 2023_1.zip a MONTHLY patch. history_daily: a name with two dates and
    a part is HISTORY, one with a single six-figure date DAILY (years from 70 on are of the last century).
    """
    if family == "base_monthly":
        year, month = F.regexp_extract(name, r"^(\d{4})(?:_\d{1,2})?\.", 1), F.regexp_extract(name, r"^\d{4}_(\d{1,2})\.", 1)
        start = F.when(year != "", F.try_to_timestamp(F.concat_ws("-", year, F.lpad(F.when(month != "", month).otherwise("1"), 2, "0"), F.lit("01")), F.lit("yyyy-MM-dd")).cast("date"))
        kind = F.when(year == "", "UNKNOWN").when(month != "", "MONTHLY").otherwise("BASE")
        end = F.when(kind == "MONTHLY", F.last_day(start)).when(kind == "BASE", F.date_sub(F.add_months(start, 12), 1))
        return F.struct(kind.alias("kind"), start.alias("period_start"), end.alias("period_end"), F.lit(0).alias("part"))
    first, second, part = (F.regexp_extract(name, r"(\d{8})-(\d{8})-(\d{1,3})", k) for k in (1, 2, 3))
    short = F.regexp_extract(name, r"(?<!\d)(\d{6})(?!\d)", 1)
    day = lambda text: F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    full = F.when(short != "", F.concat(F.when(F.substring(short, 1, 2) >= "70", "19").otherwise("20"), short))
    kind = F.when(first != "", "HISTORY").when(short != "", "DAILY").otherwise("UNKNOWN")
    return F.struct(
        kind.alias("kind"), F.when(first != "", day(first)).otherwise(day(full)).alias("period_start"), F.when(first != "", day(second)).otherwise(day(full)).alias("period_end"), F.when(part != "", part.try_cast("int")).otherwise(F.lit(0)).alias("part")
    )


def rank(kind: Column, period: Column, sequence: Column, part: Column | None = None) -> Column:
    """The total order of packages, never their time of import: monthly over base, daily over history, unknown lowest."""
    month = (F.year(period) * 100 + F.month(period)).cast("bigint")
    day = (month * 100 + F.dayofmonth(period)).cast("bigint")
    part = F.lit(0) if part is None else part
    return (
        F.when(kind == "MONTHLY", F.lit(2 * 10**15) + month * 10**6 + sequence)
        .when(kind == "BASE", F.lit(10**15) + sequence)
        .when(kind == "DAILY", F.lit(3 * 10**15) + day * 10**6 + sequence)
        .when(kind == "HISTORY", F.lit(10**15) + (day * 1000 + part) * 1000 + sequence)
        .otherwise(F.lit(5 * 10**14) + sequence)
        .cast("bigint")
    )


def in_force(packages: DataFrame) -> DataFrame:
    """One row per package: that of the latest last_seen_at, then of the highest sequence."""
    return latest_by(packages, ["package_id"], ["last_seen_at", "package_sequence"])
