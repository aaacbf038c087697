"""Pages, lanes, priorities, buckets and ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_with_total(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """A page of 1 to 500 rows with the total of all rows beside it; the total is a count of its own, not a window over all rows."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).offset(max(0, offset)).limit(min(500, max(1, limit))).withColumn("total", total)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order (null placement is the caller's)."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def merge_lanes(lanes: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """(key, lane, lane_no) of every key in any lane; the first lane that has it wins."""
    union = None
    for number, (name, rows) in enumerate(lanes):
        part = rows.select(key, F.lit(number).alias("lane_no"), F.lit(name).alias("lane"))
        union = part if union is None else union.unionAll(part)
    return union.groupBy(key).agg(F.min_by("lane", "lane_no").alias("lane"), F.min("lane_no").alias("lane_no"))


def scored(df: DataFrame, parts: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """df with score, the sum of the parts (reason, condition, points) that hold, and reasons in their order."""
    score = sum((F.when(c, p).otherwise(F.lit(0)) for _, c, p in parts), F.lit(0))
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c, _ in parts]))
    return df.withColumn("score", score).withColumn("reasons", reasons)


def top_k(df: DataFrame, order: Sequence[Column], capacity: int) -> DataFrame:
    """The first rows of a total order, by a top-k of the partitions and no full sort."""
    return df.orderBy(*order).limit(capacity)


def key_ranges(df: DataFrame, key: str, rows: int) -> DataFrame:
    """(range_no, lower, upper, rows): contiguous ranges of about `rows` rows each; a key is never split.

    key is a whole number. Keys are counted before they are numbered; the running sum goes over blocks of equal
    key width and then within each block, so no task sees all keys. Blocks are as many as 1000 at most.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    ends = counts.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if ends["lo"] is None:
        return counts.select(F.lit(0).cast("bigint").alias("range_no"), F.col(key).alias("lower"), F.col(key).alias("upper"), F.col("n").alias("rows"))
    width = (ends["hi"] - ends["lo"]) // 1000 + 1
    blocks = counts.withColumn("__b", F.floor((F.col(key) - ends["lo"]) / width).cast("int"))
    sums = blocks.groupBy("__b").agg(F.sum("n").alias("part")).withColumn("before", F.coalesce(F.sum("part").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    own = F.sum("n").over(W.partitionBy("__b").orderBy(key).rowsBetween(W.unboundedPreceding, -1))
    placed = blocks.join(F.broadcast(sums.select("__b", "before")), "__b").withColumn("at", F.col("before") + F.coalesce(own, F.lit(0)))  # at most 1001 rows
    return placed.groupBy(F.floor(F.col("at") / rows).cast("bigint").alias("range_no")).agg(F.min(key).alias("lower"), F.max(key).alias("upper"), F.sum("n").alias("rows"))
