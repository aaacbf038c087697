"""Best representative of each duplicate group: skyline over usability, trust and recency."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.components import components
from ..operators.references import UUID_FORM, micros, uuid_key

# Marks that stand where a value is missing.
NOTHING = ("-", "--", "---", "—", "——", "–", "/", "\\", ".", "?", "n/a", "na", "n.a.", "none", "null", "nil", "nan", "unknown", "tbd", "无", "暂无", "没有", "未知", "不详", "空")
_ZERO = "00000000-0000-0000-0000-000000000000"
_UUID = r"[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}"
# the list behind member_ids, memberIds or members: in brackets, or one text with the ids parted by a mark or blank
_MEMBERS = r"""(?is)member(?:s|_?ids)[\\"'\s]*[:=][\\"'\s\[(]*([^\])}:=]*)"""


def plain_uuid(text: Column) -> Column:
    """The UUID in lower case with hyphens; another text as it is behind a mark; null for no reference."""
    key = uuid_key(text)
    other = F.regexp_replace(key, "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
    return F.when(text.rlike(UUID_FORM) & (text != _ZERO), F.lower(text)).otherwise(other)


def usable(value: Column) -> Column:
    """Whether the value is there: not null, blank, a mark of absence or masked with an asterisk."""
    bare = F.lower(F.regexp_replace(value, r"^[\s 　]+|[\s 　]+$", ""))
    return F.coalesce((bare != "") & ~bare.isin(*NOTHING) & ~bare.rlike(r"^[-‐–—_]+$") & ~F.contains(bare, F.lit("*")), F.lit(False))


def decided_edges(decisions: DataFrame) -> DataFrame:
    """(a, b) of the decisions in force: the two entities, and the canonical one with each member of the evidence.

    In force is what has the latest created_at of its pair (all of them if several have it; a null time is
    earliest). BLOCKED gives no edge. Evidence may be JSON, JSON in a string, a dictionary as printed, cut
    off or null, and its member list an array or one text of ids: whole ids of the list count, an id that was
    cut does not.
    """
    rows = decisions.select(
        plain_uuid(F.col("canonical_entity_id")).alias("canonical"), plain_uuid(F.col("duplicate_entity_id")).alias("duplicate"), "decision_status", "evidence", F.coalesce(micros(F.col("created_at")), F.lit(-(2**62))).alias("at")
    )
    latest = rows.groupBy(F.col("canonical").alias("c"), F.col("duplicate").alias("d")).agg(F.max("at").alias("last"))
    force = rows.join(latest, F.col("canonical").eqNullSafe(F.col("c")) & F.col("duplicate").eqNullSafe(F.col("d")) & (F.col("at") == F.col("last"))).where(
        F.upper(F.trim(F.coalesce("decision_status", F.lit("")))) != "BLOCKED"
    )
    named = F.transform(F.regexp_extract_all(F.regexp_extract(F.coalesce("evidence", F.lit("")), _MEMBERS, 1), F.lit(_UUID), F.lit(0)), plain_uuid)
    ends = F.array_compact(F.array_distinct(F.concat(F.array("canonical", "duplicate"), named)))
    return force.select(ends.alias("ends")).where(F.size("ends") > 0).select(F.element_at("ends", 1).alias("a"), F.explode("ends").alias("b")).where("a <> b").distinct()


def duplicate_groups(decisions: DataFrame) -> DataFrame:
    """(entity_id, group_id): groups of two or more entities, named by their smallest entity_id."""
    return components(decided_edges(decisions)).select(F.col("node").alias("entity_id"), F.col("component").alias("group_id"))


def measured(identifiers: DataFrame, export_day: str) -> DataFrame:
    """identifiers with entity (plain), usable, trust (0 to 10000, -1 for null) and recency (microseconds, least if void)."""
    score = F.col("confidence_score").cast("double")
    unit = F.when(score > 1, score / 100).otherwise(score)
    trust = F.when(score.isNull() | F.isnan(score), F.lit(-1)).otherwise(F.round(unit * 10000).cast("int"))
    seen = F.col("last_seen_at").cast("timestamp_ntz")
    void = seen.isNull() | F.coalesce(seen < F.col("first_seen_at").cast("timestamp_ntz"), F.lit(False)) | (seen >= F.expr(f"timestamp_ntz'{export_day} 00:00:00' + interval 1 day"))
    return identifiers.select(
        plain_uuid(F.col("entity_id")).alias("entity"),
        "identifier_type",
        "row_id",
        usable(F.col("identifier_value")).cast("int").alias("usable"),
        trust.alias("trust"),
        F.when(void, F.lit(-(2**62))).otherwise(micros(seen)).alias("recency"),
        *[F.when(usable(F.col(c)), F.col(c)).alias(c) for c in ("identifier_value", "normalized_value", "country_code", "source")],
    )


def skyline(records: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """The Pareto-undominated cells of each group of keys over usable, trust and recency, larger being better.

    A cell is a (usable, trust) of a group, with its latest record; trust is a whole number of at most 10002
    values, so a group has at most 20004 cells however many records it has, and cells are made before the
    shuffle. Records equal in all three do not dominate each other; the smallest row_id stands for them.
    """
    best = F.max(F.struct("recency", (-F.col("row_id")).alias("order"), *carried)).alias("best")
    cells = records.groupBy(*keys, "usable", "trust").agg(best)
    fall = W.partitionBy(*keys).orderBy(-F.col("trust"))
    above, upto = fall.rangeBetween(W.unboundedPreceding, -1), fall.rangeBetween(W.unboundedPreceding, 0)
    recency = F.col("best.recency")
    useful = F.when(F.col("usable") == 1, recency)
    ruled = cells.select(
        *keys, "usable", "trust", "best", F.max(useful).over(above).alias("useful_above"), F.max(useful).over(upto).alias("useful_upto"), F.max(recency).over(above).alias("any_above")
    )
    dominated = F.when(F.col("usable") == 1, F.col("useful_above") >= recency).otherwise((F.col("useful_upto") >= recency) | (F.col("any_above") >= recency))
    return ruled.where(~F.coalesce(dominated, F.lit(False))).select(*keys, "usable", "trust", "best")


def survivors(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys and row_id: of each group's skyline the record that is first by usable, trust, recency, then smallest row_id."""
    policy = F.struct("usable", "trust", F.col("best.recency").alias("recency"), F.col("best.order").alias("order"))
    front = skyline(records.where("usable = 1"), keys, [])
    return front.groupBy(*keys).agg(F.max(policy).alias("p")).select(*keys, (-F.col("p.order")).alias("row_id"))


def layered(records: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """The cells of each group of keys with their dominance layer: 1 is the skyline, n + 1 that of what is left without layers 1 to n.

    A cell is a (complete, trust, recency) of a group, larger being better: `complete` counts the fields that a
    record knows, and is 0 without a usable value. Beside it stand `usable`, `best`, its record of the smallest
    row_id, and per field `known_<field>`, the smallest row_id that has the field with its value; cells are made
    before the shuffle. A layer is one more than the deepest layer of the cells that dominate it. Those come
    earlier in the order of falling trust, completeness and recency, so one pass over sorted cells numbers the
    layers and keeps only the latest recency of each layer and completeness of the group at hand, not the group.
    """
    known = [F.min(F.when(F.col(f).isNotNull(), F.struct("row_id", F.col(f).alias("value")))).alias(f"known_{f}") for f in fields]
    count = reduce(lambda n, f: n + F.col(f).isNotNull().cast("int"), fields, F.lit(1))
    rated = records.withColumn("complete", F.when(F.col("usable") == 1, count).otherwise(0))
    cells = rated.groupBy(*keys, "complete", "trust", "recency").agg(F.max("usable").alias("usable"), F.min(F.struct("row_id", *fields)).alias("best"), *known)
    ordered = cells.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, F.desc("trust"), F.desc("complete"), F.desc("recency"))
    levels = len(fields) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, latest = None, []
        for batch in batches:
            numbers = []
            columns = [batch.column(c).to_pylist() for c in ("complete", "recency", *keys)]
            for complete, seen, *key in zip(*columns, strict=True):
                if key != group:
                    group, latest = key, [[] for _ in range(levels)]
                depth = _deeper(latest[complete], seen)
                for level in range(complete + 1):  # a cell dominates none that is more complete
                    _raise(latest[level], depth, seen)
                numbers.append(depth + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], names=[*batch.schema.names, "layer"])

    return ordered.mapInArrow(run, StructType([*cells.schema.fields, StructField("layer", IntegerType())]))


def _deeper(latest: list[int], seen: int) -> int:
    """The number of layers whose latest recency is not below seen; latest falls from layer to layer."""
    return bisect_right(latest, -seen)


def _raise(latest: list[int], depth: int, seen: int) -> None:
    """Take a cell of layer depth + 1 into the latest recencies, which are kept negative; cells that dominate it are in the layers before."""
    if depth == len(latest):
        latest.append(-seen)
    else:
        latest[depth] = min(latest[depth], -seen)


def survivor_records(records: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """The surviving record of each group, each null field filled from the first dominance layer that knows it.

    Layers are those of all records of the group; of the records of one layer that have the field the first by
    usable, trust, recency, then smallest row_id fills it. Fields that no record has stay null.
    """
    rank = [(-F.col(c)).alias(c) for c in ("usable", "trust", "recency")]
    first = F.min(F.when(F.col("usable") == 1, F.struct(*rank, "best"))).alias("first")
    filled = [F.min(F.when(F.col(f"known_{f}").isNotNull(), F.struct("layer", *rank, f"known_{f}"))).alias(f"filled_{f}") for f in fields]
    out = layered(records, keys, fields).groupBy(*keys).agg(first, *filled).where("first is not null")
    return out.select(*keys, F.col("first.best.row_id").alias("row_id"), *[F.coalesce(F.col(f"first.best.{f}"), F.col(f"filled_{f}.known_{f}.value")).alias(f) for f in fields])
