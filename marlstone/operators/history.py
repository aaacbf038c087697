"""Successive observations: predecessors, differences, feeds, gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


HOT_ROWS = 2_000_000  # rows of one subject up to which one task sorts them
_SEGMENT = "__segment"


def _segmented(df: DataFrame, subject: Sequence[str], order: Column, hot_rows: int) -> tuple[DataFrame, bool]:
    """df with a segment number and whether any subject has more than one.

    Subjects of more than hot_rows rows are cut at quantiles of the order (a number, date or time); rows of one
    order value stay together. There are at most rows / hot_rows such subjects, so their bounds are small; the
    others are segment 0.
    """
    counts = df.groupBy(*subject).agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows)
    hot = {tuple(r[c] for c in subject): r["__n"] for r in counts.collect()}
    if not hot:
        return df.withColumn(_SEGMENT, F.lit(0)), False
    number = F.unix_micros(order.cast("timestamp")) if dict(df.select(order.alias("o")).dtypes)["o"].startswith(("timestamp", "date")) else order.cast("double")
    cuts = max(2, -(-max(hot.values()) // hot_rows))
    chosen = df.join(F.broadcast(counts.select(*subject)), list(subject), "left_semi")
    bounds = chosen.groupBy(*subject).agg(F.percentile_approx(number, [k / cuts for k in range(1, cuts)], 10_000).alias("__bounds"))
    marked = df.join(F.broadcast(bounds), list(subject), "left")
    return marked.withColumn(_SEGMENT, F.coalesce(F.size(F.filter("__bounds", lambda x: x <= number)), F.lit(0))).drop("__bounds"), True


def _carried(rows: DataFrame, subject: Sequence[str], summary: Column, over) -> DataFrame:
    """(subject, segment, __carry): over(window) of the summaries of a subject's earlier segments; a row per segment of a cut subject."""
    per = rows.groupBy(*subject, _SEGMENT).agg(summary.alias("__s"))
    cut = per.withColumn("__all", F.max(_SEGMENT).over(W.partitionBy(*subject))).where("__all > 0")
    return cut.withColumn("__carry", over(W.partitionBy(*subject).orderBy(_SEGMENT))).select(*subject, _SEGMENT, "__carry")


def previous_as_of(df: DataFrame, subject: Sequence[str], rank: Column, values: Sequence[str], prefix: str = "previous_", hot_rows: int = HOT_ROWS) -> DataFrame:
    """df with the values of the subject's row of the greatest strictly smaller rank (rows of one rank see the same one).

    rank must be a whole number; of several rows of that rank the greatest by the values is taken. Rows of
    null subjects are a subject of their own. A subject of very many rows is cut into segments.
    """
    rows, cut = _segmented(df, subject, rank, hot_rows)
    held = F.struct(rank.alias("__r"), *values)
    found = rows.withColumn("__p", F.max(held).over(W.partitionBy(*subject, _SEGMENT).orderBy(rank).rangeBetween(W.unboundedPreceding, -1)))
    if cut:
        carry = _carried(rows, subject, F.max(held), lambda w: F.max("__s").over(w.rowsBetween(W.unboundedPreceding, -1)))
        found = found.join(F.broadcast(carry), [*subject, _SEGMENT], "left").withColumn("__p", F.coalesce("__p", "__carry"))  # a row per segment
    return found.select(*df.columns, *[F.col("__p")[v].alias(f"{prefix}{v}") for v in values])


def with_changes(df: DataFrame, subject: Sequence[str], order: Sequence[str], tracked: dict[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """df with changes: array of (field, before, after, change_type) against the subject's row before in order; the first row has none.

    A subject of very many rows is cut into segments by the first order column.
    """
    rows, cut = _segmented(df, subject, F.col(order[0]), hot_rows)
    rows = rows.withColumn("__p", F.lag(F.struct(*tracked)).over(W.partitionBy(*subject, _SEGMENT).orderBy(*order)))
    if cut:
        carry = _carried(rows, subject, F.max_by(F.struct(*tracked), F.struct(*order)), lambda w: F.lag("__s").over(w))
        rows = rows.join(F.broadcast(carry), [*subject, _SEGMENT], "left").withColumn("__p", F.coalesce("__p", "__carry")).drop("__carry")  # a row per segment
    parts = [
        F.struct((F.col("__p").isNotNull() & ~F.col(c).eqNullSafe(F.col("__p")[c])).alias("hit"), F.lit(c).alias("field"), F.col("__p")[c].cast("string").alias("before"), F.col(c).cast("string").alias("after"), F.lit(kind).alias("change_type"))
        for c, kind in tracked.items()
    ]
    changes = F.transform(F.filter(F.array(*parts), lambda x: x["hit"]), lambda x: x.dropFields("hit"))
    return rows.select(*df.columns, changes.alias("changes"))


def feed_page(df: DataFrame, cursor: Sequence[str], after: Sequence | None, limit: int) -> DataFrame:
    """The next `limit` rows behind a cursor in the order of its columns, and has_more.

    The cursor to go on from is that of the last row, so nothing is lost between pages. limit + 1 rows are
    taken by a top-k, not a full sort. The bound of the first column is a plain comparison, which the scan can
    use to pass over files and row groups.
    """
    rows = df if after is None else df.where(_behind(df, cursor, after))
    page = rows.orderBy(*cursor).limit(limit + 1)
    place = F.row_number().over(W.orderBy(*cursor))
    return page.withColumn("__n", place).withColumn("has_more", F.max("__n").over(W.partitionBy()) > limit).where(F.col("__n") <= limit).drop("__n")


def _behind(df: DataFrame, cursor: Sequence[str], after: Sequence) -> Column:
    """Whether a row comes after a place, compared column by column; a null is before every value."""
    place = [F.lit(a).cast(df.schema[c].dataType) for a, c in zip(after, cursor, strict=True)]
    if any(a is None for a in after):
        return F.struct(*cursor) > F.struct(*place)
    test = F.col(cursor[-1]) > place[-1]
    for c, a in list(zip(cursor, place, strict=True))[-2::-1]:
        test = (F.col(c) > a) | ((F.col(c) == a) & test)
    return (F.col(cursor[0]) >= place[0]) & test


def set_differences(df: DataFrame, subject: Sequence[str], order: Sequence[str], item: str) -> DataFrame:
    """(subject, order, added, removed): items of each snapshot of a subject against the snapshot before; the first has none."""
    sets = df.groupBy(*subject, *order).agg(F.array_sort(F.collect_set(item)).alias("items"))
    before = F.lag("items").over(W.partitionBy(*subject).orderBy(*order))
    return sets.withColumn("before", before).where("before is not null").select(*subject, *order, F.array_except("items", "before").alias("added"), F.array_except("before", "items").alias("removed"))


def calendar_gaps(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """(keys, gap_from, gap_to, days): days without a row between the first and the last day of each key."""
    days = df.select(*keys, day).where(F.col(day).isNotNull()).distinct()
    nxt = F.lead(day).over(W.partitionBy(*keys).orderBy(day))
    missing = F.datediff(nxt, F.col(day)) - 1
    return days.withColumn("__next", nxt).withColumn("days", missing).where("days > 0").select(*keys, F.date_add(day, 1).alias("gap_from"), F.date_sub("__next", 1).alias("gap_to"), "days")


def islands(df: DataFrame, group: Sequence[str], order: str, starts: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """df with record: the number of starting rows up to and with this one, within the group; 0 before the first start.

    A group of very many rows is cut into segments, whose starts are counted first.
    """
    rows, cut = _segmented(df, group, F.col(order), hot_rows)
    rows = rows.withColumn("__start", F.when(starts, 1).otherwise(0))
    rows = rows.withColumn("record", F.sum("__start").over(W.partitionBy(*group, _SEGMENT).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))
    if cut:
        carry = _carried(rows, group, F.sum("__start"), lambda w: F.sum("__s").over(w.rowsBetween(W.unboundedPreceding, -1)))
        rows = rows.join(F.broadcast(carry), [*group, _SEGMENT], "left").withColumn("record", F.col("record") + F.coalesce("__carry", F.lit(0)))  # a row per segment
    return rows.select(*df.columns, "record")
