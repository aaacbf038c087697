"""References to records that do not exist: range-partitioned parents, vectorised binary search, misses by period.

Keys are ordered by a 128-bit hash, so every range holds about as many parents whatever the keys look
like. A range's parents travel as sorted arrays; the references of a range are cut into slices of
bounded size (a hot key only makes more slices, each with a copy of its range's arrays) and are probed
a slice at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARENTS_PER_RANGE = 200_000
REFERENCES_PER_SLICE = 150_000
UUID_FORM = "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def uuid_key(text: Column) -> Column:
    """The same key for the same UUID however it is written; null for null, blank and the all-zero UUID.

    Case, outer blanks, braces, parentheses, hyphens and urn:uuid: do not matter. A text that is no UUID is
    kept, trimmed, behind a mark, so that it equals only itself.
    """
    plain = F.lower(F.translate(text, "-", ""))  # of a UUID in its usual form, which most are
    trimmed = F.trim(F.regexp_replace(text, r"^[\s 　]+|[\s 　]+$", ""))
    bare = F.regexp_replace(F.lower(trimmed), r"^urn:uuid:|[\s{}()\-]", "")
    return (
        F.when(text.rlike(UUID_FORM), F.when(plain != "0" * 32, plain))
        .when(bare.rlike("^0*$") & trimmed.rlike(r"^[\s{}()0\-]*$"), F.lit(None))
        .when(bare.rlike("^[0-9a-f]{32}$"), bare)
        .otherwise(F.concat(F.lit("~"), trimmed))
    )


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a timestamp_ntz, free of the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), time.cast("timestamp_ntz"))


@dataclass(frozen=True)
class References:
    """One referring table: its rows, the columns of the row's id, reference and own time."""

    name: str
    rows: DataFrame
    row_id: str
    reference: str
    time: str


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(F.col(key)).alias("h1"), F.xxhash64(F.lit("second"), F.col(key)).alias("h2")]


def _range_of(count: int) -> Column:
    """The range, of count ranges of equal width, that holds h1; it grows with h1."""
    upper = F.shiftright("h1", 32) + F.lit(2**31)  # 0 to 2^32 - 1
    return F.shiftright(upper * F.lit(count), 32).cast("int")


def orphans(parents: DataFrame, sources: list[References]) -> DataFrame:
    """(source_table, row_id, period, reason) of every reference that names no living parent of its time.

    parents: key (from uuid_key), deleted boolean, since timestamp_ntz; one row per key. reason is missing,
    else deleted, else late (since is after the row's own time; a null time on either side is not late).
    Null keys are no references and give no row. period is yyyy-MM of the row's own time, null without one.
    Repeated rows are judged one by one. An empty parents table makes every reference missing.
    """
    named = parents.where(F.col("key").isNotNull()).select(*_hashes("key"), F.coalesce("deleted", F.lit(False)).alias("deleted"), micros(F.col("since")).alias("since"))
    refs = None
    for k, source in enumerate(sources):
        part = source.rows.select(
            F.lit(k).cast("tinyint").alias("source"), F.col(source.row_id).cast("bigint").alias("row_id"), uuid_key(F.col(source.reference)).alias("key"), micros(F.col(source.time)).alias("time")
        ).where(F.col("key").isNotNull())
        part = part.select("source", "row_id", "time", *_hashes("key"))
        refs = part if refs is None else refs.unionAll(part)
    ranges = max(1, -(-parents.count() // PARENTS_PER_RANGE))
    # one row per range comes back, so the driver's share is the number of ranges
    sizes = {r["range"]: r["n"] for r in refs.groupBy(_range_of(ranges).alias("range")).agg(F.count("*").alias("n")).collect()}
    slices = [max(1, -(-sizes.get(k, 0) // REFERENCES_PER_SLICE)) for k in range(ranges)]
    width = F.element_at(F.array(*[F.lit(n) for n in slices]), F.col("range") + 1) if len(set(slices)) > 1 else F.lit(slices[0])
    held = named.withColumn("range", _range_of(ranges)).withColumn("slice", F.explode(F.sequence(F.lit(0), width - 1)))
    asked = refs.withColumn("range", _range_of(ranges)).withColumn("slice", F.pmod(F.xxhash64("source", "row_id"), width).cast("int"))
    names = [s.name for s in sources]

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(["h1", "h2"], kind="stable", ignore_index=True)
        h1, h2 = right["h1"].to_numpy(), right["h2"].to_numpy()
        want1, want2 = left["h1"].to_numpy(), left["h2"].to_numpy()
        at = np.searchsorted(h1, want1)
        found = np.full(len(left), -1, dtype=np.int64)
        alive = np.arange(len(left))
        while len(alive) and len(h1):  # parents that share h1 are looked at one after another
            pos = at[alive]
            alive = alive[pos < len(h1)]
            alive = alive[h1[at[alive]] == want1[alive]]
            hit = h2[at[alive]] == want2[alive]
            found[alive[hit]] = at[alive[hit]]
            alive = alive[~hit]
            at[alive] += 1
        time = left["time"].to_numpy(dtype="float64", na_value=np.nan)
        if len(h1):
            known = found >= 0
            deleted = known & right["deleted"].to_numpy(dtype=bool)[np.maximum(found, 0)]
            since = right["since"].to_numpy(dtype="float64", na_value=np.nan)[np.maximum(found, 0)]
            late = known & ~deleted & (since > time)
        else:
            known = deleted = late = np.zeros(len(left), dtype=bool)
        miss = ~known | deleted | late
        reason = np.where(~known, "missing", np.where(deleted, "deleted", "late"))[miss]
        when = left["time"].to_numpy(dtype="float64", na_value=np.nan)[miss]
        month = np.where(np.isnan(when), np.datetime64("NaT"), np.nan_to_num(when).astype("int64").astype("datetime64[us]")).astype("datetime64[M]")
        period = pd.Series(month.astype(str), dtype=object).where(~np.isnat(month), None)
        return pd.DataFrame(
            {"source_table": np.array(names, dtype=object)[left["source"].to_numpy()[miss]], "row_id": left["row_id"].to_numpy()[miss], "period": period.to_numpy(), "reason": reason.astype(object)}
        )

    return (
        asked.groupBy("range", "slice")
        .cogroup(held.groupBy("range", "slice"))
        .applyInPandas(lambda a, b: probe(a, b), "source_table string, row_id bigint, period string, reason string")
    )


def orphan_report(found: DataFrame) -> DataFrame:
    """(source_table, period, reason, orphans): misses per table, month and reason."""
    return found.groupBy("source_table", "period", "reason").agg(F.count("*").alias("orphans"))
