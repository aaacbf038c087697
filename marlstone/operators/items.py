"""Items of versioned scopes: what a delivery says of each, their current state, compaction, reconciliation, dependencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint


def item_observations(current: DataFrame, incoming: DataFrame, keys: Sequence[str], rank: str, status: str, content: str) -> DataFrame:
    """(keys, rank, before, after, kind) of the items that a delivery shows first or changed.

    kind is FIRST_OBSERVED, STATUS_CHANGED (the status differs) or ITEM_DETAILS_CHANGED (only the content hash
    does); items of a lower rank than the current one and unchanged ones give no row. Both sides have one row per
    key; nulls equal nulls.
    """
    held = current.select(*keys, F.col(rank).alias("__rank"), F.col(status).alias("__status"), F.col(content).alias("__content"), F.lit(True).alias("__held"))
    rows = incoming.join(held, list(keys), "left")
    differs = ~F.col(status).eqNullSafe(F.col("__status"))
    kind = F.when(F.col("__held").isNull(), "FIRST_OBSERVED").when(differs, "STATUS_CHANGED").otherwise("ITEM_DETAILS_CHANGED")
    seen = F.col("__held").isNull() | ((F.col("__rank") <= F.col(rank)) & (differs | ~F.col(content).eqNullSafe(F.col("__content"))))
    return rows.where(seen).select(*keys, rank, F.col("__status").alias("before"), F.col(status).alias("after"), kind.alias("kind"))


def upserted_items(current: DataFrame, incoming: DataFrame, keys: Sequence[str], rank: str, source: str) -> DataFrame:
    """The current items after a delivery: the higher rank gives the columns (the delivery on a tie), first_<source> stays that of the first."""
    first = f"first_{source}"
    both = current.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn(first, F.col(source)).withColumn("__new", F.lit(1)))
    values = [c for c in both.columns if c not in (*keys, first, "__new")]
    order = F.struct(F.coalesce(F.col(rank), F.lit(-(2**62))).alias("r"), "__new")
    picked = both.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("v"), F.min_by(F.struct(F.col(first).alias("f")), F.col("__new")).alias("f"))
    return picked.select(*keys, *[F.col("v")[c].alias(c) for c in values], F.col("f.f").alias(first))


def compacted(df: DataFrame, identity: Sequence[str], order: Sequence[str], strict: bool = True) -> DataFrame:
    """One row per identity: the greatest by order (null least), which must be one content.

    Several contents of one order are an error where strict, else the greatest content is taken and `contents`
    tells how many there were. Aggregates only, so an identity of very many rows is no sorted group.
    """
    values = [c for c in df.columns if c not in (*identity, *order)]
    rows = df.withColumn("__o", F.struct(*order)).withColumn("__v", F.struct(*values))
    best = rows.groupBy(*identity).agg(F.max("__o").alias("__m"))
    kept = rows.join(best, list(identity)).where(F.col("__o").eqNullSafe(F.col("__m")))
    out = kept.groupBy(*identity).agg(F.max(F.struct("__o", "__v")).alias("x"), F.count_distinct("__v").alias("contents"))
    if strict:
        out = out.where(F.when(F.col("contents") > 1, F.raise_error(F.lit("several contents of one identity and order"))).otherwise(F.lit(True)).cast("boolean"))
    return out.select(*identity, *[F.col("x.__o")[c].alias(c) for c in order], *[F.col("x.__v")[c].alias(c) for c in values], "contents")


def set_fingerprints(df: DataFrame, keys: Sequence[str], identity: Sequence[Column], name: Column) -> DataFrame:
    """(keys, members, set_hash, names): per key the number of rows, an order-free hash of their identities and their distinct names in order.

    The sorted hashes of a key are one text, so a key's members must fit into a task, as the owners of a case do.
    """
    hashed = F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in identity]), 256)
    spaced = F.trim(F.regexp_replace(name, r"\s+", " "))
    return df.groupBy(*keys).agg(
        F.count("*").alias("members"), F.sha2(F.array_join(F.array_sort(F.collect_list(hashed)), "|"), 256).alias("set_hash"), F.array_join(F.array_sort(F.collect_set(F.when(spaced != "", spaced))), "; ").alias("names")
    )


def reconciled(before: DataFrame, delivered: DataFrame, after: DataFrame, keys: Sequence[str], content: str) -> DataFrame:
    """One row of counts: keys before, delivered and after, added, changed, unchanged, omitted but preserved, and lost, which should be 0."""
    held = lambda df, name: df.select(*keys, F.col(content).alias(name), F.lit(True).alias(f"in_{name}"))
    all_ = held(before, "b").join(held(delivered, "d"), list(keys), "full").join(held(after, "a"), list(keys), "full")
    there = {n: F.col(f"in_{n}").isNotNull() for n in "bda"}
    both = there["b"] & there["d"]
    tests = {
        "before": there["b"], "delivered": there["d"], "after": there["a"], "added": ~there["b"] & there["d"], "changed": both & ~F.col("b").eqNullSafe(F.col("d")),
        "unchanged": both & F.col("b").eqNullSafe(F.col("d")), "preserved": there["b"] & ~there["d"] & there["a"], "lost": (there["b"] | there["d"]) & ~there["a"],
    }
    return all_.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def named_or_code(df: DataFrame, keys: Sequence[str], name: str, code: str, order: Sequence[str]) -> DataFrame:
    """(keys, display, named): the latest name that is not blank, else the code."""
    known = F.when(F.trim(name) != "", F.trim(name))
    latest = F.max(F.when(known.isNotNull(), F.struct(*order, known.alias("n"))))["n"]
    return df.groupBy(*keys).agg(F.coalesce(latest, F.max(code)).alias("display"), latest.isNotNull().alias("named"))


def overlaid(base: DataFrame, patch: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, fields): the patch's known values over the base's, for the keys of either; one row per key on each side."""
    b, p = base.select(*keys, *[F.col(f).alias(f"__b_{f}") for f in fields]), patch.select(*keys, *[F.col(f).alias(f"__p_{f}") for f in fields])
    return b.join(p, list(keys), "full").select(*keys, *[F.coalesce(f"__p_{f}", f"__b_{f}").alias(f) for f in fields])


def appended(stored: DataFrame, bundle: DataFrame, domain: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to append, counts): facts of several domains that are not stored yet, and inserted and replayed facts per domain."""
    once = bundle.dropDuplicates([domain, key])
    known = once.join(stored.select(domain, key, F.lit(True).alias("__stored")).distinct(), [domain, key], "left")
    counts = known.groupBy(domain).agg(F.count_if(F.col("__stored").isNull()).alias("inserted"), F.count_if(F.col("__stored").isNotNull()).alias("replayed"))
    return known.where("__stored is null").drop("__stored"), counts


def levels(edges: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """(node, level) of a graph of dependencies: 0 where nothing comes before, else one more than the highest level before.

    Nodes are taken off level by level, each in one join, so it takes as many rounds as the longest chain; a
    circle is an error. Lineage is cut in each round.
    """
    left = edges.select(F.col(before).alias("b"), F.col(after).alias("a")).where("a is not null and b is not null").distinct()
    nodes = checkpoint(left.select(F.col("b").alias("node")).union(left.select(F.col("a").alias("node"))).distinct())
    done, level = None, 0
    while not nodes.isEmpty():
        free = nodes.join(left.select(F.col("a").alias("node")).distinct(), "node", "left_anti").withColumn("level", F.lit(level))
        free = checkpoint(free)
        if free.isEmpty():
            raise ValueError("the dependencies hold a circle")
        done = free if done is None else done.unionAll(free)
        taken = free.select("node")
        nodes = checkpoint(nodes.join(taken, "node", "left_anti"))
        left = checkpoint(left.join(taken.withColumnRenamed("node", "b"), "b", "left_anti").select("b", "a"))
        level += 1
    return done if done is not None else nodes.withColumn("level", F.lit(0))
