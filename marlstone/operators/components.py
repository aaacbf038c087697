"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint


def components(edges: DataFrame, left: str = "a", right: str = "b", rounds: int = 30) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that it is joined to.

    Each step replaces edges by edges to the smallest neighbour, with minima that are aggregated before
    the shuffle, so a node with very many neighbours costs no more than its edges. Edges with a null end
    join nothing; a loop makes its node a component of its own. No edge leaves an empty result. Lineage
    is cut after every round in the shared checkpoint folder.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    alone = pairs.where("u = v").select(F.col("u").alias("node"))
    state = checkpoint(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        if _settled(state):
            break
        state = checkpoint(_small_star(_large_star(state)))
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    joined = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component"))
    loops = alone.select("node", F.col("node").alias("component"))
    return joined.unionAll(roots).unionAll(loops).groupBy("node").agg(F.min("component").alias("component"))


def _settled(state: DataFrame) -> bool:
    """Whether each node has one smaller neighbour or none, and those with none are the neighbours: what no step changes."""
    ends = state.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(state.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down > 0 and up > 0)").isEmpty()


def _large_star(state: DataFrame) -> DataFrame:
    both = state.unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(state: DataFrame) -> DataFrame:
    least = state.groupBy("u").agg(F.min("v").alias("m"))
    moved = state.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
