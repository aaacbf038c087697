"""Connected components against union-find."""

import random

from marlstone.operators import components as steps
from marlstone.operators.components import components


def union_find(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(parent)}


def test_random_graphs_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5200)] + [(7, 7), (9999, 9999)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == union_find(edges)


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([("x", "y"), ("y", "x"), ("x", "y"), (None, "q"), ("q", None)], "a string, b string")
    assert {tuple(r) for r in components(df).collect()} == {("x", "x"), ("y", "x")}
    assert components(df.where("false")).count() == 0


def test_settled_edges_take_no_step(spark, monkeypatch):
    taken = []
    step = steps._large_star
    monkeypatch.setattr(steps, "_large_star", lambda state: taken.append(1) or step(state))
    star = [(0, k) for k in range(1, 50)] + [(100, 101), (7, 7)]
    assert {r["node"]: r["component"] for r in components(spark.createDataFrame(star, "a bigint, b bigint")).collect()} == union_find(star)
    assert not taken
    for edges in ([(0, 2), (1, 2)], [(0, 1), (1, 2)]):  # a node with two smaller neighbours, a neighbour with a smaller one
        taken.clear()
        assert {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == union_find(edges)
        assert len(taken) == 1
