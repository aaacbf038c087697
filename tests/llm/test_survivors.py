"""Survivors: decisions, skyline against brute force, filled fields, edge cases."""

import random

from pyspark.sql import functions as F

from marlstone.llm.survivors import decided_edges, duplicate_groups, layered, measured, skyline, survivor_records, survivors

A, B, C, D, E = (f"0000000{k}-0000-4000-8000-000000000000" for k in range(1, 6))
DECISION = "canonical_entity_id string, duplicate_entity_id string, decision_status string, evidence string, created_at timestamp_ntz, group_id string"


def decisions(spark, rows):
    return spark.createDataFrame(rows, "canonical_entity_id string, duplicate_entity_id string, decision_status string, evidence string, created string, group_id string").withColumn("created_at", F.col("created").cast("timestamp_ntz")).drop("created")


def test_latest_decision_and_shapes_of_evidence(spark):
    rows = [
        (A, B, "APPLIED", "{}", "2024-01-01 00:00:00", "x"), (A, B, "BLOCKED", "{}", "2024-02-01 00:00:00", "x"),
        (B, C, "CANDIDATE", None, None, "x"), (C, D.upper(), "APPLIED", '"{\\"member_ids\\": [\\"%s\\", \\"%s\\"]}"' % (C, E.upper()), "2024-01-01 00:00:00", "x"),
        (A, A, "APPLIED", '{"members": ["%s", "%s"], "size": 2}' % (A, B), "2023-01-01 00:00:00", "x"),
        (A, A, "APPLIED", '{"memberIds": ["%s", "0000' % A, "2024-01-01 00:00:00", "x"), (None, None, "APPLIED", "broken", None, "x"),
    ]
    df = decisions(spark, rows)
    assert {frozenset(r) for r in decided_edges(df).collect()} == {frozenset((B, C)), frozenset((C, D)), frozenset((C, E))}
    assert {tuple(r) for r in duplicate_groups(df).collect()} == {(x, B) for x in (B, C, D, E)}
    assert duplicate_groups(df.where("false")).count() == 0


SCHEMA = "g string, usable int, trust int, recency bigint, row_id bigint, country_code string"


def test_skyline_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randrange(2), rng.randrange(-1, 6), rng.randrange(6), k, rng.choice([None, "US", "DE"])) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = set()
    for r in rows:
        beaten = any(s[0] == r[0] and all(x >= y for x, y in zip(s[1:4], r[1:4], strict=True)) and s[1:4] != r[1:4] for s in rows)
        if not beaten:
            want.add(r[:4])
    assert {(r["g"], r["usable"], r["trust"], r["best"]["recency"]) for r in skyline(df, ["g"], []).collect()} == want
    best = {}
    for r in rows:
        if r[1] and (r[2], r[3], -r[4]) > best.get(r[0], (-9, 0, 0)):
            best[r[0]] = (r[2], r[3], -r[4])
    assert {(r["g"], r["row_id"]) for r in survivors(df, ["g"]).collect()} == {(g, -v[2]) for g, v in best.items()}


def test_fields_filled_from_later_layers(spark):
    df = spark.createDataFrame([("a", 1, 9, 9, 1, None), ("a", 1, 5, 5, 2, "US"), ("a", 1, 4, 4, 3, "DE"), ("b", 1, 1, 1, 4, None)], SCHEMA)
    assert sorted(map(tuple, survivor_records(df, ["g"], ["country_code"]).collect())) == [("a", 1, "US"), ("b", 4, None)]
    assert survivors(df.where("false"), ["g"]).count() == 0


def test_member_lists_as_arrays_and_as_texts(spark):
    lists = ['["%s", "%s"]' % (B, C), '"%s,%s"' % (B, C), '"%s;%s"' % (B, C), '"%s %s"' % (B, C), "['%s', '%s']" % (B, C), '[\\"%s\\", \\"%s\\"]' % (B, C), '["%s", "%s", "0000' % (B, C)]
    for name in ("member_ids", "memberIds", "MEMBER_IDS", "members"):
        for text in lists:
            df = decisions(spark, [(A, A, "APPLIED", '{"size": 2, "%s": %s,\n "score": [1], "seen_by": "%s"}' % (name, text, D), "2024-01-01 00:00:00", "x")])
            assert {frozenset(r) for r in decided_edges(df).collect()} == {frozenset((A, B)), frozenset((A, C))}, (name, text)


def test_layers_against_peeling(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.randrange(2), rng.randrange(-1, 6), rng.randrange(9), k, rng.choice([None, None, "US", "DE", "CN"])) for k in range(240)]
    df = spark.createDataFrame(rows, SCHEMA)
    cell = {r: (r[0], r[1] * (1 + (r[5] is not None)), r[2], r[3]) for r in rows}
    layer, left, n = {}, set(cell.values()), 0
    while left:
        n += 1
        front = {c for c in left if not any(s[0] == c[0] and s != c and all(x >= y for x, y in zip(s[1:], c[1:], strict=True)) for s in left)}
        layer |= dict.fromkeys(front, n)
        left -= front
    assert {(r["g"], r["complete"], r["trust"], r["recency"]): r["layer"] for r in layered(df, ["g"], ["country_code"]).collect()} == layer
    want = []
    for g in "abc":
        policy = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], -r[2], -r[3], r[4]))
        known = min((r for r in policy if r[5]), key=lambda r: layer[cell[r]])
        want.append((g, policy[0][4], policy[0][5] or known[5]))
    assert sorted(map(tuple, survivor_records(df, ["g"], ["country_code"]).collect())) == want


def test_field_of_an_earlier_layer_goes_before_a_more_trusted_one(spark):
    # equally complete: 1 knows the source, 3 and 4 the country
    rows = [("a", 1, 90, 10, 1, None, "s"), ("a", 1, 80, 5, 2, None, "t"), ("a", 1, 75, 1, 3, "US", None), ("a", 1, 70, 9, 4, "CN", None)]
    df = spark.createDataFrame(rows, SCHEMA + ", source string")
    assert [tuple(r) for r in survivor_records(df, ["g"], ["country_code", "source"]).collect()] == [("a", 1, "CN", "s")]


def test_a_less_complete_record_dominates_no_fuller_one(spark):
    df = spark.createDataFrame([("a", 1, 90, 10, 1, None), ("a", 1, 75, 1, 3, "US"), ("a", 1, 70, 9, 4, "CN")], SCHEMA)
    assert {r["best"]["row_id"]: r["layer"] for r in layered(df, ["g"], ["country_code"]).collect()} == {1: 1, 3: 1, 4: 1}
    assert [tuple(r) for r in survivor_records(df, ["g"], ["country_code"]).collect()] == [("a", 1, "US")]


def test_measures(spark):
    rows = [(1, A, "T", "x", 0.95, "2024-01-01", "2024-02-01"), (2, A, "T", "-", 95.0, "2024-01-01", "2023-12-01"), (3, A, "T", "a*b", None, "2024-01-01", None), (4, A, "T", " ", 0.5, None, "2026-06-30"), (5, A, "T", "ok", 0.5, "2024-01-01", "2026-07-01")]
    df = spark.createDataFrame(rows, "row_id bigint, entity_id string, identifier_type string, identifier_value string, confidence_score double, f string, l string")
    df = df.select("*", F.col("f").cast("timestamp_ntz").alias("first_seen_at"), F.col("l").cast("timestamp_ntz").alias("last_seen_at"), F.lit("n").alias("normalized_value"), F.lit(None).cast("string").alias("country_code"), F.lit("s").alias("source"))
    got = {r["row_id"]: (r["usable"], r["trust"], r["recency"] > 0) for r in measured(df, "2026-06-30").collect()}
    assert got == {1: (1, 9500, True), 2: (0, 9500, False), 3: (0, -1, False), 4: (0, 5000, True), 5: (1, 5000, False)}
