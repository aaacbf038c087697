"""Relational operators on small tables, and the registry against its SQL."""

import datetime as dt
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from marlstone.functions import dates, hashing, json_paths, text
from marlstone.operators import history, rules, selection, summaries, versioning


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()), key=str)


def test_latest_by_tombstones_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x", 0), ("a", 2, "y", 0), ("b", 1, "x", 0), ("b", 2, "y", 1), ("c", None, "n", 0), ("c", None, "n", 0)], "k string, rank int, v string, del int")
    assert rows(versioning.latest_by(df, ["k"], ["rank"], F.col("del") == 1), "k", "v") == [("a", "y"), ("c", "n")]
    assert versioning.latest_by(df.where("false"), ["k"], ["rank"]).count() == 0


def test_merge_takes_equal_ranks_and_keeps_first_provenance(spark):
    schema = "k string, rank int, v string, first_source string"
    current = spark.createDataFrame([("a", 5, "old", "p1"), ("b", 9, "new", "p1")], schema)
    incoming = spark.createDataFrame([("a", 5, "again", "p2"), ("b", 7, "late", "p2"), ("c", 1, "first", "p2")], schema)
    merged = versioning.rank_guarded_merge(current, incoming, ["k"], "rank", ["first_source"])
    assert rows(merged, "k", "v", "first_source") == [("a", "again", "p1"), ("b", "new", "p2"), ("c", "first", "p2")]


def test_events_need_a_higher_rank(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, rank int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("b", 3, "z"), ("c", 1, "n")], "k string, rank int, v string")
    assert rows(versioning.true_delta_events(old, new, ["k"], "rank", {"v": "V_CHANGED"})) == [("b", "V_CHANGED", None, "z")]


def test_observations_fail_closed(spark):
    held = spark.createDataFrame([(1, "h1")], "pos int, h string")
    assert rows(versioning.append_observations(held, spark.createDataFrame([(1, "h1"), (2, "h2")], "pos int, h string"), ["pos"], "h")) == [(2, "h2")]
    with pytest.raises(Exception, match="another content"):
        versioning.append_observations(held, spark.createDataFrame([(1, "h9")], "pos int, h string"), ["pos"], "h").collect()


def test_publishing_order_does_not_matter(spark):
    packages = [(rank, spark.createDataFrame([("k", rank, f"v{rank}")], "k string, rank int, v string")) for rank in (3, 1, 2)]
    assert rows(versioning.publish_in_order(packages, ["k"], "rank")) == [("k", 3, "v3")]


def test_stale_guard_and_closure(spark):
    current = spark.createDataFrame([("s", 10), ("t", 5)], "s string, t int")
    assert rows(versioning.stale_guard(current, spark.createDataFrame([("s", 9), ("t", 5), ("u", 1)], "s string, t int"), "s", "t")) == [("t", 5), ("u", 1)]
    members = spark.createDataFrame([("c", "o", "m1"), ("c", "o", "m2"), ("d", "o", "m1")], "c string, r string, m string")
    assert rows(versioning.role_closure(members, members.where("c = 'c' and m = 'm2'"), ["c", "r"], ["m"])) == [("c", "o", "m1")]


def test_same_content_sees_repetition(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert versioning.same_content(df, df.orderBy(F.desc("x"))) and not versioning.same_content(df, df.distinct())


def test_pages_lose_nothing(spark):
    df = spark.range(57).select((F.col("id") % 5).alias("r"), F.col("id").alias("k"))
    seen, cursor = [], None
    while True:
        page = history.feed_page(df, ["r", "k"], cursor, 10).orderBy("r", "k").collect()
        seen += [(r["r"], r["k"]) for r in page]
        cursor = seen[-1]
        if not page[0]["has_more"]:
            break
    assert seen == sorted((k % 5, k) for k in range(57))


def test_predecessors_of_one_rank(spark):
    df = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("s", 2, "c")], "s string, r int, v string")
    assert rows(history.previous_as_of(df, ["s"], F.col("r"), ["v"]), "v", "previous_v") == [("a", None), ("b", "a"), ("c", "a")]


def test_hot_subjects_are_cut_without_a_trace(spark):
    import random

    rng = random.Random(4)
    data = [("hot" if k % 3 else f"s{k % 5}", rng.randrange(60), k, rng.choice("xyz")) for k in range(400)]
    df = spark.createDataFrame(data, "s string, r int, id int, v string")
    for run in (
        lambda n: history.previous_as_of(df, ["s"], F.col("r"), ["v"], hot_rows=n),
        lambda n: history.with_changes(df, ["s"], ["r", "id"], {"v": "V_CHANGED"}, hot_rows=n).withColumn("changes", F.to_json("changes")),
        lambda n: history.islands(df, ["s"], "id", F.col("v") == "x", hot_rows=n),
    ):
        assert rows(run(25)) == rows(run(10**6))


def test_examples_are_few_and_smallest(spark):
    df = spark.createDataFrame([("a", k % 50) for k in range(300)] + [("b", 1), ("c", None)], "k string, e int")
    assert rows(summaries.bounded_examples(df, ["k"], "e", 3)) == [("a", [0, 1, 2]), ("b", [1])]


def test_key_ranges_never_split_a_key(spark):
    df = spark.createDataFrame([(k % 7,) for k in range(100)], "k int")
    out = rows(selection.key_ranges(df, "k", 30), "lower", "upper", "rows")
    assert sum(r[2] for r in out) == 100 and all(a[1] < b[0] for a, b in zip(out, out[1:], strict=False))


def test_evidence_counts_once(spark):
    df = spark.createDataFrame([("s", "US", "phone", 0.94), ("s", "US", "phone", 0.86), ("s", "DE", "city", 0.6), ("t", "FR", "a", 0.8), ("t", "DE", "b", 0.8)], "s string, c string, kind string, w double")
    out = {r["s"]: (r["c"], r["confidence"], r["decision"]) for r in summaries.decide_evidence(df, "s", "c", "kind", "w", 0.86, 0.15, 0.7).collect()}
    assert out == {"s": ("US", 0.94, "ACCEPTED"), "t": ("DE", 0.8, "CONFLICT")}


def test_rules_without_a_match(spark):
    made = spark.createDataFrame([], "rule_id string, priority int, status_codes array<string>, any_events array<string>, all_events array<string>, label string, confidence double")
    out = rules.interpret(spark.createDataFrame([("s", "1", ["x"])], "s string, st string, ev array<string>"), made, "s", "st", "ev")
    assert rows(out, "label", "candidates") == [("NONE", 0)]


def test_functions(spark):
    one = spark.createDataFrame([("２０２０年02月03日", "20200200", "G123456a", " A@B.Test ", "0086 138-0013-8000", "https://www.x.example/p", "Ａ b\x07  N/A", '{"a/b": {"c": [1, 2]}}')], "d string, u string, n string, e string, p string, w string, t string, j string")
    r = one.select(
        dates.digits_date(F.lit("2020-02-03 x")).alias("d"),
        dates.compact_date(F.col("u")).alias("u"),
        text.application_number(F.col("n")).alias("n"),
        text.email(F.col("e")).alias("e"),
        text.phone(F.col("p")).alias("p"),
        text.phone_class(F.col("p")).alias("pc"),
        text.website_host(F.col("w")).alias("w"),
        text.nfkc(F.col("t")).alias("t"),
        json_paths.json_pointer(F.col("j"), "/a~1b/c/1").alias("j"),
        hashing.uuid5(str(uuid.NAMESPACE_URL), F.lit("näme")).alias("id"),
        dates.add_years(F.lit("2024-02-29").cast("date"), 1).alias("y"),
    ).first()
    assert (r["d"], r["u"], r["e"], r["p"], r["pc"], r["w"], r["j"]) == (dt.date(2020, 2, 3), None, "a@b.test", "+8613800138000", "MOBILE", "x.example", "2")
    assert (r["n"]["root"], r["n"]["suffix"], r["n"]["route"], r["n"]["derived"]) == ("123456", "A", "INTERNATIONAL", True)
    assert r["t"] == "A b\x07  N/A" and r["id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "näme")) and r["y"] == dt.date(2025, 2, 28)


def _plain(value):
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - {k for k in registry.queries() if k[0] == "p" and k[1:2].isdigit()} | {"p2_found", "p2_report"}))
def test_registry_against_sql(spark, data, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in os.listdir(data):
        con.execute(f"create view {file.split('.')[0]} as select * from read_parquet('{data}/{file}')")
    df = registry.queries()[name](spark, data)
    columns = sorted(df.columns)
    answer = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    want = sorted(tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in answer.fetchall())
    assert sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    assert registry.entry(spark).count() > 0
