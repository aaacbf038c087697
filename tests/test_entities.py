"""Dedupe, items, countries and repaired cells: brute force, edge cases, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions import countries
from marlstone.operators import dedupe, items
from marlstone.sources import archives


def test_entity_merges_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"e{k:03}", rng.choice(["ada", "bo", "", None]), rng.choice(["street1", "street2", "short"]), rng.choice(["", "X1", "X2"])) for k in range(80)]
    channels = [(r[0], "PHONE", rng.choice(["1", "2", "3", "", None])) for r in rows for _ in range(2)]
    group = {r[0]: r[0] for r in rows}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in rows:
        for b in rows:
            if a[1] and a[1] == b[1] and (len(a[2]) > 6 and a[2] == b[2] or {c[2] for c in channels if c[0] == a[0] and c[2]} & {c[2] for c in channels if c[0] == b[0] and c[2]}):
                x, y = sorted((root(a[0]), root(b[0])))
                group[y] = x
    df = spark.createDataFrame(rows, "id string, name string, address string, code string").withColumn("address", F.when(F.length("address") > 6, F.col("address")).otherwise("abc"))
    ch = spark.createDataFrame(channels, "id string, kind string, value string").withColumn("name", F.lit("clash")).drop("name")
    edges = dedupe.entity_edges(df.select("id", "name", "address"), ch)
    out = dedupe.merge_decisions(df.select("id", "code"), edges, {"CODES": dedupe.several(F.col("code"))}, ["code"]).collect()
    want = {}
    for r in rows:
        want.setdefault(root(r[0]), []).append(r)
    want = {k: v for k, v in want.items() if len(v) > 1}
    assert len(out) == sum(len(v) - 1 for v in want.values())
    for r in out:
        members = want[root(r["duplicate"])]
        best = max(members, key=lambda m: (m[3], m[0]))
        assert r["canonical"] == best[0] and (r["status"] == "BLOCKED") == (len({m[3] for m in members if m[3]}) > 1) and r["evidence"]
    assert dedupe.merge_decisions(df.where("false").select("id", "code"), dedupe.entity_edges(df.where("false").select("id", "name", "address"), ch.where("false")), {}, ["code"]).count() == 0


def test_persons_of_one_entity_and_name(spark):
    persons = spark.createDataFrame([("a", "e", "ann"), ("b", "e", "ann"), ("c", "f", "ann"), ("d", "e", None)], "id string, entity string, name string")
    channels = spark.createDataFrame([(i, "EMAIL", "x@y.z") for i in "abcd"], "id string, kind string, value string")
    assert [(r["a"], r["b"]) for r in dedupe.person_edges(persons, channels).collect()] == [("a", "b")]


ITEM = "k string, rank bigint, status string, content string, source string"


def test_items(spark):
    current = spark.createDataFrame([("a", 1, "x", "1", "p"), ("b", 1, "x", "1", "p"), ("c", 9, "x", "1", "p"), ("d", 1, None, "1", "p"), ("e", 1, "x", "1", "p")], ITEM)
    incoming = spark.createDataFrame([("a", 2, "y", "2", "q"), ("b", 2, "x", "2", "q"), ("c", 2, "y", "2", "q"), ("d", 2, None, "1", "q"), ("n", 2, "x", "1", "q")], ITEM)
    got = {(r["k"], r["kind"]) for r in items.item_observations(current, incoming, ["k"], "rank", "status", "content").collect()}
    assert got == {("a", "STATUS_CHANGED"), ("b", "ITEM_DETAILS_CHANGED"), ("n", "FIRST_OBSERVED")}
    after = items.upserted_items(current.withColumn("first_source", F.col("source")), incoming, ["k"], "rank", "source")
    assert {(r["k"], r["rank"], r["source"], r["first_source"]) for r in after.collect()} == {("a", 2, "q", "p"), ("b", 2, "q", "p"), ("c", 9, "p", "p"), ("d", 2, "q", "p"), ("e", 1, "p", "p"), ("n", 2, "q", "q")}
    assert tuple(items.reconciled(current, incoming, after, ["k"], "content").first()) == (5, 5, 6, 1, 3, 1, 1, 0)
    assert tuple(items.reconciled(current.where("false"), incoming.where("false"), after.where("false"), ["k"], "content").first()) == (0,) * 8


def test_compaction_fingerprints_names_overlay_and_bundles(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1, "x"), ("a", None, 9, "y"), ("a", "2024-01-01", 0, "z"), ("a", "2024-01-01", 1, "x"), ("b", None, None, None)], "id string, day string, entry int, v string")
    assert {tuple(r) for r in items.compacted(df, ["id"], ["day", "entry"]).collect()} == {("a", "2024-01-01", 1, "x", 1), ("b", None, None, None, 1)}
    doubled = df.unionAll(spark.createDataFrame([("a", "2024-01-01", 1, "other")], df.schema))
    with pytest.raises(Exception, match="several contents"):
        items.compacted(doubled, ["id"], ["day", "entry"]).collect()
    prints = lambda d: {r["id"]: (r["members"], r["set_hash"], r["names"]) for r in items.set_fingerprints(d, ["id"], [F.col("v")], F.col("v")).collect()}
    assert prints(df) == prints(df.orderBy(F.desc("v"))) and prints(df)["a"][2] == "x; y; z" and prints(df)["b"][2] == ""
    named = items.named_or_code(df.withColumn("c", F.lit("C1")), ["id"], "v", "c", ["day", "entry"])
    assert {tuple(r) for r in named.collect()} == {("a", "x", True), ("b", "C1", False)}
    base, patch = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "k int, x string, y string"), spark.createDataFrame([(2, None, "d"), (3, "e", None)], "k int, x string, y string")
    assert {tuple(r) for r in items.overlaid(base, patch, ["k"], ["x", "y"]).collect()} == {(1, "a", "b"), (2, "c", "d"), (3, "e", None)}
    fresh, counts = items.appended(base.select(F.lit("d").alias("dom"), F.col("x").alias("h")), patch.select(F.lit("d").alias("dom"), F.coalesce("x", F.lit("a")).alias("h")), "dom", "h")
    assert [r["h"] for r in fresh.collect()] == ["e"] and tuple(counts.first()) == ("d", 1, 1)


def test_levels_of_dependencies(spark):
    edges = [("a", "b"), ("b", "c"), ("a", "c"), ("x", "c"), ("c", "d"), (None, "z")]
    df = spark.createDataFrame(edges, "before string, after string")
    assert {tuple(r) for r in items.levels(df).collect()} == {("a", 0), ("x", 0), ("b", 1), ("c", 2), ("d", 3)}
    with pytest.raises(ValueError, match="circle"):
        items.levels(spark.createDataFrame([("a", "b"), ("b", "a")], "before string, after string"))
    assert items.levels(df.where("false")).count() == 0


def test_countries(spark):
    rows = [("China", "+8613800138000", "x.co.uk", "广东省深圳市南山区"), ("美 国", "001 212 5550100", "www.a.de", "北京市朝阳区"), ("Zz", "0571-1", "a.com", "香港九龙"), (None, None, None, None), ("nowhere", "+999", "b", "美国纽约"), ("u.s.a.", "+1", "a.jp", "某路"), ("ＵＫ", "+852 1", "", " ")]
    df = spark.createDataFrame(rows, "c string, p string, h string, a string")
    got = df.select(countries.country_code(F.col("c")), countries.country_of_phone(F.col("p")), countries.country_of_host(F.col("h")), countries.infer_geo(F.col("a"))).collect()
    assert [r[0] for r in got] == ["CN", "US", "ZZ", "", "", "US", "GB"]
    assert [r[1] for r in got] == ["CN", "US", "", "", "", "US", "HK"]
    assert [r[2] for r in got] == ["GB", "DE", "", "", "", "JP", ""]
    assert [tuple(r[3]) for r in got] == [("CN", "CN-GD", "广东省深圳市", 0.85), ("CN", "CN-BJ", "北京市", 0.95), ("HK", "", "香港", 0.95), ("", "", "", 0.0), ("US", "", "", 0.9), ("CN", "", "", 0.6), ("", "", "", 0.0)]


def test_cells_in_the_wrong_code_page(spark):
    text = "上海商标代理有限公司"
    wrong = [text.encode().decode(page, "replace") for page in ("latin-1", "gb18030")]
    df = spark.createDataFrame([(k, c) for k, c in enumerate([text, wrong[0], None, "", "café", wrong[1]])], "k int, c string")
    got = [r[0] for r in df.orderBy("k").select(archives.repaired_cells("c")).collect()]
    assert got[:5] == [text, text, None, "", "café"] and got[5].startswith("上海商标")


def test_latest_assignments_of_a_serial(spark):
    from marlstone.sources.registers import latest_assignments

    records = spark.createDataFrame([("1", "2", 1, "p1", "old"), ("1", "2", 2, "p2", "new"), ("3", "4", 1, "p1", "other")], "reel string, frame string, source_rank int, package_id string, conveyance string")
    parts = {
        "property": spark.createDataFrame([("1", "2", "p1", 1, "S1"), ("1", "2", "p1", 2, "S2"), ("1", "2", "p2", 2, "S2"), ("1", "2", "p2", 1, "S3"), ("3", "4", "p1", 1, "S9")], "reel string, frame string, package_id string, ordinal int, serial_number string"),
        "assignee": spark.createDataFrame([("1", "2", "p1", 1, "A"), ("1", "2", "p2", 1, "B")], "reel string, frame string, package_id string, ordinal int, name string"),
    }
    out = {(r["reel"], r["conveyance"]): ([x["serial_number"] for x in r["property"]], [x["name"] for x in r["assignee"] or []]) for r in latest_assignments(records, parts).collect()}
    assert out == {("1", "new"): (["S3", "S2"], ["B"]), ("3", "other"): (["S9"], [])}
    asked = lambda s: latest_assignments(records, parts, spark.createDataFrame([(s,)], "serial_number string")).count()
    assert (asked("S1"), asked("S2"), asked("S9"), asked("S0")) == (0, 1, 1, 0)  # S1 was taken out by the later delivery


def test_company_signals_and_profiles(spark):
    from marlstone.functions import text
    from marlstone.operators import summaries

    names = ["Acme Co., Ltd", "Acme Limited.", "甲乙有限公司；", "张三", "Incan Gold", "", None, "某某厂", "ACME LLC"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(text.company_signal(F.col("n"))).collect()] == [True, True, True, False, False, False, False, True, True]
    assert tuple(summaries.profile(df, ["n"]).first()) == ("n", 7, 1, 1, "ACME LLC", "甲乙有限公司；")
    assert tuple(summaries.profile(df.where("false"), ["n"]).first())[1:4] == (0, 0, 0)
