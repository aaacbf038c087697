"""Packed fields: shapes, edge cases, and a round trip over generated cells."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators.packed import DELIMITERS, KINDS, delimiter_scores, explode_packed, in_order, regular, unpack


def values(cell, field="phones"):
    return unpack(cell, KINDS[field], in_order(DELIMITERS, KINDS[field]))


@pytest.mark.parametrize(
    ("cell", "field", "expected"),
    [
        (None, "phones", []),
        ("", "phones", []),
        (" \t ", "phones", []),
        ("无", "phones", []),
        ("N/A", "websites", []),
        ("--", "emails", []),
        ("0571-1234567；0571-1234567", "phones", ["0571-1234567", "0571-1234567"]),
        ("+86 123 8696 6753//+86 123 8505 3561", "phones", ["+86 123 8696 6753", "+86 123 8505 3561"]),
        ("+1 555-0143, 0755-05397278", "phones", ["+1 555-0143", "0755-05397278"]),
        ("(0427) 03002121|0755-07431702", "phones", ["(0427) 03002121", "0755-07431702"]),
        ('"desk ""B"", 0316-0994 7673"', "phones", ['desk "B", 0316-0994 7673']),
        ('["+1 555-0179; 转 3", "(0610) 04899906"]', "phones", ["+1 555-0179; 转 3", "(0610) 04899906"]),
        ('{"a@b.test","c@d.test"}', "emails", ["a@b.test", "c@d.test"]),
        ('"IP; Dept <k@l.example>"', "emails", ["IP; Dept <k@l.example>"]),
        ("1. a@b.test; 2. c@d.test", "emails", ["a@b.test", "c@d.test"]),
        ("- a@b.test\n- c@d.test", "emails", ["a@b.test", "c@d.test"]),
        ("a@b.test, , c@d.test", "emails", ["a@b.test", "c@d.test"]),
        ("(1) https://p.example (2) n.example/index.html", "websites", ["https://p.example", "n.example/index.html"]),
        ("a.example<br>HTTP://g.test; www.n.example｜http://w.example", "websites", ["a.example", "HTTP://g.test", "www.n.example", "http://w.example"]),
        ('"http://p.example/list?c=1,2"; "d.example"', "websites", ["http://p.example/list?c=1,2", "d.example"]),
        ("'x@y.test", "emails", ["x@y.test"]),
    ],
)
def test_shapes(cell, field, expected):
    assert values(cell, field) == expected


def test_round_trip_of_generated_cells():
    rng = random.Random(7)
    for _ in range(400):
        field, make = rng.choice([("phones", lambda: f"0571-{rng.randrange(10**6, 10**7)}"), ("emails", lambda: f"u{rng.randrange(999)}@h{rng.randrange(99)}.test"), ("websites", lambda: f"http://www.h{rng.randrange(99)}.example/p?id={rng.randrange(9)}")])
        parts = [make() for _ in range(rng.randrange(1, 9))]
        form = rng.choice(["; ", "；", ", ", "，", "、", "|", "｜", "\n", "\t", "<br>", "quoted", "json"])
        cell = ",".join('"%s"' % p for p in parts) if form == "quoted" else '["' + '", "'.join(parts) + '"]' if form == "json" else form.join(parts)
        assert values(cell, field) == parts, cell


def test_long_cells_stay_linear_enough():
    parts = [f"u{k}@h.test" for k in range(3000)]
    assert unpack(";".join(parts), "email", ["semicolon"]) == parts
    assert unpack("x" * 200_000, "email", ["semicolon", "comma", "blank"]) == ["x" * 200_000]


def test_types():
    assert regular("+1 555-0118", "phone") and not regular("12631 125 12631 12599 1", "phone")
    assert regular("Legal <a@b.test>", "email") and not regular("a b", "email")
    assert not regular("http://a.test,http://b.test", "link")


def test_spark_operator_with_clashing_columns_and_repeats(spark):
    rows = [(1, "s", "0571-1234567;0571-7654321", None, 9, "x"), (1, "s", "0571-1234567;0571-7654321", None, 9, "x"), (2, None, " ", "a@b.test", 9, "y"), (None, "t", None, None, None, None)]
    df = spark.createDataFrame(rows, "row_id bigint, src string, phones string, emails string, pos int, value string")
    out = sorted(map(tuple, explode_packed(df, F.col("row_id"), F.col("src"), ["phones", "emails"]).collect()))
    assert out == sorted([(1, "phones", 1, "0571-1234567"), (1, "phones", 2, "0571-7654321")] * 2 + [(2, "emails", 1, "a@b.test")])
    empty = explode_packed(df.where("false"), F.col("row_id"), F.col("src"), ["phones", "emails"])
    assert empty.columns == ["row_key", "field", "pos", "value"] and empty.count() == 0


def test_scores_prefer_the_delimiter_in_use(spark):
    cells = spark.createDataFrame([("s", "phones", f"0571-123456{k}; 0571-765432{k}") for k in range(9)], "src string, field string, cell string")
    scores = {r["delimiter"]: r["score"] for r in delimiter_scores(cells, "src", "field", "cell").collect()}
    assert scores["semicolon"] > 0.9 and scores["semicolon"] > scores["blank"]


def split_by_source(spark, rows, field):
    df = spark.createDataFrame(rows, f"row_id bigint, src string, {field} string")
    out: dict = {}
    for r in sorted(explode_packed(df, F.col("row_id"), F.col("src"), [field]).collect(), key=lambda r: (r["row_key"], r["pos"])):
        out.setdefault(r["row_key"], []).append(r["value"])
    return out


def test_sources_split_one_cell_differently(spark):
    rows = [(k, "a", f"red {k}; blue" + "; tea/milk" * (k % 3 == 0)) for k in range(9)] + [(100 + k, "b", f"north {k}/south" + "; east" * (k % 3 == 0)) for k in range(9)] + [(500, "a", "one;two/three"), (501, "b", "one;two/three")]
    got = split_by_source(spark, rows, "goods")
    assert got[500] == ["one", "two/three"] and got[501] == ["one;two", "three"]


def test_plain_text_is_cut_by_its_sources_delimiter_only(spark):
    rows = [(k, "a", f"Trademark law of class {k}") for k in range(20)] + [(99, "a", "Trademark law and practice / filings")]
    assert split_by_source(spark, rows, "scope")[99] == ["Trademark law and practice / filings"]


def test_marks_outside_the_list_are_found(spark):
    got = split_by_source(spark, [(k, "a", f"1380013800{k}~1390013900{k}") for k in range(6)], "phones")
    assert got[3] == ["13800138003", "13900139003"]
    got = split_by_source(spark, [(k, "a", f"a{k}@x.com#b@y.com^c@z.org") for k in range(6)], "emails")
    assert got[2] == ["a2@x.com", "b@y.com", "c@z.org"]


def test_a_delimiter_that_never_leaves_values_is_not_used(spark):
    rows = [(k, "a", f"ask Ms Wu; room {k}") for k in range(30)]
    assert split_by_source(spark, rows, "emails")[5] == ["ask Ms Wu; room 5"]
