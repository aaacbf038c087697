"""Addresses: the reader, and links against brute force over a fixture."""

from itertools import combinations
from types import SimpleNamespace

import pytest

from marlstone.llm import addresses
from marlstone.llm.addresses import Towns, placed_rows, plain_town, read_address, same_places, zh_number
from marlstone.llm.hanzi import Han

NO_HAN = Han({}, {})
TOWNS = Towns(("青屏", "澜江"), ("云州省", "云州"), {"古渡": "青屏", "河东": "澜江"}, frozenset({"saint orrin", "grunmunde", "saint aurele", "quillayne", "harrowby on tarn"}))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("云州省青屏市古渡区君巨京巷404号1389室", ("青屏", "君巨京", "巷", "404")),
        ("青屏·古渡·君巨京巷四百零四号", ("青屏", "君巨京", "巷", "404")),
        ("君巨京巷４０４#12 (青屏市）", ("青屏", "君巨京", "巷", "404")),
        ("古渡区 君巨京大道404号", ("青屏", "君巨京", "大道", "404")),
        ("No. 202 Famimabe Boul., Suite 5, St. Orrin, MN 50052, USA", ("saint orrin", "famimabe", "boulevard", "202")),
        ("Famimabe Blvd 202, Saint Orrin", ("saint orrin", "famimabe", "boulevard", "202")),
        ("Kanimodoweg 113, DE-24641 Gruenmuende", ("grunmunde", "kanimodo", "weg", "113")),
        ("24641 Grünmünde - Kanimodo-Str. 113", ("grunmunde", "kanimodo", "street", "113")),
        ("68, place de Vedesibi, 10539 ST AURELE, France", ("saint aurele", "vedesibi", "place", "68")),
        ("Bill X; Floor 9, 172 Pajagala Ave", ("", "pajagala", "avenue", "172")),
    ],
)
def test_reader(text, expected):
    a = read_address(text, TOWNS, NO_HAN)
    assert (a.town, a.name, a.kind, a.number) == expected


def test_no_address():
    assert all(read_address(t, TOWNS, NO_HAN) is None for t in (None, "", " ", "-", "William Denahegolu", "无"))
    assert zh_number("八百七十三") == "873" and zh_number("十二") == "12" and zh_number("007") == "7" and zh_number("二〇三") == "203"
    assert plain_town("St. Aurèle") == "saint aurele" and plain_town("Gruenmuende") == plain_town("Grünmünde")


ROWS = [
    (1, "202 Famimabe Boulevard, Suite 5, Saint Orrin, MN 50052, USA", "Saint Orrin", "a"), (2, "Famimabe Blvd. 202, St. Orrin", None, "a"), (3, "202 Famimbe Boul., Saint Orrin, MN", "Saint Orrin", "a"), (4, "202 Famimabe Boulevard", None, "a"),
    (5, "203 Famimabe Boulevard, Saint Orrin, MN 50053, USA", "Saint Orrin", "b"), (6, "202 Famimabe Boulevard, Quillayne, WA 61353, USA", "Quillayne", "c"), (7, "云州省青屏市古渡区君巨京巷404号1389室", "青屏市", "d"), (8, "青屏·古渡·京巨君巷404#", "青屏市", "d"),
    (9, "君巨京巷404号", None, "d"), (10, "Room 12, 404 Jun Ju Jing Lane, Qingping City", None, "d"), (11, None, None, None), (12, " ", None, None), (13, "-", None, None), (14, "somewhere", None, None), (15, "云州省澜江市河东区明山水路404号", "澜江市", "e"),
    (16, "202 Famimabe Boulevard, Suite 5, Saint Orrin, MN 50052, USA", "Saint Orrin", "a"),
]


def brute(rows):
    return sorted(("t", min(a[0], b[0]), max(a[0], b[0])) for a, b in combinations(rows, 2) if a[3] and a[3] == b[3] and a[1] != b[1])


def test_against_brute_force(spark):
    # streets of their own that teach the gazetteer the towns, districts and provinces
    extra = [(90 + k, f"{k + 1} Somosiro Lane, Quillayne, WA 61300, USA", "Quillayne") for k in range(3)] + [(100 + k, f"云州省青屏市古渡区泰安康路{k + 1}号", "青屏市") for k in range(5)] + [(200 + k, f"云州省澜江市河东区福寿宁街{k + 1}号", "澜江市") for k in range(5)]
    df = spark.createDataFrame([(i, t, c, "clash") for i, t, c, _ in ROWS] + [(*e, "") for e in extra], "row_id bigint, addr string, city string, street string")
    # row 4 names a street and number that two towns have; it stays alone
    want = [p for p in brute(ROWS) if 4 not in p[1:]]
    assert sorted(map(tuple, same_places({"t": (df, "row_id", "addr")}, df, "city").collect())) == want


def test_streets_of_one_postcode_and_number(spark):
    texts = [
        "12 Maple Lane, Quillayne, WA 61300, USA", "12 Mill Road, Quillayne, WA 61300, USA", "12 Mangrove Lane, Quillayne, WA 61300, USA", "12 Somosiro Lane, Quillayne, WA 61300, USA",
        "12 Sommosito Lane, Quillayne, WA 61300, USA", "12 Somosiro Road, Quillayne, WA 61300, USA", "12 Somosiro Lane, Saint Orrin, MN 61300, USA", "12 Mangorve Lane, WA 61300, USA",
        "12 Sommoziro Lane, WA 61300, USA",
    ]
    cities = ["Saint Orrin" if "Orrin" in t else "Quillayne" for t in texts]
    df = spark.createDataFrame([(k, t, c) for k, (t, c) in enumerate(zip(texts, cities, strict=True))] + [(20, None, "Saint Orrin")], "row_id bigint, addr string, city string")
    # two slips in one name are one street; the last one, without its town, may be that of either town
    assert sorted(map(tuple, same_places({"t": (df, "row_id", "addr")}, df, "city").collect())) == [("t", 2, 7), ("t", 3, 4)]


def test_empty(spark):
    df = spark.createDataFrame([], "row_id bigint, addr string, city string")
    assert same_places({"t": (df, "row_id", "addr")}, df, "city").count() == 0


def places_linked(spark, texts, cities=()):
    rows = [(k, t, None) for k, t in enumerate(texts)] + [(1000 + k, None, c) for k, c in enumerate(cities)]
    df = spark.createDataFrame(rows, "row_id bigint, a string, city string")
    return {(texts[r[1]], texts[r[2]]) for r in same_places({"t": (df, "row_id", "a")}, df, "city").collect()}


def test_streets_and_towns_that_differ_stay_apart(spark):
    texts = ["10 Market Street, San Francisco 94105", "10 Mission Street, San Francisco 94105", "5 Main Street, Springfield", "5 Main Street, Dover", "5 Main St., Dover", "Suite 9, 10 Market St, San Francisco 94105"]
    apart = places_linked(spark, texts)
    assert apart == {("5 Main Street, Dover", "5 Main St., Dover"), (texts[0], texts[5])}
    assert places_linked(spark, texts, ["Springfield", "Dover", "San Francisco"]) == apart


def test_a_rare_town_among_thousands_is_known(spark):
    towns = [f"{a}{b}{c}burg" for a in "bcdfghklmnprst" for b in ("al", "en", "ir", "os", "un") for c in ("a", "bo", "ci", "du", "fe", "ga", "hi", "jo", "ku", "le")]
    texts = ["7 Somosiro Lane, Balaburg", "Somosiro Ln. 7, Balaburg", "7 Somosiro Lane, Tunleburg", "7 Somosiro Ln, Tunleburg"]
    common = ["Greatport"] * 3000
    assert places_linked(spark, texts, towns + common) == {(texts[0], texts[1]), (texts[2], texts[3])}


def test_classes_hold_the_same_links_as_the_pairs(spark):
    df = spark.createDataFrame([(i, t, c) for i, t, c, _ in ROWS], "row_id bigint, addr string, city string")
    links = {}
    for r in same_places({"t": (df, "row_id", "addr")}, df, "city").collect():
        for i in r[1:]:
            links[i] = links.get(i, 0) + 1
    assert {r["row_id"]: r["links"] for r in placed_rows({"t": (df, "row_id", "addr")}, df, "city").collect() if r["links"]} == links


def test_tables_take_one_plan_and_pairs_stay_within_them(spark):
    df = spark.createDataFrame([(i, t, c) for i, t, c, _ in ROWS], "row_id bigint, addr string, city string")
    one = {"t": (df, "row_id", "addr")}
    two = {**one, "u": (df.where("row_id <> 2"), "row_id", "addr")}
    joins = [[str(places(tables, df, "city")._jdf.queryExecution().optimizedPlan()).count("Join ") for tables in (one, two)] for places in (same_places, placed_rows)]
    assert all(single == both > 0 for single, both in joins)
    got = sorted(map(tuple, same_places(two, df, "city").collect()))
    alone = [r[1:] for r in got if r[0] == "t"]
    assert len(alone) > 3 and (1, 2) in alone and got == [("t", *r) for r in alone] + [("u", *r) for r in alone if 2 not in r]
    rows = [placed_rows(two, df, "city").where(f"source_table = '{name}' and links > 0").collect() for name in "tu"]
    assert [sum(r["links"] for r in part) for part in rows] == [2 * len([r for r in got if r[0] == name]) for name in "tu"]


def test_streets_are_searched_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, c) for i, t, c, _ in ROWS], "row_id bigint, addr string, city string")
    plans = []
    settled = addresses.components
    monkeypatch.setattr(addresses, "components", lambda edges: plans.append(str(edges._jdf.queryExecution().optimizedPlan())) or settled(edges))
    assert same_places({"t": (df, "row_id", "addr")}, df, "city").count() > 0
    assert len(plans) == 2 and "Window" not in plans[1]


class Jvm:
    """The session's JVM without the transliterator."""

    def __init__(self, real):
        self._real, self.com = real, real.nosuch

    def __getattr__(self, name):
        return getattr(self._real, name)


def test_places_without_readings_of_han_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, c) for i, t, c, _ in ROWS], "row_id bigint, addr string, city string")
    monkeypatch.setattr(spark, "_jvm", Jvm(spark._jvm))
    for places in (same_places, placed_rows):
        with pytest.raises(RuntimeError, match="icu4j"):
            places({"t": (df, "row_id", "addr")}, df, "city")


@pytest.mark.parametrize("part", ["sound", "marks", "simple"])
def test_places_with_readings_of_some_han_only_are_an_error(spark, monkeypatch, part):
    df = spark.createDataFrame([(i, t, c) for i, t, c, _ in ROWS], "row_id bigint, addr string, city string")
    known = {"sound": "一" if part == "sound" else None, "simple": "東" if part == "simple" else None}

    def transliterator(rules):
        only, made = (known["simple"], "东") if rules == "Hant-Hans" else (known["sound"], "lǐ" if part == "marks" else "li")
        return SimpleNamespace(transliterate=lambda text: "\n".join(made if only in (c, None) else c for c in text.split("\n")))

    jvm = Jvm(spark._jvm)
    jvm.com = SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=SimpleNamespace(Transliterator=SimpleNamespace(getInstance=transliterator)))))
    monkeypatch.setattr(spark, "_jvm", jvm)
    with pytest.raises(RuntimeError, match="too few"):
        same_places({"t": (df, "row_id", "addr")}, df, "city")


@pytest.mark.parametrize("rare", ["㘵", "\U0002c488"])
def test_a_street_is_read_with_its_rare_characters(rare):
    for text in (f"云州省青屏市古渡区{rare}京巷404号", f"青屏·古渡·京{rare}巷四百零四号", f"青屏市{rare}巷404号"):
        a = read_address(text, TOWNS, NO_HAN)
        assert rare in a.name and (a.town, a.kind, a.number) == ("青屏", "巷", "404")
