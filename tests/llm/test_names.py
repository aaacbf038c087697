"""Names: readers, and links against brute force over a fixture."""

from itertools import combinations
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marlstone.llm.hanzi import Han, load
from marlstone.llm.linkage import deletions, key64, probe_edges, star_edges
from marlstone.llm.names import BASE, _combined, _united, edits, learned_places, named_entities, read_companies, read_company, read_person, same_names, trade_of

NO_HAN = Han({}, {})


@pytest.mark.parametrize(
    ("name", "house", "trade"),
    [
        ("Begoru Fasojo Cosmetics L.L.C.", ("begoru", "fasojo"), "cosmetics"),
        ("c/o Fasojo, Begoru Cosm. LLC & Co", ("fasojo", "begoru"), "cosmetics"),
        ("BEGORU FASOJO LLC (COSMETICS)", ("begoru", "fasojo"), "cosmetics"),
        ("BegoruFasojo Cosmetics", ("begoru", "fasojo"), "cosmetics"),
        ("The Pharmaceuticals, Páboru Posifa, Public Limited Company", ("paboru", "posifa"), "pharmaceuticals"),
        ("Nuvosi Tech. Gesellschaft mit beschränkter Haftung", ("nuvosi",), "technology"),
        ("Ming Tai Sheng Pu Beverages Co., Ltd", ("ming", "tai", "sheng", "pu"), "beverages"),
    ],
)
def test_company_reader(name, house, trade):
    company = read_company(name, NO_HAN)
    assert (company.house, company.trade) == (house, trade)


def test_nothing_names():
    assert all(read_company(t, NO_HAN) is None and read_person(t) is None for t in (None, "", "  ", "-", "N/A", "不详", "　"))


def test_person_reader():
    for name in ("William C. Denahegolu", "DENAHEGOLU, William", "bill denahegolu", "denahegolu william", "williamdenahegolu", "Mr William-Denahegolu, Esq.", "wiliam denahegolu", 'William "Bill" Denahegolu'):
        assert read_person(name).family == "denahegolu" and read_person(name).given == ("william",), name
    assert read_person("W. C. Denahegolu").given == () and read_person("wc denahegolu").initial == "w"


def test_edits_and_keys():
    assert edits("lomito", "lonito") == 1 and edits("tiniri", "tiniir") == 1 and edits("abc", "xyz") == 3
    assert deletions("lomito") & deletions("lonito") and not deletions("lomito") & deletions("lakuti")
    assert trade_of("engrg") == "engineering" and trade_of("ming") is None


def test_stars_and_probes(spark):
    keyed = spark.createDataFrame([(k, 1) for k in range(50)] + [(99, 2)], "id bigint, key bigint")
    assert {tuple(r) for r in star_edges(keyed).collect()} == {(k, 0) for k in range(1, 50)}
    bases = spark.createDataFrame([(1, 7, "x"), (2, 8, "x"), (3, 8, "y")], "id bigint, key bigint, kind string")
    assert {tuple(r) for r in probe_edges(spark.createDataFrame([(10, 7), (11, 8)], "id bigint, key bigint"), bases).collect()} == {(10, 1)}


COMPANIES = [
    (1, "Begoru Fasojo Cosmetics LLC", "a"), (2, "Begoru Fasojo Cosm. L.L.C.", "a"), (3, "Fasojo, Begoru Cosmetics", "a"), (4, "Begoru Fassjo Cosmetics LLC", "a"), (5, "Begoru Fasojo Trading LLC", "b"),
    (6, "青屏宏宝丰仁纺织有限公司", "c"), (7, "宏宝丰仁（青屏）紡織", "c"), (8, "Hong Bao Feng Ren Textiles Co., Ltd", "c"), (9, "青屏宏宝丰仁贸易有限公司", "d"), (10, "宝宏丰仁纺织有限公司", "c"),
    (11, None, None), (12, "", None), (13, "-", None), (14, "不详", None), (15, "Begoru Fasojo Cosmetics LLC", "a"), (16, "青屏宏宝丰仁仁纺织", "c"),
]
PEOPLE = [
    (1, "william denahegolu", "a"), (2, "denahegolu bill", "a"), (3, "w denahegolu", "a"), (4, "william denahegollu", "a"), (5, "margaret denahegolu", "b"), (6, "m denahegolu", "b"),
    (7, "oliver hapanazavi", "c"), (8, "", None), (9, None, None), (10, "n/a", None), (11, "william denahegolu", "a"),
]


def brute(rows):
    return sorted((min(a[0], b[0]), max(a[0], b[0])) for a, b in combinations(rows, 2) if a[2] and a[2] == b[2] and a[1] != b[1])


def pairs(df, text, kind, address=None):
    return same_names({"t": (df, "row_id", text, kind, address)}).select("row_id_a", "row_id_b")


def test_companies_against_brute_force(spark):
    rows = [(i, n, f"东岭省青屏市古渡区甲乙丙路{i}号", 1, "clash") for i, n, _ in COMPANIES]
    df = spark.createDataFrame(rows, "row_id bigint, raw_name string, raw_address string, entity bigint, key string")
    df = df.unionAll(spark.createDataFrame([(100 + k, None, "东岭省青屏市古渡区甲乙丙路1号", 1, "") for k in range(6)], df.schema))
    assert load(spark).sound.get("宏") == "hong"
    assert sorted(map(tuple, pairs(df, "raw_name", "company", "raw_address").collect())) == brute(COMPANIES)


def test_people_against_brute_force(spark):
    df = spark.createDataFrame([(i, n) for i, n, _ in PEOPLE], "row_id bigint, normalized_name string")
    assert sorted(map(tuple, pairs(df, "normalized_name", "person").collect())) == brute(PEOPLE)


def test_variants_reached_only_through_a_merged_profile(spark):
    people = spark.createDataFrame([(1, "kit denahegolu"), (2, "christopher denahegola"), (3, "c denehegolu"), (4, "d denehegolu")], "row_id bigint, normalized_name string")
    assert sorted(map(tuple, pairs(people, "normalized_name", "person").collect())) == [(1, 2), (1, 3), (2, 3)]
    names = ["Begoru Fasojo Trading", "Begora Fasojo Trading", "Begoru Fasoju Trading", "Begara Fasuju Trading", "Bikara Fasuju Trading"]
    companies = spark.createDataFrame(list(enumerate(names)), "row_id bigint, raw_name string")
    assert sorted(map(tuple, pairs(companies, "raw_name", "company").collect())) == [(a, b) for a, b in combinations(range(4), 2)]


def test_empty_tables_and_hot_spellings(spark):
    df = spark.createDataFrame([], "row_id bigint, raw_name string, raw_address string")
    assert pairs(df, "raw_name", "company", "raw_address").count() == 0
    hot = spark.createDataFrame([(k, "Quorumvale Brand Holdings B.V.") for k in range(3000)] + [(5000, "QUORUMVALE Brand Holdings BV")], "row_id bigint, raw_name string")
    assert pairs(hot, "raw_name", "company").count() == 3000
    assert read_company("x" * 100_000, NO_HAN).house == ("x" * 100_000,)


def linked(spark, kind, names):
    df = spark.createDataFrame(list(enumerate(names)), "row_id bigint, n string")
    return {(names[r[1]], names[r[2]]) for r in same_names({"t": (df, "row_id", "n", kind, None)}).collect()}


def test_names_outside_the_lists_stay_apart(spark):
    people = ["Robert Johnson", "Susan Johnson", "Johnson, Robert", "Michael Johnson", "Michael Jackson", "John Miller", "Peter Miller", "Samuel Kim", "Kim Samuel", "Roberto Diaz"]
    assert linked(spark, "person", people) == {("Robert Johnson", "Johnson, Robert"), ("Samuel Kim", "Kim Samuel")}
    firms = ["Northwind Industries Ltd", "Acme Industries Inc", "International Harvest Foods", "International Bakery Foods", "Northwind Industries Limited"]
    assert linked(spark, "company", firms) == {("Northwind Industries Ltd", "Northwind Industries Limited")}


def test_an_initial_joins_the_only_given_name_that_it_fits(spark):
    got = linked(spark, "person", ["Robert Ashdown", "R. Ashdown", "Susan Kettering", "Sven Kettering", "S. Kettering"])
    assert got == {("Robert Ashdown", "R. Ashdown")}


def test_many_towns_are_known_without_a_limit(spark):
    marks = "东南西北山水云石江河湖海林木花草金银铜铁"
    towns = [a + b for a in marks for b in marks if a != b]
    rows = [(k, f"{t}明月有限公司" if k % 2 else "明月有限公司", f"中国{t}市河东区路{n}号") for n in range(5) for k, t in enumerate(towns)]
    df = spark.createDataFrame([(i, n, a) for i, (_, n, a) in enumerate(rows)], "row_id bigint, n string, a string")
    places = learned_places(df, "n", "a", load(spark))
    assert places.where("kind = 'town'").count() == len(towns)
    texts = df.select(F.xxhash64("n").alias("text_id"), F.col("n").alias("text")).distinct()
    assert {r["han"] for r in read_companies(texts, places)[0].collect()} == {"明月"}


def test_classes_hold_the_same_links_as_the_pairs(spark):
    names = ["Northwind Foods Ltd", "Northwind Foods Limited", "Northwind Foods", "Northwind Foods Ltd", "Acme Foods", "-", None]
    df = spark.createDataFrame(list(enumerate(names)), "row_id bigint, n string").withColumn("entity", F.lit("clash"))
    tables = {"t": (df, "row_id", "n", "company", None)}
    links = {}
    for r in same_names(tables).collect():
        for i in r[1:]:
            links[i] = links.get(i, 0) + 1
    got = {r["row_id"]: (r["entity"], r["links"]) for r in named_entities(tables).collect()}
    assert {k: n for k, (_, n) in got.items()} == {**{k: 0 for k in range(5)}, **links} and len({e for e, _ in got.values()}) == 2
    assert named_entities({"t": (df.where("false"), "row_id", "n", "company", None)}).count() == 0


def test_tables_take_one_plan_and_pairs_stay_within_them(spark):
    df = spark.createDataFrame([(i, n) for i, n, _ in PEOPLE], "row_id bigint, n string")
    one = {"t": (df, "row_id", "n", "person", None)}
    two = {**one, "u": (df.where("row_id <> 2"), "row_id", "n", "person", None)}
    joins = [[str(named(tables)._jdf.queryExecution().optimizedPlan()).count("Join ") for tables in (one, two)] for named in (same_names, named_entities)]
    assert all(single == both > 0 for single, both in joins)
    got = sorted(map(tuple, same_names(two).collect()))
    assert got == [("t", *p) for p in brute(PEOPLE)] + [("u", *p) for p in brute(PEOPLE) if 2 not in p]
    rows = [named_entities(two).where(f"source_table = '{name}'").collect() for name in "tu"]
    assert [sum(r["links"] for r in part) for part in rows] == [2 * len([r for r in got if r[0] == name]) for name in "tu"]


def grown(spark, grow, columns, rows, entities):
    """What grow makes of rows (text_id, id, columns) in entities (id, entity): (id, key), and the joins of its plan."""
    read = spark.createDataFrame(rows, f"text_id bigint, id bigint, {columns}")
    new = grow(read, spark.createDataFrame(entities, "id bigint, entity bigint"), lambda *values: [("|".join(values), BASE, "")])
    assert str(new._jdf.queryExecution().optimizedPlan()).count("Join ") == 1
    return sorted((r["id"], r["key"]) for r in new.collect())


def test_merged_profiles_are_combined_in_one_join(spark):
    people = [
        (1, 1, "smith", "william", "w"), (2, 1, "smith", "william", "w"), (3, 2, "smyth", "benjamin william", "w"), (4, 3, "smithe", "", ""),
        (5, 4, "kettering", "susan", "s"), (6, 5, "ketering", "sven", "s"), (7, 6, "ashdown", "", "r"), (8, 7, "ashdowne", "", ""),
        (9, 8, "miller", "christopher katherine", "c"), (10, 9, "millar", "", ""), (11, 10, "alone", "peter", "p"),
    ]
    entities = [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (8, 8), (9, 8)]
    expected = sorted((1, key64(f"{family}|william|w")) for family in ("smyth", "smithe"))
    assert grown(spark, _united, "family string, given string, initial string", people, entities) == expected
    companies = [
        (1, 1, "begoru fasojo", "foods", ""), (2, 1, "begoru fasojo", "foods", ""), (3, 2, "fasoju begora", "foods", ""), (4, 3, "begoru fasoju north", "foods", ""), (5, 4, "lakuti posifa", "trading", ""),
        (6, 5, "", "foods", "宏宝丰仁"), (7, 6, "", "foods", "宏保丰人"), (8, 7, "nuvosi", "foods", ""), (9, 8, "nuvoti", "foods", ""), (10, 9, "mufosa", "foods", ""),
    ]
    new = ["begora fasojo|foods|", "begoru fasoju|foods|", "|foods|宏宝丰人", "|foods|宏保丰仁", *(f"{x}{y}|foods|" for x in ("nuv", "muf") for y in ("osi", "oti", "osa"))]
    held = {"nuvosi|foods|", "nuvoti|foods|", "mufosa|foods|"}
    first = lambda name: 5 if "宏" in name else 1 if " " in name else 7
    got = grown(spark, _combined, "house string, trade string, han string", companies, [(k, 1) for k in range(1, 10)])
    assert got == sorted((first(n), key64(n)) for n in new if n not in held)


class Jvm:
    """The session's JVM with another package in the place of com."""

    def __init__(self, real, com):
        self._real, self.com = real, com

    def __getattr__(self, name):
        return getattr(self._real, name)


def test_names_without_readings_of_han_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(i, n, None) for i, n, _ in COMPANIES], "row_id bigint, raw_name string, raw_address string")
    monkeypatch.setattr(spark, "_jvm", Jvm(spark._jvm, spark._jvm.nosuch))
    for address in (None, "raw_address"):
        with pytest.raises(RuntimeError, match="icu4j"):
            pairs(df, "raw_name", "company", address)
    with pytest.raises(RuntimeError, match="icu4j"):
        named_entities({"t": (df, "row_id", "raw_name", "company", None)})


def test_a_transliterator_that_changes_nothing_is_an_error():
    same = SimpleNamespace(transliterate=lambda text: text)
    text = SimpleNamespace(Transliterator=SimpleNamespace(getInstance=lambda _: same))
    com = SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=text)))
    with pytest.raises(RuntimeError, match="no readings"):
        load(SimpleNamespace(_jvm=SimpleNamespace(com=com)))
