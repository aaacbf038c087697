"""Variant spellings of names typed by people: merge, union the spellings, rematch with the richer profile.

A name is read into a profile: of a company the words of its house name and its trade, of a person the
family name and what is known of the given name. Profiles enter blocking with exact and with tolerant keys;
profiles that share a key are merged by components, the merged profile combines the spellings of all its
records, and the new combinations enter blocking again until nothing more is merged.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import checkpoint
from .hanzi import Han
from .hanzi import load as load_han
from .linkage import class_rows, deletions, is_nothing, key64, probe_edges, row_pairs, spoken, star_edges, with_known, with_text_ids

# Trades in English and Chinese.
TRADES = {
    "trading": "贸易", "foods": "食品", "pharmaceuticals": "医药", "instruments": "仪器", "education": "教育", "furniture": "家具", "logistics": "物流",
    "technology": "科技", "cosmetics": "化妆品", "beverages": "饮料", "textiles": "纺织", "software": "软件", "engineering": "工程", "manufacturing": "制造",
}
# Short forms that no rule gives.
TRADE_SHORT = {"s/w": "software", "sw": "software", "trdg": "trading", "fds": "foods", "food": "foods"}
# Words of legal forms and of address in company names.
LEGAL = frozenset(
    """corporation corp incorporated inc llc limited ltd plc ag aktiengesellschaft gmbh pty proprietary sas sarl company co liability public
    gesellschaft mit beschrankter haftung societe par actions simplifiee responsabilite limitee bv nv kg ohg srl spa oy ab sa lp llp the et al
    a c o m s and und holding group cie""".split()
)
CN_LEGAL = re.compile("股份有限公司|有限责任公司|有限公司|责任公司|分公司|集团公司|公司|集团")
# Given names and their short forms.
SHORT_FORMS = {
    "alexander": "alex al sandy xander alec lex sasha",
    "benjamin": "ben benny benji benjy",
    "christopher": "chris kit topher kris",
    "daniel": "dan danny",
    "elizabeth": "liz beth betty eliza lizzie betsy libby lisbeth",
    "frederick": "fred freddie freddy rick",
    "gabriella": "gabi gabby gabrielle gaby ella",
    "henrietta": "hettie etta hetty harriet ettie",
    "isabella": "izzy bella isa isabel belle",
    "jonathan": "jon jonny jonnie",
    "katherine": "kate katie kathy kit kathie kitty kay",
    "lawrence": "larry laurie lawrie lars",
    "margaret": "maggie meg peggy marge margie madge greta",
    "nathaniel": "nate nat nathan",
    "oliver": "ollie olly noll",
    "patricia": "pat patty trish tricia patsy",
    "rebecca": "becky becca beck",
    "samuel": "sam sammy",
    "theodore": "ted teddy theo",
    "victoria": "vicky tori vic vickie",
    "william": "bill billy will willie liam",
}
GIVEN: dict[str, tuple[str, ...]] = {}
for _full, _short in SHORT_FORMS.items():
    for _form in (_full, *_short.split()):
        GIVEN[_form] = (*GIVEN.get(_form, ()), _full)
TITLES = frozenset("mr mrs ms miss dr prof sir dame esq attn contact c/o co jr sr ii iii phd md the hon attorney".split())
_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]")


def folded(text: str) -> str:
    """Text in lower case without accents and full-width forms."""
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("ł", "l"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def edits(a: str, b: str, most: int = 2) -> int:
    """Edit distance with swaps, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], last[j - 2] + 1)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


@lru_cache(maxsize=100_000)
def trade_of(word: str) -> str | None:
    """The trade that a word names: itself, a short form that keeps its letters in order, or one a typing slip away."""
    if word in TRADES:
        return word
    if word in TRADE_SHORT:
        return TRADE_SHORT[word]
    letters = re.sub("[^a-z]", "", word)
    if letters in TRADES or len(letters) < 3:
        return letters if letters in TRADES else None
    for trade in TRADES:
        if trade.startswith(letters) and (len(letters) > 3 or letters != "man"):
            return trade
        rest = iter(trade)
        bare = "'" in word or not any(c in "aeiou" for c in letters[1:])
        if letters[0] == trade[0] and bare and all(c in rest for c in letters):
            return trade
    close = [t for t in TRADES if len(letters) >= 5 and edits(letters, t, 1 if len(t) < 8 else 2) <= (1 if len(t) < 8 else 2)]
    return close[0] if len(close) == 1 else None


@lru_cache(maxsize=100_000)
def _is_legal(word: str) -> bool:
    return word in LEGAL or (len(word) >= 7 and any(len(w) >= 7 and edits(word, w, 1) <= 1 for w in LEGAL))


@dataclass(frozen=True)
class Company:
    """house: its words in writing order; trade; han: its house name in simplified characters, or ''."""

    house: tuple[str, ...]
    trade: str
    han: str = ""


def read_company(name: str | None, han: Han, places: frozenset[str] = frozenset()) -> Company | None:
    """The profile of a company's name, None if it says nothing. places: town names, which are no part of a house name."""
    if is_nothing(name):
        return None
    if _HAN.search(name):
        text = re.sub(r"[^㐀-䶿一-鿿豈-﫿]", "", han.simplified(unicodedata.normalize("NFKC", name)))
        text = CN_LEGAL.sub("", text) or text
        trade = next((t for t, zh in TRADES.items() if text.endswith(zh)), None) or next((t for t, zh in TRADES.items() if zh in text), "")
        if trade:
            head, _, tail = text.rpartition(TRADES[trade])
            text = head + tail
        for place in sorted((p for p in places if p in text), key=len, reverse=True)[:1]:
            cut = re.sub(f"{place}市?", "", text, count=1)
            text = cut if len(cut) > 1 else text
        return Company((), trade, text) if text and not is_nothing(text) else None
    split = re.sub(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ][a-zß-ÿ])", " ", name)
    text = re.sub(r"\bc/o\b|\bm/s\b|\bet al\b|&\s*co\b|\ba company\b", " ", folded(split))
    words = [w.strip(".'") for w in re.findall(r"s/w|[a-z][a-z.']*", text)]
    words = [w for w in words if w]
    words = [w for w in words if not _is_legal(w.replace(".", ""))]
    trade = next((w for w in words if w in TRADES), None) or next((t for w in words if (t := trade_of(w))), "")
    house = [re.sub("[^a-z]", "", w) for w in words if not trade or trade_of(w) != trade]
    house = [w for w in house if w]
    known = {han.syllables(p) for p in places}
    if len(house) > 1 and known & set(house):
        house = [w for w in house if w not in known] or house
    return Company(tuple(house), trade) if house else None


def company_keys(c: Company, han: Han) -> tuple[list[str], list[str], list[str]]:
    """Keys of a profile for the rounds: the same letters, one slip, one slip in each half."""
    if c.han:
        sound = han.syllables(c.han)
        # characters in any order and doubled ones count once; the sound joins a name written in Latin letters
        return [f"h|{c.trade}|{''.join(sorted(set(c.han)))}", f"s|{c.trade}|{sound}"], [f"d|{c.trade}|{v}" for v in deletions(sound)] if len(sound) > 7 else [], []
    whole = "".join(c.house)
    turned = {whole, "".join(reversed(c.house))} if len(c.house) == 2 else {whole}
    if len(c.house) > 2:  # a name by sound may carry its town before or behind it
        turned |= {"".join(c.house[1:]), "".join(c.house[:-1])}
    exact = [f"s|{c.trade}|{w}" for w in turned]
    if len(whole) < 8:
        return exact, [], []
    slip = [f"d|{c.trade}|{v}" for w in turned for v in deletions(w)]
    halves = [c.house] if len(c.house) == 2 else [(whole[:k], whole[k:]) for k in {len(whole) // 2, (len(whole) + 1) // 2}] if len(c.house) == 1 else []
    both = {f"b|{c.trade}|{min(x, y)}|{max(x, y)}" for a, b in halves for x in deletions(a) for y in deletions(b)} if all(min(map(len, h)) >= 4 for h in halves) else set()
    return exact, slip, sorted(both)


@dataclass(frozen=True)
class Person:
    """family name; given: the full given names that the one written may stand for; initial of the given name."""

    family: str
    given: tuple[str, ...]
    initial: str


def read_person(name: str | None) -> Person | None:
    """The profile of a person's name in any order, with or without blanks; None if it says nothing."""
    if is_nothing(name):
        return None
    plain = folded(name).replace("'", "")
    words = [w for w in re.findall(r"[^\W\d_]+", plain) if w not in TITLES]
    if not words:
        return None
    if len(words) == 1 and len(words[0]) > 8:
        words = _unglued(words[0])
    long = [w for w in words if len(w) > 3 or w in GIVEN]
    if not any(w not in GIVEN for w in long) and len([w for w in long if w in GIVEN]) < 2:
        long = [w for w in words if len(w) > 1]  # a short family name
    exact = [w for w in long if w in GIVEN]
    others = [w for w in long if w not in GIVEN]
    if not others and len(exact) > 1:
        others, exact = [max(exact, key=len)], [w for w in exact if w != max(exact, key=len)]
    if not others:
        return None
    given: tuple[str, ...] = ()
    if exact:
        sets = [set(GIVEN[w]) for w in exact]
        given = tuple(sorted(set.intersection(*sets) or sets[0]))
        family = max(others, key=len)
    elif len(others) > 1:
        slips = [(w, given_of(w)) for w in others]
        slip = next(((w, g) for w, g in sorted(slips, key=lambda x: min(edits(x[0], f, 3) for f in SHORT_FORMS)) if g), None)
        if slip:
            given, family = slip[1], max((w for w in others if w != slip[0]), key=len)
        else:
            # a given name that no list knows stands for itself; the family name comes last, or first before a comma
            turned = re.match(r"\W*(?:\w+\W+)?" + re.escape(others[0]) + r"\s*[,，]", plain)
            family = others[0] if turned else others[-1]
            given = (OWN + (others[1] if turned else others[0]),)
    else:
        family = others[0]
    letters = [w for w in words if w not in long]
    initial = given[0].removeprefix(OWN)[0] if given else letters[0][0] if letters else ""
    return Person(family, given, initial)


OWN = "="  # before a given name that no list knows


@lru_cache(maxsize=100_000)
def given_of(word: str) -> tuple[str, ...]:
    """The full given names that a word may stand for, also with a typing slip or two; none if it is no given name."""
    if word in GIVEN:
        return GIVEN[word]
    if len(word) < 5:
        return ()
    near = [(edits(word, full, 2), full) for full in SHORT_FORMS if abs(len(full) - len(word)) <= 2]
    near = [(d, full) for d, full in near if d <= (2 if len(full) > 6 else 1)]
    return (min(near)[1],) if near else ()


@lru_cache(maxsize=10_000)
def _forms() -> list[str]:
    return sorted((f for f in GIVEN if len(f) > 2), key=len, reverse=True)


def _unglued(word: str) -> list[str]:
    """A given name and a family name that were written in one word."""
    for title in ("attn", "mrs", "mr", "ms", "dr"):
        if word.startswith(title) and any(word[len(title) :].startswith(f) for f in SHORT_FORMS):
            word = word[len(title) :]
    for form in _forms():
        if word.startswith(form) and len(word) - len(form) >= 5:
            rest = word[len(form) :]
            again = next((f for g in GIVEN[form] for f in SHORT_FORMS[g].split() if len(f) > 2 and rest.startswith(f) and len(rest) - len(f) > 8), "")
            return [form, rest[len(again) :]]
        if word[:-1].endswith(form) and len(word) - len(form) > 9:
            return [form, word[: -len(form) - 1]]
        if word.endswith(form) and len(word) - len(form) >= 5:
            return [form, word[: -len(form)]]
    for size in range(5, min(13, len(word) - 5)):
        if given_of(word[:size]) and any(edits(word[:size], f, 1) <= 1 for f in SHORT_FORMS):
            return [word[:size], word[size:]]
    return [word]


def _read(texts: DataFrame, kind: str, fields: list[str], read) -> DataFrame:
    """(text_id, id, fields): the profile read(text, found) of every text that says something; id is a hash of kind and fields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = [(i, *p) for i, t, found in zip(frame["text_id"], frame["text"], frame["found"], strict=True) if (p := read(t, found))]
            yield pd.DataFrame(out, columns=["text_id", *fields])

    rows = texts.select("text_id", "text", "found").mapInPandas(run, ", ".join(["text_id bigint", *[f"{f} string" for f in fields]]))
    return checkpoint(rows.select("text_id", F.xxhash64(F.lit(kind), *fields).alias("id"), *fields))


BASE, PROBE, KIND = 0, 1, 2  # roles of a key: joins its bearers, asks for a base, only tells the kind of a base


def _keyed(read: DataFrame, fields: list[str], keys_of) -> DataFrame:
    """The distinct profiles of read to (id, key, role, kind)."""
    return _keys(_profiles(read, fields), fields, keys_of)


def _keys(profiles: DataFrame, fields: list[str], keys_of) -> DataFrame:
    """profiles to (id, key, role, kind); keys_of(*fields) gives (key text, role, kind text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = [(i, key64(key), role, key64(kind) if kind else 0) for i, *values in frame[["id", *fields]].itertuples(index=False) for key, role, kind in keys_of(*values)]
            yield pd.DataFrame(out, columns=["id", "key", "role", "kind"])

    return profiles.select("id", *fields).mapInPandas(run, "id bigint, key bigint, role tinyint, kind bigint")


def _profiles(read: DataFrame, fields: list[str]) -> DataFrame:
    return read.groupBy("id").agg(*[F.min(f).alias(f) for f in fields])


def _merge_rounds(keyed: DataFrame, enriched=None) -> DataFrame:
    """(id, entity): components over shared keys, then over those of enriched profiles.

    enriched(entities) gives new (id, key, role, kind) rows of merged profiles, matched against all keys; all
    probes are asked again, and bases of one entity are of one kind now. It is repeated until no edge between
    entities is found.
    """
    of_role = lambda rows, role: rows.where(F.col("role") == role)
    bases, probes, kinds = (of_role(keyed, role) for role in (BASE, PROBE, KIND))
    edges = star_edges(bases.select("id", "key")).unionAll(probe_edges(probes.select("id", "key"), kinds.select("id", "key", "kind")))
    joined = checkpoint(components(edges).select(F.col("node").alias("id"), F.col("component").alias("entity")))
    while enriched is not None:
        fresh = checkpoint(enriched(joined))
        # entities stand for their profiles; the bearers of a base key are joined already, unless a fresh profile has it too
        again = bases.join(of_role(fresh, BASE).select("key").distinct(), "key", "left_semi").select(keyed.columns)
        rows = again.unionAll(keyed.where(F.col("role") != BASE)).unionAll(fresh).join(joined, "id", "left")
        asked = checkpoint(rows.select(F.coalesce("entity", "id").alias("id"), "key", "role"))
        bearers, asking, told = (of_role(asked, role).select("id", "key") for role in (BASE, PROBE, KIND))
        met = checkpoint(star_edges(bearers).unionAll(probe_edges(asking, told.withColumn("kind", F.col("id")))))
        if met.isEmpty():
            break
        # only the entities that met are put together; the others stay as they are
        moved = components(met).select(F.col("node").alias("entity"), "component")
        known = joined.unionAll(moved.select(F.col("entity").alias("id"), "entity")).distinct()
        joined = checkpoint(known.join(moved, "entity", "left").select("id", F.coalesce("component", "entity").alias("entity")))
    return joined


def learned_places(rows: DataFrame, name: str, address: str, han: Han, least: int = 5) -> DataFrame:
    """(form, kind, value, of): town names, by character and by sound.

    Chinese ones stand before 市 in `least` addresses or more; Latin ones, whose reading may be another than the
    commonest, stand alone in brackets behind `least` or more different first words of names.
    """
    town = F.regexp_extract(F.regexp_replace(F.col(address), r"[\s·,，、　]", ""), "(?:^|省|州|中国|国)([一-鿿]{2,3})市", 1)
    chinese = rows.select(town.alias("form")).where("form <> ''").groupBy("form").agg(F.count("*").alias("n"))
    lower = F.lower(name)
    bracketed = rows.select(F.regexp_extract(lower, r"\(\s*([a-z]{3,})\s*\)", 1).alias("form"), F.regexp_extract(lower, r"^[^a-z]*([a-z]+)", 1).alias("first"))
    latin = bracketed.where("form <> '' and first <> ''").groupBy("form").agg(F.count_distinct("first").alias("n"))
    of_kind = lambda found: found.where(F.col("n") >= least).select("form", F.lit("town").alias("kind"), F.col("form").alias("value"), F.lit("").alias("of"))
    return checkpoint(spoken(of_kind(chinese), han).unionAll(of_kind(latin)))


def place_forms(name: str, han: Han) -> Iterator[str]:
    """What may be a town in a company's name: two or three Han characters, or a Latin word by sound."""
    if _HAN.search(name):
        text = re.sub(r"[^㐀-䶿一-鿿豈-﫿]", "", han.simplified(unicodedata.normalize("NFKC", name)))
        yield from (text[k : k + size] for size in (2, 3) for k in range(len(text) - size + 1))
    else:
        yield from re.findall("[a-z]+", folded(re.sub(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ][a-zß-ÿ])", " ", name)))


def common_characters(texts: DataFrame, share: float = 0.25) -> frozenset[str]:
    """The Han characters that stand in texts more than `share` as often as the middle one of the 100 commonest."""
    chars = texts.select(F.explode(F.split(F.regexp_replace("text", "[^一-鿿]", ""), "")).alias("c")).where("c <> ''").groupBy("c").agg(F.count("*").alias("n"))
    top = [(r["c"], r["n"]) for r in chars.orderBy(F.desc("n"), "c").limit(LAST_CHARACTERS).collect()]  # at most the characters there are
    middle = top[min(len(top), 100) // 2][1] if top else 0
    return frozenset(c for c, n in top if n > share * middle)


LAST_CHARACTERS = 21_000


COMPANY, PERSON = ["house", "trade", "han"], ["family", "given", "initial"]


def read_companies(texts: DataFrame, places: DataFrame | None) -> tuple:
    """The profiles and keys of company names, and the function that gives a profile its keys; texts: text_id, text, one row per text.

    places: the towns that may stand in a name and are no part of it (learned_places), or None.

    Names of one house and trade are one company: in any order of words, with or without legal form and place,
    in Chinese or by sound in Latin letters, with slips of typing. Another trade makes another company.
    """
    han = load_han(texts.sparkSession)
    common = common_characters(texts)
    shared = texts.sparkSession.sparkContext.broadcast((han, common))  # of one size

    def profile(text: str, found) -> tuple[str, str, str] | None:
        company = read_company(text, shared.value[0], frozenset(x["value"] for x in found) if found is not None else frozenset())
        return (" ".join(company.house), company.trade, company.han) if company else None

    def keys_of(house: str, trade: str, name: str) -> Iterator[tuple[str, int, str]]:
        han, common = shared.value
        for keys in company_keys(Company(tuple(house.split()), trade, name), han):
            yield from ((k, BASE, "") for k in keys)
        if name and common:
            odd = [k for k, c in enumerate(name) if c not in common]
            # one unusual character is taken for a slip, if one name only has the others in their places
            if not odd:
                yield from ((f"w|{trade}|{name[:k]}*{name[k + 1:]}", KIND, name) for k in range(len(name)))
            elif len(odd) == 1 and len(name) > 2:
                k = odd[0]
                yield (f"w|{trade}|{name[:k]}*{name[k + 1:]}", PROBE, "")

    seen = texts.withColumn("found", F.lit(None)) if places is None else with_known(texts, places, lambda name: place_forms(name, shared.value[0]))
    read = _read(seen, "company", COMPANY, profile)
    return read, _keyed(read, COMPANY, keys_of), keys_of


def _combined(read: DataFrame, entities: DataFrame, keys_of) -> DataFrame:
    """(id, key, role, kind) of the new spellings of merged companies: each half of a name with each other half of its entity.

    Halves are the two words in any order, else the first and the last words or, of one word and of Chinese
    names, letters; halves meet those of names of as many words or letters.
    """
    words = F.split("house", " ")
    count = F.when(F.col("han") != "", F.length("han")).when(F.size(words) == 1, -F.length("house")).otherwise(F.size(words))
    read = read.join(entities, "id").select("id", "entity", "trade", "house", "han", F.when(F.size(words) == 2, F.array_sort(words)).otherwise(words).alias("w"), count.alias("n"))
    read = read.select("id", "entity", "trade", "w", "n", (F.col("han") != "").alias("chinese"), F.when(F.col("han") != "", F.col("han")).otherwise(F.col("house")).alias("text"))
    letters = F.col("chinese") | (F.col("n") < 0)
    middle = F.floor(F.abs("n") / 2).cast("int")
    x = F.when(letters, F.substr("text", F.lit(1), middle)).otherwise(F.concat_ws(" ", F.slice("w", 1, middle)))
    y = F.when(letters, F.substr("text", middle + 1)).otherwise(F.concat_ws(" ", F.slice("w", middle + 1, F.size("w"))))
    by = ["entity", "trade", "chinese", "n"]
    halves = read.where("abs(n) > 1").select("id", *by, x.alias("x"), y.alias("y"))
    grown = halves.groupBy(*by).agg(F.min("id").alias("id"), F.collect_set(F.struct("x", "y")).alias("held")).select("id", *by, "held", F.array_distinct("held.x").alias("xs"), F.array_distinct("held.y").alias("ys"))
    each = grown.where("size(xs) > 1 and size(ys) > 1").select("id", *by, "held", "ys", F.explode("xs").alias("x"))
    own = F.transform(F.filter("held", lambda h: h["x"] == F.col("x")), lambda h: h["y"])
    made = each.select("id", *by, "x", F.explode(F.array_except("ys", own)).alias("y"))
    text = F.when(F.col("chinese") | (F.col("n") < 0), F.concat("x", "y")).otherwise(F.concat_ws(" ", "x", "y"))
    new = made.select("id", "trade", F.when(F.col("chinese"), "").otherwise(text).alias("house"), F.when(F.col("chinese"), text).otherwise("").alias("han"))
    return _keys(new, COMPANY, keys_of).distinct()


def _united(read: DataFrame, entities: DataFrame, keys_of) -> DataFrame:
    """(id, key, role, kind) of merged people: the one given name that all their given names may stand for with each of their family names."""
    grown = read.join(entities, "id").groupBy("entity").agg(F.min("id").alias("id"), F.collect_set(F.struct("family", "given")).alias("held"))
    names = F.transform(F.filter("held", lambda h: h["given"] != ""), lambda h: F.split(h["given"], " "))
    shared = F.aggregate("names", F.get("names", F.lit(0)), lambda all_, own: F.array_intersect(all_, own))
    sure = grown.withColumn("names", names).select("id", "held", shared.alias("names")).where("size(names) = 1").select("id", "held", F.get("names", F.lit(0)).alias("given"))
    own = F.transform(F.filter("held", lambda h: h["given"] == F.col("given")), lambda h: h["family"])
    new = sure.select("id", "given", F.explode(F.array_except(F.array_distinct("held.family"), own)).alias("family")).select("id", "family", "given", F.left("given", F.lit(1)).alias("initial"))
    return _keys(new, PERSON, keys_of)


def read_people(texts: DataFrame) -> tuple:
    """The profiles and keys of person names, and the function that gives a profile its keys: one family name (slips allowed) and agreeing given names are one person.

    Short forms stand for their full names; a given name without known short forms stands for itself. An initial alone agrees with the one given name of that family that
    begins with it; where several do, it is joined to none of them.
    """

    def profile(text: str, _) -> tuple[str, str, str] | None:
        person = read_person(text)
        return (person.family, " ".join(person.given), person.initial) if person else None

    def keys_of(family: str, given: str, initial: str) -> Iterator[tuple[str, int, str]]:
        forms = deletions(family) if len(family) > 5 else {family}
        names = given.split()
        for name in names:
            yield from ((f"g|{name}|{f}", BASE, "") for f in forms)
            if name.startswith(OWN):  # written either way round, and with a slip in the given name
                own = name.removeprefix(OWN)
                yield from ((f"g|{OWN}{family}|{f}", BASE, "") for f in (deletions(own) if len(own) > 5 else {own}))
                yield from ((f"q|{f}|{family}", BASE, "") for f in (deletions(own) if len(own) > 5 else {own}))
        if len(names) == 1:
            yield from ((f"i|{initial}|{f}", KIND, names[0]) for f in forms)
        elif not names:
            yield from ((f"o|{initial or '?'}|{f}", BASE, "") for f in forms)
            yield from ((f"i|{initial or '?'}|{f}", PROBE, "") for f in forms)

    read = _read(texts.withColumn("found", F.lit(None)), "person", PERSON, profile)
    return read, _keyed(read, PERSON, keys_of), keys_of


Tables = dict[str, tuple[DataFrame, str, str, str, str | None]]


def _entities(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The rows of all tables (source_table, row_id, text_id) and the entities of each table's texts (source_table, text_id, entity).

    Only distinct profiles are blocked, those of all tables in one run; texts of one profile, and of profiles that
    were merged, belong to one entity.
    """
    held, reads, keys, growing = [], [], [], []
    for name, (rows, row_id, text, kind, address) in tables.items():
        own = with_text_ids(rows, row_id, text)
        held.append(own.select(F.lit(name).alias("source_table"), "row_id", "text_id"))
        texts = own.groupBy("text_id").agg(F.min("text").alias("text"))
        places = learned_places(rows, text, address, load_han(rows.sparkSession)) if address else None
        read, keyed, keys_of = read_companies(texts, places) if kind == "company" else read_people(texts)
        reads.append(read.select(F.lit(name).alias("source_table"), "text_id", "id"))
        keys.append(keyed)
        growing.append((_combined if kind == "company" else _united, read, keys_of))

    def enriched(entities: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionAll, [grow(read, entities, keys_of) for grow, read, keys_of in growing])

    merged = _merge_rounds(checkpoint(reduce(DataFrame.unionAll, keys)), enriched)
    texts = reduce(DataFrame.unionAll, reads).join(merged, "id", "left").select("source_table", "text_id", F.coalesce("entity", "id").alias("entity"))
    return reduce(DataFrame.unionAll, held), checkpoint(texts)


def same_names(tables: Tables) -> DataFrame:
    """(source_table, row_id_a, row_id_b), a < b, of rows of one table whose texts differ and name one company or person.

    tables: name to (rows, row id, text, "company" or "person", address or None). Null, blank and "nothing"
    texts are in no pair, nor are rows of one text with each other. Rows come in at the end, those of all tables
    in one plan.
    """
    return row_pairs(*_entities(tables), within=["source_table"])


def named_entities(tables: Tables) -> DataFrame:
    """(source_table, row_id, entity, links) of each row with a usable name: its class and how many rows of other texts its table has in it.

    The form for tables of any size: a row per row, however many pairs there are.
    """
    return class_rows(*_entities(tables), within=["source_table"])
