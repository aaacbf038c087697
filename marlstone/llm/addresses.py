"""Same postal address written differently, by a gazetteer that is built from the addresses themselves.

Towns, provinces and districts are learned from the data and meet the texts that name them in a join.
Every address text is read into town, street name, street type and house number. The street spellings of
a town are clustered into streets (slips in Latin letters by shared deletions; Chinese characters in
another order, doubled, or one replaced by an unusual one). Each address is then resolved: the hypotheses
of its street that the gazetteer knows are kept in a beam by how well spelling, number, postcode and town
agree, and the best one, if it is alone, gives the street. Places are joined on street and number; block,
floor, suite and room play no part.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import checkpoint
from .hanzi import Han
from .hanzi import load as load_han
from .linkage import class_rows, deletions, is_nothing, key64, probe_edges, row_pairs, spoken, star_edges, with_known, with_text_ids
from .names import common_characters, edits, folded

# Street types and their short forms.
TYPES = {
    "street": "street st str strasse",
    "avenue": "avenue ave av aven",
    "boulevard": "boulevard blvd boul boulv bd bld",
    "road": "road rd ro",
    "lane": "lane ln la",
    "drive": "drive dr drv",
    "court": "court ct crt",
    "parkway": "parkway pkwy pky pkway pwy",
    "place": "place pl platz plaza",
    "allee": "allee all",
    "weg": "weg",
    "rue": "rue r",
    "terrace": "terrace ter terr",
    "way": "way wy",
    "square": "square sq",
    "crescent": "crescent cres",
    "close": "close cl",
    "highway": "highway hwy",
    "quai": "quai",
    "chemin": "chemin ch",
    "gasse": "gasse",
    "ring": "ring",
}
OF_TYPE = {form: kind for kind, forms in TYPES.items() for form in forms.split()}
GLUED = re.compile(r"^([a-z]{4,}?)(strasse|str|allee|all|weg|platz|pl|gasse|ring|damm|ufer)$")
GLUED_TYPE = {"strasse": "street", "str": "street", "allee": "allee", "all": "allee", "platz": "place", "pl": "place"}
FRENCH = frozenset(("rue", "r", "avenue", "ave", "av", "boulevard", "boul", "bd", "blvd", "place", "pl", "quai", "chemin", "allee"))
UNITS = frozenset("suite ste unit rm room floor fl flat apt apartment og etage stock bat batiment level building bldg block bureau zimmer bte".split())
PARTICLES = frozenset("de du des la le les l d del".split())
SHORT_TOWN = {"st": "saint", "ste": "sainte", "mt": "mount", "gt": "great", "pt": "port", "ft": "fort", "nth": "north", "sth": "south", "lwr": "lower", "upr": "upper", "spgs": "springs", "aw": "am wehr"}
ZH_TYPES = ("大道", "大街", "胡同", "路", "街", "巷", "道", "弄")
ZH = "㐀-䶿一-鿿\U00020000-\U000323af"  # all blocks of unified ideographs: a name is never read from behind a rare character
_HAN = re.compile(f"[{ZH}]")
_DIGITS = {c: k for k, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2, "壹": 1, "贰": 2, "叁": 3, "肆": 4, "伍": 5, "陆": 6, "柒": 7, "捌": 8, "玖": 9}
_TENS = {"十": 10, "百": 100, "千": 1000, "拾": 10, "佰": 100, "仟": 1000}
_ZH_STREET = re.compile(f"([{ZH}]{{1,8}}?)({'|'.join(ZH_TYPES)})((?:\\d+)|[零〇一二三四五六七八九十百千两]+)(?=[号#栋幢楼\\s(（]|\\D|$)")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|\d+[a-z]?(?![^\W_])|\d+|[#,;:()\n/·]|-|\.")


@dataclass(frozen=True)
class Address:
    """town '' if it is not given; name and kind of the street; number; place: without a town the words behind the street that
    may name one; sound: the name may be Chinese in Latin letters."""

    town: str
    name: str
    kind: str
    number: str
    postcode: str = ""
    place: str = ""
    han: bool = False
    sound: bool = False


def zh_number(text: str) -> str:
    """A number in digits or Chinese numerals, as digits without leading zeros."""
    if text.isdigit():
        return str(int(text))
    if not any(c in _TENS for c in text):
        return str(int("".join(str(_DIGITS[c]) for c in text)))
    total = digit = 0
    for c in text:
        if c in _TENS:
            total += (digit or 1) * _TENS[c]
            digit = 0
        else:
            digit = _DIGITS[c]
    return str(total + digit)


@dataclass(frozen=True)
class Towns:
    """What is known of the places that one text may name: Chinese towns, the longest first, provinces, districts with their
    town ('' if several have one of that name), Latin towns in plain letters; sounds: words that show a Chinese address in
    Latin letters, with their town."""

    han: tuple[str, ...] = ()
    provinces: tuple[str, ...] = ()
    districts: Mapping[str, str] = field(default_factory=dict)
    latin: frozenset[str] = frozenset()
    sounds: Mapping[str, str] = field(default_factory=dict)


def towns_of(found: Iterable[tuple[str, str, str]]) -> Towns:
    """The Towns of a text from the (kind, value, of) that were found for it."""
    by: dict[str, list[tuple[str, str]]] = {}
    for kind, value, of in sorted(found):
        by.setdefault(kind, []).append((value, of))
    names = lambda kind: [value for value, _ in by.get(kind, ())]
    return Towns(
        tuple(sorted(names("town"), key=lambda x: (-len(x), x))), tuple(names("province")), dict(by.get("district", ())), frozenset(names("latin")), {**_MARKS, **dict(by.get("sound", ()))}
    )


_MARKS = dict.fromkeys(("china", "city", "dist", "district", "province"), "")


def plain_town(text: str) -> str:
    """A Latin town's name in plain letters: short forms written out, umlauts without their second letter."""
    words = re.findall(r"[a-z]+", re.sub(r"\ba\.? ?w\b\.?", "am wehr", folded(text)))
    return re.sub("([aou])e", r"\1", " ".join(SHORT_TOWN.get(w, w) for w in words))


def read_address(text: str | None, towns: Towns, han: Han) -> Address | None:
    """The parts of an address text, None if it gives no street or no house number."""
    if is_nothing(text):
        return None
    if _HAN.search(text) and (found := _read_han(text, towns, han)):
        return found
    return _read_latin(text, towns)


def _read_han(text: str, towns: Towns, han: Han) -> Address | None:
    text = han.simplified(unicodedata.normalize("NFKC", text)).replace("號", "号")
    post = re.search(r"(?<!\d)(\d{6})(?!\d)", text)
    text = re.sub(r"邮编:?\s*\d{6}|(?<!\d)\d{6}(?!\d)", " ", text)
    text = re.sub(rf"(?<=[{ZH}\d#])[ \t](?=[{ZH}\d#])", " ", text)
    town = ""
    rest = re.sub(r"[\s·,，、;；()（）.。:：\-—|/]+", "\n", text)
    for name in towns.han:
        if re.search(f"{name}(?:市|\\n|$)", rest):
            town, rest = name, re.sub(f"{name}市?", "\n", rest, count=1)
            break
    if not town:
        for name in towns.han:
            if name in rest:
                town, rest = name, rest.replace(name, "\n", 1)
                break
    rest = re.sub("中国|中华人民共和国", "\n", rest)
    for name in towns.provinces:
        rest = re.sub(f"(^|\\n){name}(省|州|自治区|特别行政区)?", "\n", rest, count=1)
    rest = re.sub(rf"(^|\n)[{ZH}]{{2,3}}[省州](?=[{ZH}])", "\n", rest)
    for name, of in towns.districts.items():
        if re.search(f"(^|\\n){name}区", rest):
            town, rest = town or of, re.sub(f"(^|\\n){name}区", "\n", rest, count=1)
            break
    else:
        for name, of in towns.districts.items():
            # without its mark a district is taken off only where a street name of two characters or more remains
            if re.search(f"(^|\\n){name}(\\n|[{ZH}]{{2,8}}({'|'.join(ZH_TYPES)})[\\d零〇一二三四五六七八九十百千两])", rest):
                town, rest = town or of, re.sub(f"(^|\\n){name}", "\n", rest, count=1)
                break
    rest = re.sub("(^|\\n)[市区]", "\n", rest)
    match = None
    for found in _ZH_STREET.finditer(rest.replace("\n", " ")):
        match = found
        break
    if not match:
        return None
    name = match[1]
    if "区" in name[:-1] and len(name.partition("区")[2]) > 1:
        name = name.partition("区")[2]
    return Address(town, name, match[2], zh_number(match[3]), post[1] if post else "", han=True)


def _read_latin(text: str, towns: Towns) -> Address | None:
    sounds = towns.sounds
    plain = folded(text.replace("’", "'"))
    tokens = [t for t in _TOKEN.findall(plain)]
    # a hyphen between letters joins them; elsewhere it parts
    joined: list[str] = []
    for k, t in enumerate(tokens):
        if t == "-" and not re.search(r"[a-z]-[a-z]", plain):
            joined.append(",")
        elif t != "-":
            joined.append(t)
        elif k and k + 1 < len(tokens) and tokens[k - 1].isalpha() and tokens[k + 1].isalpha() and f"{tokens[k - 1]}-{tokens[k + 1]}" in plain:
            continue
        else:
            joined.append(",")
    tokens = [t for t in joined if t != "."]
    hits = [h for h in (_street_at(tokens, k) for k in range(len(tokens))) if h]
    town = _town_in(tokens, towns)
    if not hits:
        bare = _bare_street(tokens, town)
        if not bare:
            return None
        hits = [bare]
    name, kind, number = max(hits, key=lambda h: (bool(h[2]), h[1] != "rue", len(h[0]) > 3))
    if not number:
        return None
    post = next((t for t in tokens if re.fullmatch(r"\d{5}", t)), "")
    sound = not town and (any(t in sounds for t in tokens) or " " in name)
    said = next((sounds[t] for t in tokens if sounds.get(t)), "") if sound else town
    return Address(said, name.replace(" ", ""), kind, number, post, "" if said else _place_behind(tokens, name.split()), sound=sound)


def _place_behind(tokens: list[str], name: list[str]) -> str:
    """The words behind a street that may name its town: no unit, type, particle or short word."""
    last = max((k for k, t in enumerate(tokens) if t in name), default=len(tokens))
    words = [t for t in tokens[last + 1 :] if t.isalpha() and len(t) > 3 and t not in UNITS and t not in OF_TYPE and t not in PARTICLES and t not in _MARKS]
    return " ".join(sorted(set(words)))


def _number(tokens: list[str], at: int, step: int) -> str:
    """The house number next to a street, looking left (step -1) or right; '' if a unit or nothing stands there."""
    skipped = 0
    while 0 <= at < len(tokens) and (tokens[at] in ",\n:" or tokens[at] in ("no", "nr")) and skipped < 3:
        if tokens[at] in ",\n:":
            skipped += 1
        at += step
    if not 0 <= at < len(tokens) or not re.fullmatch(r"\d{1,4}[a-z]?", tokens[at]):
        return ""
    before = tokens[at - 1] if at else ""
    after = tokens[at + 1] if at + 1 < len(tokens) else ""
    if before in UNITS or before == "#" or (step > 0 and after in UNITS and after in ("og", "etage", "stock")):
        return ""
    return tokens[at].lstrip("0") or "0"


def _street_at(tokens: list[str], k: int) -> tuple[str, str, str] | None:
    """(name, type, number) if a street type stands at token k."""
    word = tokens[k]
    if glued := GLUED.match(word):
        if glued[1] not in ("over", "well"):
            kind = GLUED_TYPE.get(glued[2], glued[2])
            number = _number(tokens, k + 1, 1) or _number(tokens, k - 1, -1)
            return glued[1], kind, number
    if word not in OF_TYPE or (word in ("r", "ch") and not k):
        return None
    kind = OF_TYPE[word]
    before = tokens[k - 1] if k else ""
    if before.isalpha() and before not in UNITS and before not in ("no", "nr") and before not in OF_TYPE:
        start = k - 1
        while start > 0 and tokens[start - 1].isalpha() and tokens[start - 1] not in UNITS and k - start < 5:
            start -= 1
        left = _number(tokens, start - 1, -1) if start and re.fullmatch(r"\d+[a-z]?|,|no|nr|:", tokens[start - 1]) else ""
        direct = start and re.fullmatch(r"\d{1,4}[a-z]?", tokens[start - 1])
        if direct and left:
            return " ".join(t for t in tokens[start:k] if t not in ("no", "nr")), kind, left
        right = _number(tokens, k + 1, 1)
        if right and not (k + 1 < len(tokens) and tokens[k + 1] == "," and left):
            return before, kind, right
        return (before if not left else " ".join(tokens[start:k]), kind, left or right)
    if word in FRENCH and k + 1 < len(tokens):
        at = k + 1
        while at < len(tokens) and tokens[at] in PARTICLES:
            at += 1
        if at < len(tokens) and tokens[at].isalpha() and tokens[at] not in OF_TYPE and len(tokens[at]) > 2:
            number = _number(tokens, k - 1, -1) or _number(tokens, at + 1, 1)
            return None if word == "r" and not number else (tokens[at], kind, number)
    return None


def _bare_street(tokens: list[str], town: str) -> tuple[str, str, str] | None:
    """A street without a type: a long word straight before a house number, where a town or postcode is given too."""
    if not town and not any(re.fullmatch(r"\d{4,5}", t) for t in tokens):
        return None
    for k in range(len(tokens) - 1):
        if tokens[k].isalpha() and len(tokens[k]) > 6 and tokens[k] not in town.split() and re.fullmatch(r"\d{1,3}[a-z]?", tokens[k + 1]):
            return tokens[k], "", tokens[k + 1]
    return None


def _town_words(tokens: list[str]) -> list[str]:
    return [re.sub("([aou])e", r"\1", w) for t in " ".join(tokens).replace("a w", "am wehr").split() for w in [SHORT_TOWN.get(t, t)]]


def _town_in(tokens: list[str], towns: Towns) -> str:
    words = _town_words(tokens) if towns.latin else []
    for size in range(max((len(t.split()) for t in towns.latin), default=0), 0, -1):
        for k in range(len(words) - size + 1):
            phrase = " ".join(words[k : k + size])
            if phrase in towns.latin:
                return phrase
    return ""


def forms_in(text: str, han: Han, longest: int, most_words: int) -> Iterator[str]:
    """The forms by which a text may name a place: runs of Han characters, phrases of Latin words, and words by sound."""
    if is_nothing(text):
        return
    if _HAN.search(text):
        plain = re.sub(rf"(?<=[{ZH}\d#])[ \t](?=[{ZH}\d#])", "", han.simplified(unicodedata.normalize("NFKC", text)))
        for run in re.findall(f"[{ZH}]+", plain):
            for size in range(2, longest + 1):
                yield from (run[k : k + size] for k in range(len(run) - size + 1))
    tokens = [t for t in _TOKEN.findall(folded(text.replace("’", "'"))) if t not in ("-", ".")]
    words = _town_words(tokens)
    for size in range(1, most_words + 1):
        yield from ("l " + " ".join(words[k : k + size]) for k in range(len(words) - size + 1))
    yield from (t for t in tokens if t.isalpha())


def learned_places(addresses: DataFrame, text: str, cities: DataFrame, city: str, han: Han, least: int = 4) -> DataFrame:
    """(form, kind, value, of): every town of the city values, and the provinces and districts that stand in `least` addresses or more.

    A district that several towns have names none of them. Latin towns are written plainly, behind a mark.
    """
    shared = addresses.sparkSession.sparkContext.broadcast(han)  # of one size

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for c in frame["c"]:
                if not _HAN.search(c):
                    if len(plain := plain_town(c)) > 2:
                        out.append(("l " + plain, "latin", plain, ""))
                elif len(c) > 1 and len(town := re.sub("市$", "", shared.value.simplified(c))) > 1:
                    out.append((town, "town", town, ""))
            yield pd.DataFrame(out, columns=["form", "kind", "value", "of"])

    kinds = "form string, kind string, value string, of string"
    towns = checkpoint(cities.select(F.trim(city).alias("c")).where("c <> ''").distinct().mapInPandas(named, kinds).distinct())
    bare = F.regexp_replace(F.col(text), r"[\s·,，、　]", "")
    part = addresses.select(F.regexp_extract(bare, f"(?:^|国)([{ZH}]{{2}}(?:省|州))", 1).alias("p"), F.regexp_extract(bare, f"([{ZH}]{{2,3}})市[{ZH}]{{2,3}}区", 1).alias("t"), F.regexp_extract(bare, f"[{ZH}]{{2,3}}市([{ZH}]{{2}})区", 1).alias("d"))
    often = part.where("p <> ''").groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    provinces = often.select(F.explode(F.array_distinct(F.array("p", F.regexp_replace("p", "省$", "")))).alias("form"), F.lit("province").alias("kind"), F.col("form").alias("value"), F.lit("").alias("of"))
    pairs = part.where("d <> ''").groupBy("t", "d").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    ends = pairs.select("d", F.explode(F.array_distinct(F.array("t", F.substring("t", 2, 3)))).alias("value")).join(towns.where("kind = 'town'").select("value"), "value")
    districts = ends.groupBy(F.col("d").alias("form")).agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select("form", F.lit("district").alias("kind"), F.col("form").alias("value"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("").alias("of"))
    chinese = towns.where("kind = 'town'").unionAll(districts).unionAll(provinces)
    # by sound a town or district gives its town, a province only shows the script
    heard = spoken(towns.where("kind = 'town'").withColumn("of", F.col("value")).unionAll(districts).unionAll(provinces.where("not value like '%省'")), han).where("kind = 'sound'")
    return checkpoint(towns.where("kind = 'latin'").unionAll(chinese).unionAll(heard.select("form", "kind", F.col("form").alias("value"), "of")))


_PARTS = "text_id bigint, town string, name string, kind string, number string, postcode string, place string, han boolean, sound boolean, syllables string"


def read_all(texts: DataFrame, known: DataFrame, han: Han) -> DataFrame:
    """The parts of every text that gives a place; texts: text_id, text; known: form, kind, value, of."""
    sizes = known.agg(F.max(F.when(F.col("kind").isin("town", "province", "district"), F.length("form"))), F.max(F.when(F.col("kind") == "latin", F.size(F.split("value", " "))))).first()
    longest, most_words = sizes[0] or 1, sizes[1] or 0
    shared = texts.sparkSession.sparkContext.broadcast(han)  # of one size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        han = shared.value
        for frame in batches:
            out = []
            for i, t, found in zip(frame["text_id"], frame["text"], frame["found"], strict=True):
                if a := read_address(t, towns_of((x["kind"], x["value"], x["of"]) for x in found), han):
                    out.append((i, a.town, a.name, a.kind, a.number, a.postcode, a.place, a.han, a.sound, han.syllables(a.name) if a.han else a.name if a.sound else ""))
            yield pd.DataFrame(out, columns=["text_id", "town", "name", "kind", "number", "postcode", "place", "han", "sound", "syllables"])

    seen = with_known(texts.select("text_id", "text"), known, lambda t: forms_in(t, shared.value, longest, most_words))
    return seen.select("text_id", "text", "found").mapInPandas(run, _PARTS)


def _spelling_keys(entries: DataFrame, common: frozenset[str], townless: bool) -> DataFrame:
    """(id, key, role, kind) of gazetteer entries (id, town, name, kind, han); townless keys leave the town out."""
    shared = entries.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = shared.value
        for frame in batches:
            out = []
            for i, town, name, kind, han in zip(frame["id"], frame["town"], frame["name"], frame["kind"], frame["han"], strict=True):
                head = f"{'' if townless else town}|{kind}"
                if not han:
                    forms = deletions(name) if len(name) > 5 else {name}
                    out += [(i, key64(f"L|{head}|{f}"), "base", "") for f in forms]
                    continue
                out.append((i, key64(f"H|{head}|{''.join(sorted(set(name)))}"), "base", ""))
                odd = [k for k, c in enumerate(name) if common and c not in common]
                if not odd:
                    out += [(i, key64(f"W|{head}|{name[:k]}*{name[k + 1:]}"), "kind", name) for k in range(len(name))]
                elif len(odd) == 1 and len(name) > 1:
                    out.append((i, key64(f"W|{head}|{name[:odd[0]]}*{name[odd[0] + 1:]}"), "probe", ""))
            yield pd.DataFrame(out, columns=["id", "key", "role", "kind"])

    return entries.select("id", "town", "name", "kind", "han").mapInPandas(run, "id bigint, key bigint, role string, kind string")


def gazetteer(parts: DataFrame, common: frozenset[str]) -> DataFrame:
    """(id, street): the street of every spelling (id: hash of town, name and type) that stands with a town."""
    entries = parts.where("town <> '' and not sound").select(_entry().alias("id"), "town", "name", "kind", "han").distinct()
    keyed = checkpoint(_spelling_keys(entries, common, townless=False))
    edges = star_edges(keyed.where("role = 'base'").select("id", "key")).unionAll(
        probe_edges(keyed.where("role = 'probe'").select("id", "key"), keyed.where("role in ('base', 'kind')").select("id", "key", "kind"))
    )
    joined = components(edges)
    return entries.join(joined, entries["id"] == joined["node"], "left").select("id", F.coalesce("component", "id").alias("street"))


def _entry():
    return F.xxhash64("town", "name", "kind")


def resolved(parts: DataFrame, streets: DataFrame, common: frozenset[str], beam: int = 4) -> DataFrame:
    """(text_id, street, number) of every read address; the street of one without a town is found by beam search.

    Hypotheses are the gazetteer's places of the same number whose street shares a key with the address's
    spelling and whose postcodes do not speak against it. They are scored by spelling and postcode; the beam keeps the best of each address, and the
    first gives the street unless another street scores as well. An address that nothing resolves keeps a
    street of its own spelling and of the place words behind it, so that equal spellings of one place still meet.
    An address with a town is an entry itself, which no other hypothesis can outscore, so the search has
    nothing to expand for it.
    """
    placed = parts.where("town <> '' and not sound").withColumn("id", _entry()).join(streets, "id")
    known = placed.select("text_id", "street", "number")
    open_ = parts.where("town = '' and not sound").withColumn("id", F.col("text_id"))
    entries = placed.select("id", "town", "name", "kind", "han", "street", "number", "postcode").distinct()
    base_keys = _spelling_keys(entries.select("id", "town", "name", "kind", "han").distinct(), common, townless=True).where("role <> 'probe'").select(F.col("id").alias("e"), "key")
    open_keys = _spelling_keys(open_.select("id", "town", "name", "kind", "han"), common, townless=True).where("role <> 'kind'").select("id", "key")
    asked = open_keys.join(open_.select("id", "number", F.col("name").alias("n"), F.col("postcode").alias("p")), "id").select("id", "key", "number", "n", "p")
    places = base_keys.join(entries.select(F.col("id").alias("e"), "number", "name", "street", "postcode"), "e").select("key", "number", "name", "street", "postcode")
    same_post = (F.col("p") != "") & (F.col("p") == F.col("postcode"))
    hypotheses = (
        asked.join(places, ["key", "number"])
        .groupBy("id", "number", "street")
        .agg(F.max(F.when(F.col("n") == F.col("name"), 2).otherwise(0)).alias("spelled"), F.bool_or(same_post).alias("met"), F.bool_or((F.col("p") != "") & (F.col("postcode") != "")).alias("both"))
        # a place whose postcodes are known and differ is another one
        .where("met or not both")
        .select("id", "number", "street", (F.col("spelled") + F.when(F.col("met"), 3).otherwise(0)).alias("score"))
    )
    ranked = hypotheses.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "street"))).where(F.col("place") <= beam)
    best = ranked.groupBy("id").agg(F.max_by("street", F.struct("score", -F.col("place"))).alias("found"), F.max("score").alias("top"), F.collect_list("score").alias("scores"))
    alone = best.where(F.size(F.filter("scores", lambda s: s == F.col("top"))) == 1).select("id", "found")
    own = F.xxhash64(F.lit("own"), "name", "kind", "place")
    loose = open_.join(alone, "id", "left").select("text_id", F.coalesce("found", own).alias("street"), "number")
    return known.unionAll(loose)


def slips(a: str, b: str) -> int:
    """The slips that two spellings of a street may be apart where postcode and house number agree."""
    size = max(len(a), len(b))
    return 2 if size > 7 else 1 if size > 5 else 0


def coded_edges(parts: DataFrame) -> DataFrame:
    """(a, b): texts of one postcode, house number, town and street type whose street names are a slip or two apart.

    Postcode, number and what is left of a name without up to two letters are the key under which names meet;
    the edit distance decides. A text without a town or type is joined where all full ones that it meets agree
    in both.
    """
    own = ["postcode", "number", "town", "name", "kind"]
    coded = parts.where("postcode <> '' and number <> '' and not han and not sound").select("text_id", *own)
    entries = coded.groupBy(*own).agg(F.min("text_id").alias("id"))
    several = entries.groupBy("postcode", "number").agg(F.count("*").alias("n")).where("n > 1").select("postcode", "number")

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for i, postcode, number, town, name, kind in frame[["id", *own]].itertuples(index=False):
                once = deletions(name) if len(name) > 4 else {name}
                forms = once.union(*map(deletions, once)) if len(name) > 5 else once
                out += [(i, town, name, kind, key64(f"{postcode}|{number}|{f}")) for f in forms]
            yield pd.DataFrame(out, columns=["id", "town", "name", "kind", "key"])

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame[[edits(a, b, 2) <= slips(a, b) for a, b in zip(frame["na"], frame["nb"], strict=True)]]

    keyed = checkpoint(entries.join(several, ["postcode", "number"]).select("id", *own).mapInPandas(keys, "id bigint, town string, name string, kind string, key bigint"))
    left, right = (keyed.select("key", *[F.col(c).alias(c[0] + e) for c in ("id", "town", "name", "kind")]) for e in "ab")
    agree = [(F.col(f"{c}a") == F.col(f"{c}b")) | (F.col(f"{c}a") == "") | (F.col(f"{c}b") == "") for c in "tk"]
    met = left.join(right, "key").where((F.col("ia") < F.col("ib")) & agree[0] & agree[1]).drop("key").distinct()
    pairs = checkpoint(met.mapInPandas(near, met.schema))
    alike = pairs.where("ta = tb and ka = kb").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    vague = None
    for i, j in ("ab", "ba"):
        asked = pairs.where(f"(t{i} = '' or k{i} = '') and t{j} <> '' and k{j} <> ''")
        asked = asked.select(F.col(f"i{i}").alias("key"), F.col(f"i{j}").alias("id"), F.concat_ws("|", f"t{j}", f"k{j}").alias("kind"))
        vague = asked if vague is None else vague.unionAll(asked)
    same = coded.join(entries, own).where("text_id <> id").select(F.col("text_id").alias("a"), F.col("id").alias("b"))
    return alike.unionAll(same).unionAll(probe_edges(vague.select(F.col("key").alias("id"), "key").distinct(), vague))


def place_entities(texts: DataFrame, known: DataFrame, han: Han) -> DataFrame:
    """(text_id, entity) of the address texts whose place another text gives too; texts: text_id, text."""
    parts = checkpoint(read_all(texts, known, han))
    common = common_characters(parts.where("han").select(F.col("name").alias("text")))
    streets = checkpoint(gazetteer(parts, common))
    places = checkpoint(resolved(parts, streets, common))  # read by place and by sound, searched once
    keyed = places.select(F.col("text_id").alias("id"), F.xxhash64(F.lit("place"), "street", "number").alias("key"))
    # a Chinese street in Latin letters is joined by sound, number and town, or by the first two where they name one street
    said = lambda town: F.xxhash64(F.lit("sound"), "syllables", "number", town)
    spoken = parts.where("sound").select(F.col("text_id").alias("id"), said(F.col("town")).alias("key"))
    written = parts.where("han").join(places.select("text_id", "street"), "text_id")
    bases = written.select(F.col("text_id").alias("id"), F.explode(F.array(said(F.col("town")), said(F.lit("")))).alias("key"), F.col("street").cast("string").alias("kind"))
    edges = star_edges(keyed.unionAll(spoken)).unionAll(probe_edges(spoken, bases)).unionAll(coded_edges(parts))
    return components(edges).select(F.col("node").alias("text_id"), F.col("component").alias("entity"))


Tables = dict[str, tuple[DataFrame, str, str]]


def _places(tables: Tables, cities: DataFrame, city: str) -> tuple[DataFrame, DataFrame]:
    """The rows of all tables (source_table, row_id, text_id) and the places of each table's texts (source_table, text_id, entity), by one gazetteer."""
    han = load_han(cities.sparkSession)
    own = [with_text_ids(rows, row_id, text).withColumn("source_table", F.lit(name)) for name, (rows, row_id, text) in tables.items()]
    union = reduce(DataFrame.unionAll, own)
    texts = checkpoint(union.groupBy("text_id").agg(F.min("text").alias("text")))
    entities = checkpoint(place_entities(texts, learned_places(texts, "text", cities, city, han), han))
    held = union.select("source_table", "row_id", "text_id")
    return held, held.select("source_table", "text_id").distinct().join(entities, "text_id")


def same_places(tables: Tables, cities: DataFrame, city: str) -> DataFrame:
    """(source_table, row_id_a, row_id_b), a < b, of rows of one table whose texts differ and give one place.

    tables: name to (rows, row id, text). One gazetteer is built from the texts of all tables, and one plan
    makes the pairs of all of them. Null, blank and "nothing" texts, and texts without a street and house
    number, are in no pair.
    """
    return row_pairs(*_places(tables, cities, city), within=["source_table"])


def placed_rows(tables: Tables, cities: DataFrame, city: str) -> DataFrame:
    """(source_table, row_id, place, links) of each row whose place another text gives too; links: its table's rows of other texts there.

    The form for tables of any size: a row per row, however many pairs there are.
    """
    return class_rows(*_places(tables, cities, city), within=["source_table"]).withColumnRenamed("entity", "place")
