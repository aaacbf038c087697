"""Language of each document and of each passage of mixed text: scripts, per-word scores and Viterbi spans.

The scripts of a text narrow its candidates: a script of one language needs no label, Latin words leave the
languages that the sample knows. Word scores are fitted on a bounded sample of labelled documents: words are counted by the label, the
sample's sentences are classified with these counts and counted again by their own class, so wrong
labels and foreign passages wash out. A text's words are then labelled by Viterbi, where changing the
language costs much inside a sentence and little between sentences.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notations of languages, ISO 639-1 first, then 639-2 and 639-3 codes and names.
NOTATIONS = {
    "en": "eng english englisch anglais 英语 英文",
    "de": "deu ger german deutsch allemand 德语",
    "fr": "fra fre french français francais französisch 法语",
    "es": "spa spanish español espanol castellano spanisch 西班牙语",
    "pt": "por portuguese português portugues 葡萄牙语",
    "nl": "nld dut dutch nederlands flemish 荷兰语",
    "it": "ita italian italiano italienisch 意大利语",
    "zh": "zho chi chinese cmn mandarin 中文 汉语 chinesisch",
    "ja": "jpn japanese 日本語 日语 jp japanisch",
    "ko": "kor korean 한국어",
    "ru": "rus russian русский",
    "pl": "pol polish polski",
    "sv": "swe swedish svenska",
    "da": "dan danish dansk",
    "cs": "ces cze czech čeština",
    "tr": "tur turkish türkçe",
    "ar": "ara arabic العربية",
    "fi": "fin finnish suomi",
    "el": "ell gre greek ελληνικά",
    "no": "nor nob norwegian norsk",
    "hu": "hun hungarian magyar",
    "ro": "ron rum romanian română",
    "he": "heb hebrew עברית",
    "th": "tha thai ไทย",
}
BY_NOTATION = {word: code for code, words in NOTATIONS.items() for word in (code, *words.split())}
# Scripts that name their language whatever the sample's labels, by their ranges. Latin words are scored one by one.
SCRIPTS = {
    "ja": r"\u3040-\u30ff\u31f0-\u31ff\uff66-\uff9f",
    "zh": r"\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u3005",
    "ko": r"\uac00-\ud7af\u1100-\u11ff",
    "ru": r"\u0400-\u052f",
    "el": r"\u0370-\u03ff\u1f00-\u1fff",
    "ar": r"\u0600-\u06ff\u0750-\u077f",
    "he": r"\u0590-\u05ff",
    "th": r"\u0e00-\u0e7f",
}

SAMPLE = 6000  # labelled documents that the word scores are fitted on, at most
INSIDE, BETWEEN = 9.0, 2.5  # cost of a change of language inside a sentence, between sentences
EVIDENCE = 4.0  # log odds against the next language that a whole sentence must have
MIN_WORDS = 3
BATCH_WORDS = 400_000
LOOK_AHEAD = 400  # words of the text in which the next word of a sentence is looked for

_TAG = re.compile(r"<[^<>]{1,200}>")
_LINK = re.compile(r"\S+@\S+|https?://\S+|www\.\S+")
_INVISIBLE = re.compile(r"[­​-‏⁠-⁤﻿]")
_BRACKETS = re.compile(r"\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]|【[^【】]*】")
_QUOTE = re.compile(r"«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|‹[^‹›]*›")
_TABLE = re.compile(r"\t|\S\s*\|\s*\S|\S {2,}\S+ {2,}\S| ?; ?\d+ ?; ?")
_END = re.compile(r"(?<=[.!?…:])(?<![^A-Za-z.][A-Z]\.)[\"'”’»)]*\s+(?=[\"'“‘«(¿¡]*[^\W_])|(?<=[。！？])|\n{2,}")
_ENDED = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")
_WORD = re.compile(r"[぀-ヿㇰ-ㇿｦ-ﾟ]+|[㐀-䶿一-鿿豈-﫿々]+|[가-힯]+|[฀-๿]+|[^\W\d_぀-ヿ㐀-䶿一-鿿豈-﫿가-힯฀-๿]+(?:['’][a-zà-ÿ]+)?")
_LATIN = re.compile("[a-zß-ÿĀ-ɏḀ-ỿ'’]+$")
_CJK = re.compile("[぀-ヿㇰ-ㇿｦ-ﾟ㐀-䶿一-鿿豈-﫿々가-힯]")
_HAN = re.compile(r"[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
_SCRIPT = {code: re.compile(f"[{chars}]") for code, chars in SCRIPTS.items()}
_UNSPACED = ("zh", "ja", "ko", "th")  # their words are counted in characters



def label_code(label: Column) -> Column:
    """The two-letter code of a label in any known notation, with region or script behind - or _; null if it names no language."""
    head = F.regexp_extract(F.lower(F.trim(label)), r"^([^-_\s(]+)", 1)
    table = F.create_map(*[F.lit(x) for pair in BY_NOTATION.items() for x in pair])
    return F.try_element_at(table, head)


def code_of(label: str | None) -> str | None:
    head = re.match(r"[^-_\s(]+", (label or "").strip().lower())
    return BY_NOTATION.get(head[0]) if head else None


def sentences(text: str) -> list[tuple[str, int]]:
    """(sentence, offset) of the running text: without markup, links, bracketed terms, cut quotations and table lines.

    The offset is that of the sentence's line in the text, so spans point into the text as it stands.
    """
    out: list[tuple[str, int]] = []
    block: list[str] = []
    start = at = 0
    for line in [*text.split("\n"), ""]:
        bare = line.strip().lstrip("> ").strip()
        if not bare or _TABLE.search(bare) and _is_table(bare):
            out += [(s, start) for s in _cut("\n".join(block))]
            block, start = [], at + len(line) + 1
        else:
            if not block:
                start = at
            block.append(bare)
        at += len(line) + 1
    out += [(s, start) for s in _cut("\n".join(block))]
    return out


def _is_table(line: str) -> bool:
    """Whether a line with cell marks is a row of codes and numbers: no cell is running text, and few tokens are words."""
    if len(_CJK.findall(line)) > 12:
        return False
    parts = line.split()
    worded = sum(bool(re.fullmatch(r"[^\W\d_]{2,}[.,;:!?]?", w)) for w in parts)
    if "\t" in line or "|" in line:
        return all(sum(w.isalpha() for w in c.split()) < 4 and not _HAN.search(c) for c in re.split(r"\t|\|", line))
    return 2 * worded < len(parts)


def _cut(block: str) -> Iterator[str]:
    block = unicodedata.normalize("NFKC", _INVISIBLE.sub("", html.unescape(block)))
    block = _LINK.sub(" ", _TAG.sub("\n", block))
    for _ in range(2):
        block = _BRACKETS.sub(" ", block)
    block = _QUOTE.sub(lambda m: m[0] if re.search(r"[.!?。！？]\W*$", m[0]) else " " if len(m[0].split()) > 2 else m[0], block)
    block = re.sub(r"(\w)-\n(\w)", r"\1\2", block)
    for part in _END.split(block):
        if part and part.strip():
            yield " ".join(part.split())


def tokens(sentence: str) -> list[str]:
    return _WORD.findall(sentence.lower())


@dataclass
class Model:
    """languages, the row of each word and the matrix of their scores; row 0 is the unknown word's."""

    languages: list[str]
    vocabulary: dict[str, int]
    scores: np.ndarray

    def rows(self, words: list[str]) -> list[int]:
        """Score rows of a sentence's words; the last rows are those of the scripts, in their order."""
        out, size = [], len(self.scores) - len(SCRIPTS)
        kana = False
        for w in words:
            row = self.vocabulary.get(w)
            if row is None:
                script = None if w.isascii() else script_of(w)
                row = 0 if script is None else size + script
                kana |= script == 0
            out.append(row)
        return [size if r == size + 1 else r for r in out] if kana else out  # Han words beside Kana are Japanese

    def candidates(self, rows: np.ndarray) -> tuple[int, ...]:
        """The languages that the scripts of a text leave: those of Latin words and of each other script that it holds."""
        size = len(self.scores) - len(SCRIPTS)
        found = {int(r) - size for r in np.unique(rows[rows >= size])}
        codes = list(SCRIPTS)
        named = {codes[k] for k in found} | ({"ja"} if 1 in found else set())
        latin = [k for k, c in enumerate(self.languages) if c not in SCRIPTS] if (rows < size).any() else []
        return tuple(sorted([*latin, *(self.languages.index(c) for c in named)]))


@lru_cache(maxsize=100_000)
def script_of(word: str) -> int | None:
    """The place in SCRIPTS of the first script that a word holds, None for a Latin or other one."""
    return next((k for k, p in enumerate(_SCRIPT.values()) if p.search(word)), None)


def fit(rows: Iterable[tuple[str, str]], rounds: int = 3) -> Model:
    """Word scores from (text, language code) pairs; wrong labels are outvoted by the rounds of reclassification."""
    documents = [(code, [tokens(s) for s, _ in sentences(text)]) for text, code in rows]
    languages = sorted({c for c, _ in documents} | set(SCRIPTS))
    of = {c: k for k, c in enumerate(languages)}
    vocabulary: dict[str, int] = {}
    lines, labels = [], []
    for code, parts in documents:
        for words in parts:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words if _LATIN.match(w)]
            # sentences in another script than their label's say nothing about its words
            if ids and len(ids) > len(words) // 2 and code not in SCRIPTS:
                lines.append(np.array(ids))
                labels.append(of[code])
    latin = [of[c] for c in languages if c not in SCRIPTS]
    size, count = len(vocabulary) + 1, len(languages)
    scores = np.zeros((size + len(SCRIPTS), count), dtype=np.float32)
    if lines and latin:
        flat, lengths = np.concatenate(lines), np.array([len(x) for x in lines])
        owner = np.repeat(np.arange(len(lines)), lengths)
        current = np.array(labels)
        weight = np.ones(len(lines))
        for _ in range(rounds + 1):
            counts = np.zeros((size, count))
            np.add.at(counts, (flat, current[owner]), weight[owner])
            share = (counts[:, latin] + 0.1) / (counts[:, latin].sum(0) + 0.1 * size)
            score = np.log(share) - np.log(share).mean(1, keepdims=True)
            score *= np.minimum(1, counts.sum(1) / 3)[:, None]  # words seen once or twice say little
            table = np.zeros((size, count), dtype=np.float32)
            table[:, latin] = np.clip(score, -5, 5)
            table[0] = 0
            total = np.zeros((len(lines), count))
            np.add.at(total, owner, table[flat])
            ranked = np.sort(total[:, latin], 1)
            current = np.array(latin)[total[:, latin].argmax(1)]
            weight = (ranked[:, -1] - ranked[:, -2] > 3).astype(float) if len(latin) > 1 else weight
        scores[:size] = table
    other = [of[c] for c in languages if c in SCRIPTS]
    scores[1:size][:, other] = -1.0  # a known Latin word is weak evidence against another script
    scores[size:] = -8
    for k, code in enumerate(SCRIPTS):
        scores[size + k, of[code]] = 8
    scores[size + 1, of["ja"]] = 2
    return Model(languages, vocabulary, scores)


def _viterbi(scores: np.ndarray, batch: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The best column of scores for every word of each text; (rows, whether the word begins a sentence). Texts go through together."""
    count, longest, states = len(batch), max(len(r) for r, _ in batch), scores.shape[1]
    rows = np.zeros((count, longest), dtype=np.int64)
    cost = np.full((count, longest), INSIDE, dtype=np.float32)
    for k, (r, first) in enumerate(batch):
        rows[k, : len(r)] = r
        cost[k, : len(r)][first] = BETWEEN
    best = scores[rows[:, 0]].copy()
    each = np.arange(count)
    kept = np.zeros((longest, count, states), dtype=bool)
    source = np.zeros((longest, count), dtype=np.int8)
    for t in range(1, longest):
        top = best.argmax(1)
        jump = best[each, top] - cost[:, t]
        stay = best >= jump[:, None]
        kept[t], source[t] = stay, top
        best = np.where(stay, best, jump[:, None]) + scores[rows[:, t]]
    # words beyond a text's end are unknown and change nothing, so the end's best state is the text's
    path = np.zeros((count, longest), dtype=np.int8)
    state = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        path[:, t] = state
        state = np.where(kept[t, each, state], state, source[t]) if t else state
    return [path[k, : len(r)] for k, (r, _) in enumerate(batch)]


@dataclass(frozen=True)
class Labelled:
    """A sentence with its words' languages: lang leads, margin is its log odds to the next one, size the words that speak
    for it (0 if the sentence is in several languages); path has the place of each word's language in the model."""

    offset: int
    sentence: str
    words: list[str]
    path: np.ndarray
    lang: str
    margin: float
    size: int


def label_texts(model: Model, texts: list[str | None]) -> Iterator[list[Labelled]]:
    """The labelled sentences of each text."""
    parted: list[list[tuple[str, int, list[str]]]] = []
    prepared: list[tuple[np.ndarray, np.ndarray] | None] = []
    groups: dict[tuple[int, ...], list[int]] = {}
    for k, text in enumerate(texts):
        parts = [(s, o, tokens(s)) for s, o in sentences(text)] if text and text.strip() else []
        parts = [p for p in parts if p[2]]
        rows = [model.rows(w) for _, _, w in parts]
        flat = np.array([x for r in rows for x in r], dtype=np.int64)
        first = np.zeros(len(flat), dtype=bool)
        first[np.cumsum([0, *map(len, rows)])[:-1]] = True
        parted.append(parts)
        prepared.append((flat, first) if len(flat) else None)
        if len(flat):
            groups.setdefault(model.candidates(flat), []).append(k)
    paths: dict[int, np.ndarray] = {}
    for languages, members in groups.items():
        own, narrowed = np.array(languages, dtype=np.int8), model.scores[:, list(languages)]
        order = sorted(members, key=lambda k: len(prepared[k][0]), reverse=True)
        while order:
            # the shortest first, as many as fit when all are as long as the longest of them
            batch, longest = [], 0
            while order and (not batch or max(longest, len(prepared[order[-1]][0])) * (len(batch) + 1) <= BATCH_WORDS):
                longest = max(longest, len(prepared[order[-1]][0]))
                batch.append(order.pop())
            paths.update((k, own[p]) for k, p in zip(batch, _viterbi(narrowed, [prepared[k] for k in batch]), strict=True))
    for k, parts in enumerate(parted):
        out, at = [], 0
        for sentence, offset, words in parts:
            path, rows = paths[k][at : at + len(words)], prepared[k][0][at : at + len(words)]
            at += len(words)
            out.append(_labelled(model, offset, sentence, words, path, rows))
        yield out


def _labelled(model: Model, offset: int, sentence: str, words: list[str], path: np.ndarray, rows: np.ndarray) -> Labelled:
    size = len(model.scores) - len(SCRIPTS)
    lead = int(np.bincount(path).argmax())
    lang = model.languages[lead]
    own = None  # all words, unless the sentence quotes words of another script
    if rows.max() >= size + 2:
        script = np.where(rows < size + 2, 0, rows - size)  # Latin, Kana and Han words are judged together
        of = list(SCRIPTS).index(lang) if lang in SCRIPTS else 0
        own = script == (of if of > 1 else 0)
        # fewer words of another script are a name or mark; as many are the sentence's own
        own = own if 2 * own.sum() >= len(own) else None
    kept = rows if own is None else rows[own]
    total = model.scores[kept].sum(0)
    top, total[lead] = float(total[lead]), -np.inf
    margin = top - float(total.max())
    pure = np.count_nonzero((path if own is None else path[own]) == lead)
    if pure < 0.8 * len(kept):
        return Labelled(offset, sentence, words, path, lang, margin, 0)
    # single letters are mostly initials; of a text without blanks its own characters count
    if lang in _UNSPACED:
        held = sum(len(w) for k, w in enumerate(words) if (own is None or own[k]) and not w.isascii() and script_of(w) is not None)
    else:
        long = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) > 1
        held = int(np.count_nonzero(long & (model.scores[rows, lead] > 0.5)))
    return Labelled(offset, sentence, words, path, lang, margin, held)


def _whole(found: Labelled) -> bool:
    """Whether a sentence is a whole one of one language: it is ended or long, and its words speak for its language."""
    unit = 3 if found.lang in _UNSPACED else 1
    return found.margin >= EVIDENCE and found.size >= (MIN_WORDS if _ENDED.search(found.sentence) else 8) * unit


def confidence_of(margin: float) -> float:
    """From 0 to 1 by the odds against the next language."""
    return float(1 - np.exp(-max(margin, 0) / 2))


def segments(model: Model, text: str, found: list[Labelled]) -> list[tuple[int, int, str, float, str, bool]]:
    """(start, end, language, confidence, text, whole) of the runs of one language in each sentence, in the text as it stands.

    Start and end are those of a run's first and last word that the text holds as written; what a sentence
    leaves out (markup, bracketed terms, links) lies between. No sentence is left out: one of several
    languages gives a segment for each run of its Viterbi path.
    """
    places = [(m[0], m.start(), m.end()) for m in _WORD.finditer("".join(c.lower() if len(c.lower()) == 1 else c for c in text))]
    out, at = [], 0
    for one in found:
        whole = _whole(one)
        cuts = [0] if one.size else [0, *(k for k in range(1, len(one.path)) if one.path[k] != one.path[k - 1])]
        for low, high in zip(cuts, [*cuts[1:], len(one.words)], strict=True):
            lang = one.lang if one.size else model.languages[one.path[low]]
            start = end = None
            for word in one.words[low:high]:
                hit = next((k for k in range(at, min(at + LOOK_AHEAD, len(places))) if places[k][0] == word), None)
                if hit is not None:
                    start, end, at = places[hit][1] if start is None else start, places[hit][2], hit + 1
            if start is None:
                start = end = one.offset
            column = model.languages.index(lang)
            total = model.scores[model.rows(one.words[low:high])].sum(0)
            margin = one.margin if one.size else float(total[column] - max(np.delete(total, column), default=0))
            out.append((start, end, lang, round(confidence_of(margin), 4), text[start:end], whole))
    return out


def fitted(documents: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of the documents whose label names a language: those of the smallest key hashes.

    The labelled documents are counted first, so that only hashes below a threshold, about a fifth more than
    the sample, leave their partitions, however many partitions there are.
    """
    named = documents.select(F.xxhash64(key).alias("h"), text, label_code(F.col(label)).alias("code")).where("code is not null")
    count = named.count()
    below = int(-(2**63) + 2**64 * min(1.0, (1.2 * sample + 200) / max(1, count))) - 1
    near = named.where((F.col("h") <= below) & (F.length(F.trim(text)) > 0))
    rows = near.orderBy("h", text).limit(sample).select(text, "code").collect()
    return fit([(r[0], r[1]) for r in rows])


def document_languages(documents: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, lang, confidence, sentences): each language that holds at least one whole sentence of the document.

    confidence is the mean over the language's sentences of the odds against the next language, from 0 to 1.
    Null, empty and blank texts, and texts of codes and tables only, give no row. One pass without a shuffle.
    """
    spans = passages(documents, key, text, model).where("whole")
    return spans.groupBy(key, "lang").agg(F.avg("confidence").alias("confidence"), F.count("*").alias("sentences"))


def passages(documents: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key, pos, start, end, lang, confidence, passage, whole) of each segment of one language, in order; see segments."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kind = dict(documents.dtypes)[key]
    columns = ["k", "pos", "start", "end", "lang", "confidence", "passage", "whole"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = frame["t"].tolist()
            labelled = zip(frame["k"], texts, label_texts(shared.value, texts), strict=True)
            yield pd.DataFrame([(k, pos, *row) for k, t, found in labelled for pos, row in enumerate(segments(shared.value, t, found))], columns=columns)

    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null and trim(t) <> ''")
    return rows.mapInPandas(run, f"k {kind}, pos int, start int, end int, lang string, confidence double, passage string, whole boolean").withColumnRenamed("k", key)


def wrong_or_mixed(documents: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, lang, confidence) of the documents whose label is missing, names no language or a language without a
    whole sentence, or that hold whole sentences in more than one language."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for k, code, found in zip(frame["k"], frame["code"], label_texts(shared.value, frame["t"].tolist()), strict=True):
                by: dict[str, list[float]] = {}
                for one in found:
                    if _whole(one):
                        by.setdefault(one.lang, []).append(confidence_of(one.margin))
                if len(by) > 1 or (by and code not in by):
                    out += [(k, lang, round(sum(c) / len(c), 4)) for lang, c in by.items()]
            yield pd.DataFrame(out, columns=["k", "lang", "confidence"])

    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), label_code(F.col(label)).alias("code")).where("t is not null and trim(t) <> ''")
    return rows.mapInPandas(run, f"k {kind}, lang string, confidence double").withColumnRenamed("k", key)
