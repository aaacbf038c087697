"""Evaluation texts inside training texts, by greedy string tiling.

Seeds are runs of three words, hashed by a rolling polynomial (Karp-Rabin). Documents are probed with the
items' seeds; a document that shares as many of an item's seeds as the asked coverage cannot do without is
tiled against it: the longest common runs of words are marked first, then the longest of what is left,
until none of the least length is left.
Passages may stand in one piece or several and in any order; the share of the item's words under tiles
decides. Each item is judged against the whole document: items that are alike share sentences, and words
that one of them holds count for the others too.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 3  # words of a seed, and of the shortest tile
SHARE = 0.5  # of an item's words that a document must hold
REACH = 2  # words between two tiles that may be retyped ones
SEED_BOUND = 2_000_000  # seeds of all items up to which they are probed inside the workers; more are joined by a shuffle
_BASE = 1_099_511_628_211
_MASK = (1 << 64) - 1
_TAG = re.compile(r"<[^<>]{1,200}>")
_INVISIBLE = re.compile(r"[­​-‏⁠-⁤﻿]")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐]\n[> ]*(?=[^\W\d_])")
_WORD = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿]|[^\W_぀-ヿ㐀-䶿一-鿿豈-﫿]+")


def split_words(text: str | None) -> list[str]:
    """The words of a text in lower case, without markup, marks and accents; each Han and Kana character is a word."""
    if not text:
        return []
    text = _BROKEN.sub("", _TAG.sub(" ", html.unescape(_INVISIBLE.sub("", text))))
    text = unicodedata.normalize("NFKD", text.casefold())
    return _WORD.findall("".join(c for c in text if not unicodedata.combining(c)))


@lru_cache(maxsize=200_000)
def _code(word: str) -> int:
    data = word.encode()
    return (zlib.crc32(data) << 32 | zlib.adler32(data[::-1] + b"#")) & _MASK


def codes(words: list[str]) -> np.ndarray:
    return np.fromiter((_code(w) for w in words), dtype=np.uint64, count=len(words))


def rolling(values: np.ndarray, size: int = SEED) -> np.ndarray:
    """The polynomial hash of every run of size values."""
    if len(values) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(values) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + values[k : len(values) - size + 1 + k]
    return out


def tiles(document: np.ndarray, item: np.ndarray, size: int = SEED) -> list[tuple[int, int, int]]:
    """(place in the document, place in the item, words) of the tiles, longest first; no word is in two tiles."""
    left, right = rolling(document, size), rolling(item, size)
    order = np.argsort(right, kind="stable")
    low, high = np.searchsorted(right[order], left, "left"), np.searchsorted(right[order], left, "right")
    count = high - low
    at = np.repeat(np.arange(len(left)), count)
    if not len(at):
        return []
    offset = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    to = order[np.repeat(low, count) + offset]
    line = np.lexsort((at, at - to))
    at, to = at[line], to[line]
    begins = np.r_[True, (np.diff(at) != 1) | (np.diff(at - to) != 0)]
    first = np.flatnonzero(begins)
    lengths = np.diff(np.r_[first, len(at)]) + size - 1
    runs = sorted(zip(at[first].tolist(), to[first].tolist(), lengths.tolist(), strict=True), key=lambda r: (r[2], -r[0], -r[1]))
    used_a, used_b = np.zeros(len(document), dtype=bool), np.zeros(len(item), dtype=bool)
    out = []
    while runs:
        i, j, n = runs.pop()
        free = ~(used_a[i : i + n] | used_b[j : j + n])
        if free.all():
            used_a[i : i + n] = used_b[j : j + n] = True
            out.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.r_[False, free, False].astype(np.int8)))
        rest = [(i + int(a), j + int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= size]
        if rest:
            runs = sorted([*runs, *rest], key=lambda r: (r[2], -r[0], -r[1]))
    return out


def coverage(document: list[str], item: list[str]) -> float:
    """The share of the item's words that the document holds under tiles, with single retyped words between tiles."""
    return _held(codes(document), codes(item), document, item)


def _held(a: np.ndarray, b: np.ndarray, document: list[str], item: list[str]) -> float:
    found = sorted(tiles(a, b), key=lambda t: t[0])
    total = sum(n for _, _, n in found)
    for (i, j, n), (x, y, _) in zip(found, found[1:], strict=False):
        # up to REACH words between neighbouring tiles that stand in both texts are retyped ones
        gap_a, gap_b = x - i - n, y - j - n
        if 0 < gap_b <= REACH and 0 <= gap_a <= REACH:
            total += sum(_retyped(w, document[i + n : x]) for w in item[j + n : y])
    return total / max(1, len(item))


def least_seeds(words: int, share: float = SHARE) -> float:
    """The places of an item of so many words that must begin a seed of a document that covers the share.

    A tile of n words has n - SEED + 1 of them, so s of them are at most s tiles of SEED words with REACH
    retyped words between each two: they cover no more than s * (SEED + REACH) - REACH words.
    """
    return (share * words + REACH) / (SEED + REACH)


def held_items(document: list[str], items: list[tuple], share: float = SHARE) -> list[tuple]:
    """(item, coverage) of the items (item, words, codes) that a document holds; equal texts share their result."""
    own = codes(document)
    out, texts = [], {}
    for name, words, item_codes in items:
        same = tuple(words)
        if same not in texts:
            texts[same] = _held(own, item_codes, document, words)
        if texts[same] >= share:
            out.append((name, round(texts[same], 4)))
    return out


def _retyped(word: str, others: list[str]) -> bool:
    """Whether a word stands among others but for an exchanged, lost or added letter."""
    for other in others:
        if word == other:
            return True
        if abs(len(word) - len(other)) <= 1 and len(word) > 2:
            size = min(len(word), len(other))
            head = next((k for k in range(size) if word[k] != other[k]), size)
            tail = next((k for k in range(size) if word[-1 - k] != other[-1 - k]), size)
            if head + tail >= max(len(word), len(other)) - 2:
                return True
    return False


def _texts(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    return texts.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null"), dict(texts.dtypes)[key]


def _item_seeds(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, seed, places, words) of each item, a row per distinct seed; places: how often it stands there; words: of the item."""
    rows, kind = _texts(items, key, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for k, t in zip(frame["k"], frame["t"], strict=True):
                words = split_words(t)
                seeds, places = np.unique(rolling(codes(words)).astype(np.int64), return_counts=True)
                out += [(k, s, p, len(words)) for s, p in zip(seeds.tolist(), places.tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["item", "seed", "places", "words"])

    return rows.mapInPandas(run, f"item {kind}, seed bigint, places int, words int")


def _document_seeds(documents: DataFrame, key: str, text: str, wanted: np.ndarray | None) -> DataFrame:
    """(k, seed) of each document, distinct; only the wanted seeds where they are given."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted)  # None or at most SEED_BOUND numbers
    rows, kind = _texts(documents, key, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want = shared.value
        for frame in batches:
            keys, seeds = [], []
            for k, t in zip(frame["k"], frame["t"], strict=True):
                own = rolling(codes(split_words(t))).astype(np.int64)
                if want is not None and len(want):
                    own = own[want[np.minimum(np.searchsorted(want, own), len(want) - 1)] == own]
                if len(own := np.unique(own)):
                    keys.append(np.repeat(np.array([k]), len(own)))
                    seeds.append(own)
            yield pd.DataFrame({"k": np.concatenate(keys) if keys else [], "seed": np.concatenate(seeds) if seeds else []})

    return rows.mapInPandas(run, f"k {kind}, seed bigint")


def leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """(doc, item, coverage) of each document that holds at least share of an item's words.

    Null, empty and wordless texts of either side hold and leak nothing; copies of a document are judged one
    by one; items of one or two words are shorter than a seed and are no items (any text holds such words). Only
    rows that carry a seed of an item leave the probing pass, counts are aggregated before the shuffle, and a
    document travels only with its candidates: those that share least_seeds of the item, which no document of
    the asked coverage falls short of. Seeds up to SEED_BOUND are broadcast, more are joined; the rows are the same.
    """
    item_seeds = _item_seeds(items, item, text)
    distinct = item_seeds.select("seed").distinct()
    count = distinct.count()
    wanted = np.sort(distinct.toArrow()["seed"].to_numpy()) if count <= SEED_BOUND else None
    least = (F.lit(share) * F.col("words") + REACH) / (SEED + REACH)
    shared = _document_seeds(documents, doc, text, wanted).join(item_seeds, "seed").groupBy("k", "item", "words").agg(F.sum("places").alias("common"))
    pairs = shared.where(F.col("common") >= least).select("k", "item")
    right = items.select(F.col(item).alias("item"), F.col(text).alias("passage"))
    asked = pairs.join(right, "item").groupBy("k").agg(F.collect_list(F.struct("item", "passage")).alias("items"))
    joined = documents.select(F.col(doc).alias("k"), F.col(text).alias("document")).join(asked, "k")
    kinds = dict(documents.dtypes)[doc], dict(items.dtypes)[item]

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=4096)
        def of(t: str) -> tuple[list[str], np.ndarray]:
            words = split_words(t)
            return words, codes(words)

        for frame in batches:
            out = []
            for k, d, asked_items in zip(frame["k"], frame["document"], frame["items"], strict=True):
                candidates = sorted(((x["item"], *of(x["passage"])) for x in asked_items), key=lambda x: str(x[0]))
                out += [(k, i, value) for i, value in held_items(split_words(d), candidates, share)]
            yield pd.DataFrame(out, columns=["k", "item", "coverage"])

    return joined.mapInPandas(tiled, f"k {kinds[0]}, item {kinds[1]}, coverage double").select(F.col("k").alias(doc), F.col("item").alias(item), "coverage")
