"""Encoding of a corpus with a byte-level BPE vocabulary by higher-order functions; no Python in the row path.

Words that are a vocabulary entry get their id where they stand. The other words of the corpus are
encoded once each: a word's bytes are pieces in an array, next to an array of the ranks that merging
each piece with its right neighbour has, and a fold merges the lowest rank until none is left. The
ranks are one literal: an array of buckets by hash, each a small map, so a lookup costs the same for
any vocabulary. A piece is written with one character (U+0000 to U+00FF) for each byte. The corpus is
read and cut into words once, and what is found in place is written to the shared folder.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# Fixed value: the public vocabulary's word pattern, with white space as Unicode has it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
BUCKETS = 8192
NO_RANK = 2**31 - 1
FIRST_LEAD = 0xE3  # first bytes of characters from U+3000 on, before which a word may be cut
LATIN = "ISO-8859-1"
CUT = "\u0100"


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """piece: id, from a file of base64 pieces and ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def _buckets(entries: dict[str, int | str]) -> str:
    """The entries as JSON: an array of BUCKETS maps; _find states the same bucket in Spark."""
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for text, value in entries.items():
        buckets[xxhash.xxh64_intdigest(text.encode(), seed=42) % BUCKETS][text] = value
    return json.dumps(buckets, separators=(",", ":"))


@lru_cache(maxsize=4)
def _ranks_json(path: str) -> str:
    return _buckets({piece.decode(LATIN): rank for piece, rank in read_ranks(path).items()})


@lru_cache(maxsize=4)
def _words_json(path: str) -> str:
    """The entries that are whole characters, by their text, with the id as text."""
    out = {}
    for piece, rank in read_ranks(path).items():
        try:
            out[piece.decode()] = str(rank)
        except UnicodeDecodeError:
            continue
    return _buckets(out)


def rank_table(path: str) -> Column:
    """The literal rank map: array of BUCKETS maps of piece to id; constant folding makes it one literal."""
    return F.from_json(F.lit(_ranks_json(path)), "array<map<string,int>>")


def _find(table: Column, text: Column) -> Column:
    """What the table holds for a text, null if nothing."""
    return F.try_element_at(F.element_at(table, F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int") + 1), text)


def words(text: Column) -> Column:
    """The words of a text by the vocabulary's pattern, in order, covering every character; empty for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


@lru_cache(maxsize=4)
def cut_pattern(path: str) -> str:
    """A pattern of the places of a word, one character for each byte, that no entry of the vocabulary spans.

    Such a place lies before the first byte of a character from U+3000 on. An entry that holds such a byte
    behind its first one spans it where the text goes on like the entry on either side, by the bytes of the
    entry's characters there. Nothing is ever merged over the other places, so a word cut there has the same
    ids, and a text without blanks costs no more than its characters.
    """
    joins = set()
    for piece in read_ranks(path):
        for at in range(1, len(piece)):
            if piece[at] >= FIRST_LEAD:
                begin = at - 1
                while begin and piece[begin] & 0xC0 == 0x80:
                    begin -= 1
                end = at + 1
                while end < len(piece) and piece[end] & 0xC0 == 0x80:
                    end += 1
                joins.add((piece[begin:at].decode(LATIN), piece[at:end].decode(LATIN)))
    lead = f"(?=[\\x{FIRST_LEAD:02x}-\\xff])"
    spelled = lambda text: "".join(f"\\x{ord(c):02x}" for c in text)
    either = "|".join(f"(?<={spelled(a)})(?={spelled(b)})" for a, b in sorted(joins))
    return f"(?<!^){lead}(?!{either})" if joins else f"(?<!^){lead}"


def _merged(table: Column, word: Column) -> Column:
    """The ids of a word of one byte or more, by the fold; word: one character for each byte.

    The state is an array of (r, p): a piece p and the rank r of merging it with its right neighbour.
    """
    ranked = lambda text: F.coalesce(_find(table, text), F.lit(NO_RANK))
    state_of = lambda rank, piece: F.struct(rank.alias("r"), piece.alias("p"))
    places = F.sequence(F.lit(1), F.length(word))
    start = F.transform(places, lambda at: state_of(F.when(at == F.length(word), F.lit(NO_RANK)).otherwise(ranked(F.substring(word, at, F.lit(2)))), F.substring(word, at, F.lit(1))))

    def step(state: Column, _: Column) -> Column:
        ranks = state["r"]
        least = F.array_min(ranks)

        def merge(at: Column) -> Column:
            whole = F.concat(F.element_at(state, at)["p"], F.element_at(state, at + 1)["p"])
            behind = F.try_element_at(state, at + 2)["p"]
            mid = lambda x: state_of(F.coalesce(_find(table, F.concat(x, behind)), F.lit(NO_RANK)), x)

            def joined(x: Column) -> Column:
                before = F.element_at(state, at - 1)["p"]
                return F.when(at == 1, F.concat(F.array(mid(x)), F.slice(state, F.lit(3), F.size(state)))).otherwise(
                    F.concat(F.slice(state, F.lit(1), at - 2), F.array(state_of(ranked(F.concat(before, x)), before), mid(x)), F.slice(state, at + 2, F.size(state)))
                )

            return F.element_at(F.transform(F.array(whole), joined), 1)

        # a one-element transform binds a value once
        return F.when(least == NO_RANK, state).otherwise(F.element_at(F.transform(F.array(F.array_position(ranks, least).cast("int")), merge), 1))

    steps = F.sequence(F.lit(2), F.greatest(F.length(word), F.lit(2)))
    return F.transform(F.aggregate(steps, start, step)["p"], lambda piece: _find(table, piece))


def _with_table(table: Column, make) -> Column:
    """make(table) with the literal bound once by a lambda, so that the plan holds one copy of it."""
    return F.element_at(F.transform(F.array(table), make), 1)


def encode(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, ids): the ids of each text without special tokens, as it stands; the empty list for empty and null texts.

    One row per row of df with a non-null key; keys should be unique (rows of one key would be put together).
    The words that are no vocabulary entry are made distinct over the corpus with partial aggregation, so a
    word in most texts is encoded once and its rows are spread by the skew join. Ids travel as text: those
    known in place with a bar for each open word, between which the open words' ids are set at the end. A
    word of Latin letters takes time in the square of its length, a run of Han or Kana in its length.
    """
    known = F.from_json(F.lit(_words_json(path)), "array<map<string,string>>")
    base = df.select(key, words(F.col(text)).alias("w"))
    looked = base.select(key, "w", _with_table(known, lambda table: F.transform("w", lambda word: _find(table, word))).alias("ids"))
    open_ = F.transform(F.filter(F.arrays_zip("w", "ids"), lambda x: x["ids"].isNull()), lambda x: x["w"])
    # written once, so that texts are read and cut once for all three readers
    parts = written(looked.select(key, F.array_join("ids", " ", "|").alias("runs"), open_.alias("open")))
    asked = parts.select(key, F.posexplode("open").alias("pos", "word"))
    bytes_ = F.decode(F.encode("word", "UTF-8"), LATIN)
    # split compiles its pattern for each row, regexp_replace once; no byte is the mark
    cut = asked.select("word").distinct().select("word", F.split(F.regexp_replace(bytes_, cut_pattern(path), CUT), CUT).alias("cut"))
    merged = _with_table(rank_table(path), lambda table: F.transform("cut", lambda word: F.array_join(_merged(table, word), " ")))
    coded = cut.select("word", F.array_join(merged, " ").alias("ids"))
    found = asked.join(coded, "word").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ids"))), lambda x: x["ids"]).alias("open"))
    rest = parts.select(key, F.split("runs", r"\|").alias("runs")).join(found, key, "left")
    line = F.array_join(F.zip_with("runs", F.coalesce("open", F.array().cast("array<string>")), lambda run, word: F.concat(run, F.coalesce(word, F.lit("")))), "")
    return rest.select(key, line.alias("line")).select(key, F.when(F.col("line") == "", F.array().cast("array<int>")).otherwise(F.split("line", " ").cast("array<int>")).alias("ids"))


def decode(ids: Column, path: str) -> Column:
    """The text of a list of ids: their pieces put together as bytes, read as UTF-8; empty for the empty list, null for null."""
    pieces = [piece.hex() for piece, _ in sorted(read_ranks(path).items(), key=lambda x: x[1])]
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    bound = F.element_at(F.transform(F.array(table), lambda t: F.array_join(F.transform(ids, lambda i: F.element_at(t, i + 1)), "")), 1)
    return F.decode(F.unhex(bound), "UTF-8")
