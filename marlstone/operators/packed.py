"""Several values packed in one field: infer each source's delimiters, split, one row per value.

A cell is read in two passes. The first finds the delimiters that explain each cell best and scores them
per source and field: how regular the pieces are that they leave (each of them an address, number or link
of the field's type) and how consistent their number is with the number of values that the cell holds; a
mark that stands inside regular values is no evidence. Candidates are the known delimiters and any other
mark that is not part of the field's values. The second pass splits a cell by those delimiters of its
source that score well enough, and by no others, and keeps quoted pieces whole. A plain text field has no
regular form: it is cut by the one delimiter, if any, that stands in most of its source's cells.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint

# Marks that say "nothing here".
NOTHING = frozenset(
    "无 暂无 没有 未知 不详 空 - -- --- — —— – / \\ . * ? n/a na n.a. none null nil nan unknown #n/a".split()
)
# Delimiters; FIRM ones split a cell even if a piece is odd, LOOSE ones only between regular pieces.
FIRM = {
    "newline": r"\s*[\r\n]+\s*",
    "tab": r"\s*\t\s*",
    "break": r"\s*<br\s*/?>\s*",
    "semicolon": r"\s*;\s*",
    "wide semicolon": r"\s*；\s*",
    "wide comma": r"\s*，\s*",
    "ideographic comma": r"\s*、\s*",
    "bar": r"\s*\|+\s*",
    "wide bar": r"\s*｜\s*",
}
LOOSE = {
    "comma": r"\s*,\s*",
    "double slash": r"\s*//\s*",
    "spaced slash": r"\s+/\s+",
    "slash": r"\s*/\s*",
    "wide slash": r"\s*／\s*",
    "ampersand": r"\s*[&＆]\s*",
    "spaced plus": r"\s+\+\s+",
    "plus": r"(?<=[A-Za-z\d)）])(?<!\bor)(?<!\band)\s*\+\s*",  # behind a value, not at the head of an international number
    "or": r"\s+or\s+|\s*或者?\s*",
    "and": r"\s+and\s+|\s*(?:和|及|与)\s*",
    "list mark": r"(?:^|\s+)(?:[(（]\d{1,2}[)）]|\d{1,2}[.)）])\s+",
    "dot": r"\s*[·•]\s*",
    "blank": r"\s+",
}
DELIMITERS = {k: re.compile(v, re.IGNORECASE) for k, v in {**FIRM, **LOOSE}.items()}
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」", "『": "』", "＂": "＂", "`": "`", "«": "»"}
BRACKETS = {"[": "]", "{": "}", "(": ")", "（": "）", "【": "】", "<": ">", "〔": "〕"}
BLANKS = " \t\r\n 　﻿​"
_MARK = re.compile(r"^(?:[-–—•·*●▪]\s+|[•●▪]\s*|[(（]\d{1,2}[)）]\s*(?=\S)|\d{1,2}[.)）、]\s+|[①-⑳]\s*)")
_PHONE = re.compile(r"[+(（]?\d[\d\s()（）.\-+]*\d(?:\s*(?:转|分机|ext\.?|x)\s*\d{1,5})?", re.IGNORECASE)
_EXTENSION = re.compile(r"(?:转|分机|ext\.?|x)\s*\d{1,5}$", re.IGNORECASE)
_EMAIL = re.compile(r"(?:[^<>@]*<\s*)?[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)+\s*>?")
_LINK = re.compile(r"(?:https?://)?(?:[\w\-]+\.)+[a-z]{2,}(?::\d+)?(?:[/?#][^\s|｜;；，、\"]*)?", re.IGNORECASE)
KINDS = {"phones": "phone", "emails": "email", "websites": "link"}
LEAST_SCORE = 0.4  # of a delimiter by which a source's cells are cut
PRIOR_CELLS = 5  # by which a source's score is drawn towards that of all sources
SHORT_PIECE = 4  # words of a piece of plain text that looks like one of several values
# marks that belong to the values of a kind, and are no candidates there
_OWN = {"phone": "+-.()（）*", "email": "@._+-<>()", "link": ":/.?#=&%_-~+,@!$*'()", "text": "-.'’()（）&@#%_"}
_NUMBER = {"phone": re.compile(r"\d{6,}|\d[\d\- ]{6,}\d"), "email": re.compile("@"), "link": re.compile(r"(?:https?://)?(?:[\w\-]+\.)+[a-z]{2,}(?:[:/?#][^\s|｜;；，、\"<>]*)?", re.I)}


def regular(piece: str, kind: str) -> bool:
    """Whether piece is one value of the kind: phone, email, link, or any text for another kind."""
    if kind == "phone":
        return bool(_PHONE.fullmatch(piece)) and piece.rfind("+") < 1 and 5 <= sum(c.isdigit() for c in _EXTENSION.sub("", piece)) <= 15
    if kind == "email":
        return bool(_EMAIL.fullmatch(piece))
    if kind == "link":
        return bool(_LINK.fullmatch(piece)) and piece.find("://", 8) < 0 and not re.search(r",(?:https?:|www\.)", piece, re.I)
    return bool(piece)


def is_nothing(text: str) -> bool:
    return not text or text.lower() in NOTHING


def _bare(piece: str) -> str:
    """piece without outer blanks, list mark, enclosing or stray quotes and enclosing brackets."""
    while True:
        before = piece
        piece = _MARK.sub("", piece.strip(BLANKS), count=1).strip(BLANKS)
        if len(piece) > 1 and QUOTES.get(piece[0]) == piece[-1]:
            piece = piece[1:-1]
        elif len(piece) > 1 and BRACKETS.get(piece[0]) == piece[-1] and _encloses(piece):
            piece = piece[1:-1]
        elif piece and piece[0] in QUOTES and QUOTES[piece[0]] not in piece[1:]:
            piece = piece[1:]
        elif piece and piece[-1] in "\"'”’" and piece.count(piece[-1]) == 1 and piece[0] not in QUOTES:
            piece = piece[:-1]
        if piece == before:
            return piece


def _encloses(piece: str) -> bool:
    """Whether the bracket that opens piece closes only at its end."""
    opened, closed, depth = piece[0], BRACKETS[piece[0]], 0
    for at, char in enumerate(piece):
        depth += (char == opened) - (char == closed)
        if not depth:
            return at == len(piece) - 1
    return False


def _quoted(text: str, start: int) -> tuple[str, int] | None:
    """The quoted piece that opens at start, with doubled and escaped quotes undone, and where it ends."""
    close = QUOTES[text[start]]
    at, inner = start + 1, []
    while at < len(text):
        char = text[at]
        if char == "\\" and close == '"' and at + 1 < len(text) and text[at + 1] in '"\\/':
            inner.append(text[at + 1])
            at += 2
        elif char == close:
            if text[at + 1 : at + 2] == close and close in "\"'":
                inner.append(close)
                at += 2
                continue
            rest = text[at + 1 :].lstrip(BLANKS)
            if not rest or rest[0] in ",;；，、|｜/／&+·]})】" or rest[0] in QUOTES or text[at + 1] in BLANKS or rest.startswith("<br"):
                return "".join(inner), at + 1
            inner.append(char)
            at += 1
        else:
            inner.append(char)
            at += 1
    return None


def segments(text: str) -> list[tuple[str, bool]]:
    """(piece, quoted): text cut at its quoted pieces."""
    text = text.strip(BLANKS)
    if len(text) > 1 and text[0] in "[{【" and BRACKETS[text[0]] == text[-1] and _encloses(text):
        text = text[1:-1]
    out: list[tuple[str, bool]] = []
    at = begin = 0
    fresh = True
    while at < len(text):
        char = text[at]
        if fresh and char in QUOTES and (found := _quoted(text, at)):
            out += [(text[begin:at], False), (found[0], True)]
            at = begin = found[1]
        else:
            fresh = char in BLANKS or char in ",;；，、|｜/／&+:>" or (fresh and char in "-.)0123456789(*•")
            at += 1
    return [*out, (text[begin:], False)]


def _pattern(name: str) -> re.Pattern:
    """The pattern of a known delimiter, or of another mark, which is named by itself."""
    return DELIMITERS.get(name) or _other(name)


@lru_cache(maxsize=10_000)
def _other(mark: str) -> re.Pattern:
    return re.compile(rf"\s*(?:{re.escape(mark)})+\s*")


def candidates(text: str, kind: str) -> list[str]:
    """The delimiters that a text may be cut by: known ones in their order, then other marks that no value of the kind holds."""
    known = [n for n, p in DELIMITERS.items() if p.search(text)]
    other = dict.fromkeys(c for c in text if not c.isalnum() and not c.isspace() and c not in _OWN[kind] and c not in _KNOWN_MARKS and unicodedata.category(c)[0] in "PS")
    return [*known, *other]


_KNOWN_MARKS = frozenset(",;；，、|｜/／&＆+·•\\") | set(QUOTES) | set(QUOTES.values()) | set(BRACKETS) | set(BRACKETS.values())


def _split(piece: str, kind: str, names: list[str]) -> list[str]:
    """Values of an unquoted piece, by the delimiters in their order; each cut must leave regular values only, or be firm."""
    piece = _bare(_edges(piece))
    if is_nothing(piece):
        return []
    if kind == "text":
        return [v for p in _pattern(names[0]).split(piece) for v in _split(p, kind, names[1:])] if names else [piece]
    if regular(piece, kind):
        return [piece]
    odd: list[str] | None = None
    for name in names:
        pattern = _pattern(name)
        if not pattern.search(piece):
            continue
        parts = pattern.split(piece)
        if sum(bool(p.strip(BLANKS)) for p in parts) < 2:
            continue  # a mark at the end cuts nothing
        rest = [n for n in names if n != name]
        values = [v for p in parts for v in _split(p, kind, rest)]
        if values and all(regular(v, kind) for v in values):
            return values
        if odd is None and name in FIRM and values:
            odd = values
    return odd if odd is not None else [piece]


def unpack(cell: str | None, kind: str, names: list[str]) -> list[str]:
    """The values of a cell in their order; none for null, blank and "nothing here"."""
    if cell is None or is_nothing(cell.strip(BLANKS)) or is_nothing(_bare(cell)):
        return []
    out: list[str] = []
    for piece, quoted in segments(cell):
        if not quoted:
            out += _split(_edges(piece), kind, names)
        elif not is_nothing(value := piece.strip(BLANKS)):
            out.append(value)
    return out


_EDGE = re.compile(r"^(?:\s|[,;；，、|｜/／&·]|\+\s|<br\s*/?>|\bor\b|\band\b|或|和)+|(?:\s|[,;；，、|｜&·]|<br\s*/?>|\bor\b|\band\b|或|和|\s/|\s\+|／)+$", re.IGNORECASE)


def _edges(piece: str) -> str:
    """piece without the delimiters at its ends (a link may end in a slash)."""
    while (cut := _EDGE.sub("", piece)) != piece:
        piece = cut
    return piece


def _explained(piece: str, kind: str, names: list[str]) -> list[tuple[str, float, float]]:
    """(delimiter, regularity, consistency) of the cuts that explain a piece best; of all its delimiters, without worth, where none does."""
    piece = _bare(piece)
    if is_nothing(piece) or regular(piece, kind):
        return []
    present = [n for n in names if _pattern(n).search(piece)]
    expected = max(1, len(_NUMBER[kind].findall(piece)))
    best = None
    for name in present:
        parts = _pattern(name).split(piece)
        if sum(not is_nothing(_bare(p)) for p in parts) < 2:
            continue  # a mark at the end cuts nothing
        rest = [n for n in present if n != name]
        values = [v for p in parts for v in _split(p, kind, rest)]
        if not values:
            continue
        good = sum(regular(v, kind) for v in values) / len(values)
        even = min(len(values), expected) / max(len(values), expected)
        if best is None or good * even > best[1] * best[2]:
            best = (name, good, even, parts, rest)
            if good * even == 1:
                break
    if best is None or not best[1]:
        return [(n, 0.0, 0.0) for n in present]
    return [best[:3], *(x for p in best[3] for x in _explained(p, kind, best[4]))]


def score_cell(cell: str | None, kind: str) -> list[tuple[str, float | None, float | None]]:
    """(delimiter, regularity of its pieces, consistency of their number) for each delimiter outside quotes; null for one
    that is there but is left inside the values of a better one."""
    if cell is None or is_nothing(cell.strip(BLANKS)):
        return []
    pieces = [_edges(p) for p, q in segments(cell) if not q and p.strip(BLANKS)]
    if kind != "text":
        pieces = [p for p in pieces if not regular(_bare(p), kind)]
    of = [candidates(p, kind) for p in pieces]
    present = dict.fromkeys(n for names in of for n in names)
    out: list[tuple[str, float | None, float | None]] = []
    if kind == "text":
        for name in present:
            parts = [v for p in pieces for v in map(_bare, _pattern(name).split(p)) if not is_nothing(v)]
            if len(parts) > 1 and name != "blank":
                out.append((name, sum(len(v.split()) <= SHORT_PIECE for v in parts) / len(parts), 1.0))
        return out
    found: dict[str, list[tuple[float, float]]] = {}
    for piece, names in zip(pieces, of, strict=True):
        for name, good, even in _explained(piece, kind, names):
            found.setdefault(name, []).append((good, even))
    for name in present:
        cuts = found.get(name)
        out.append((name, sum(g for g, _ in cuts) / len(cuts), sum(e for _, e in cuts) / len(cuts)) if cuts else (name, None, None))
    return out


ALL_CELLS = "*"  # the count of a plain text field's cells, among its delimiters


def delimiter_scores(cells: DataFrame, source: str, field: str, cell: str) -> DataFrame:
    """(source, field, delimiter, cells, score, share) of each delimiter that stands in a source's cells.

    score: mean of regularity x consistency over the cells that it explains or could not, drawn towards the
    mean over all sources; cells is their number, share their part of the cells that it stands in. Of a plain
    text field the mean is over all cells of the source, so that a delimiter scores by the share of cells that
    it stands in. cells: a row per cell. One aggregation with partial sums; the result has a row per source,
    field and delimiter.
    """

    @F.pandas_udf("array<struct<delimiter:string,regularity:double,consistency:double>>")
    def scored(texts: pd.Series, fields: pd.Series) -> pd.Series:
        counted = [(ALL_CELLS, 1.0, 1.0)]
        return pd.Series([score_cell(t, KINDS[f]) if f in KINDS else score_cell(t, "text") + counted for t, f in zip(texts, fields, strict=True)])

    # a row per source, field and delimiter, kept so that the cells are scored once for both its readers
    each = checkpoint(
        cells.where(F.col(cell).isNotNull())
        .select(source, field, F.explode(scored(F.col(cell), F.col(field))).alias("s"))
        .groupBy(source, field, F.col("s.delimiter").alias("delimiter"))
        .agg(F.count("s.regularity").alias("cells"), F.count("*").alias("seen"), F.coalesce(F.sum(F.col("s.regularity") * F.col("s.consistency")), F.lit(0.0)).alias("total"))
    )
    whole = F.max(F.when(F.col("delimiter") == ALL_CELLS, F.col("cells"))).over(W.partitionBy(source, field))
    rows = each.withColumn("of", F.coalesce(whole, F.col("cells"))).where(F.col("delimiter") != ALL_CELLS)
    # a plain text's sources have nothing in common; the rows of the others are at most |fields| x |delimiters|, so the broadcast is bounded
    prior = rows.where(F.col(field).isin(*KINDS)).groupBy(field, "delimiter").agg(F.coalesce(F.sum("total") / F.nullif(F.sum("cells"), F.lit(0)), F.lit(0.0)).alias("prior"))
    drawn = F.when(F.col("prior").isNull(), F.col("total") / F.col("of")).otherwise((F.col("total") + PRIOR_CELLS * F.col("prior")) / (F.col("cells") + PRIOR_CELLS))
    return rows.join(F.broadcast(prior), [field, "delimiter"], "left").select(source, field, "delimiter", "cells", drawn.alias("score"), (F.col("cells") / F.col("seen")).alias("share"))


def explode_packed(df: DataFrame, key: Column, source: Column, fields: Iterable[str]) -> DataFrame:
    """(row key, field, pos, value): every value of every cell of the fields, pos from 1.

    Nulls, blanks and marks of absence give no row; repeated values and repeated rows are kept; a null
    source counts as one source of its own. Other columns of df are not read. The scores are joined on
    (source, field), a row per pair, so a source that holds most rows is split by the skew join.
    """
    names = list(fields)
    cells = df.select(key.alias("row_key"), F.coalesce(source, F.lit("")).alias("src"), *[F.col(f) for f in names])
    long = cells.select(
        "row_key", "src", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("cell")) for f in names])).alias("x")
    ).select("row_key", "src", "x.field", "x.cell")
    best = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score") * F.col("share")).alias("o"), "delimiter"))), lambda x: x["delimiter"])
    ranked = delimiter_scores(long, "src", "field", "cell").where((F.col("score") >= LEAST_SCORE) & (F.col("cells") > 0)).groupBy("src", "field").agg(best.alias("delimiters"))

    @F.pandas_udf("array<string>")
    def unpacked(texts: pd.Series, kinds: pd.Series, orders: pd.Series) -> pd.Series:
        return pd.Series([unpack(t, KINDS.get(k, "text"), in_order(o, KINDS.get(k, "text"))) for t, k, o in zip(texts, kinds, orders, strict=True)])

    return (
        long.where(F.col("cell").isNotNull() & (F.trim("cell") != ""))
        .join(ranked, ["src", "field"], "left")
        .select("row_key", "field", F.posexplode(unpacked("cell", "field", "delimiters")).alias("p", "value"))
        .select("row_key", "field", (F.col("p") + 1).alias("pos"), "value")
    )


def in_order(delimiters: Iterable[str] | None, kind: str) -> list[str]:
    """The delimiters by which a cell is cut, from those of its source, the best first: firm ones go before the others, a plain text is cut by the best alone."""
    names = [str(x) for x in delimiters] if delimiters is not None else []
    return names[:1] if kind == "text" else [d for d in names if d in FIRM] + [d for d in names if d not in FIRM]
