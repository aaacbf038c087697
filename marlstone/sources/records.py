"""Logical records of delimited files whose quoting cannot be trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.history import islands


def logical_records(lines: DataFrame, starts: Column) -> DataFrame:
    """(path, member, record, text, first_line, last_line): physical lines put together at the lines that begin a record.

    The predicate, not the quotes, decides, so an unbalanced quote never swallows the next record. Lines
    before the first start (the header) are record 0.
    """
    numbered = islands(lines, ["path", "member"], "line_no", F.coalesce(starts, F.lit(False)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    return numbered.groupBy("path", "member", "record").agg(text.alias("text"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))


def repaired_columns(records: DataFrame, text: str, columns: Sequence[str], variable: str, delimiter: str = ",") -> DataFrame:
    """records with the columns and repair: EXACT, MERGED_VARIABLE, UNQUOTED or UNREPAIRABLE.

    A record of the right number of cells is exact. One with more has the surplus put back into the variable
    column; one whose quotes hide delimiters is split without regard to quotes. Fewer cells than columns cannot
    be repaired and keep nulls.
    """
    wanted = len(columns)
    place = list(columns).index(variable)
    quote = r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    escaped = {",": ",", "\t": "\t", "|": r"\|", ";": ";"}[delimiter]
    cells = F.split(F.col(text), escaped + quote)
    raw = F.split(F.col(text), escaped)
    use_raw = (F.size(cells) < wanted) & (F.size(raw) >= wanted)
    parts = F.when(use_raw, raw).otherwise(cells)
    rows = records.withColumn("__c", parts).withColumn("__raw", use_raw)
    extra = F.size("__c") - wanted
    merged = F.concat(F.slice("__c", 1, place), F.array(F.array_join(F.slice("__c", F.lit(place + 1), extra + 1), delimiter)), F.slice("__c", extra + place + 2, F.lit(wanted)))
    fixed = F.when(extra == 0, F.col("__c")).when(extra > 0, merged)
    repair = F.when(extra < 0, "UNREPAIRABLE").when(F.col("__raw"), "UNQUOTED").when(extra > 0, "MERGED_VARIABLE").otherwise("EXACT")
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), '^"|"$', ""), '""', '"'))
    return rows.withColumn("repair", repair).withColumn("__f", fixed).select(
        *records.columns, *[F.when(F.col("__f").isNotNull(), clean(F.get("__f", F.lit(k)))).alias(c) for k, c in enumerate(columns)], "repair"
    )


def canonical_header(header: Sequence[str], aliases: dict[str, Sequence[str]]) -> dict[str, int]:
    """canonical column: place of the header cells that an alias names, blanks and case aside; the first wins."""
    plain = lambda t: "".join(t.split()).strip("﻿").lower()
    of = {plain(a): c for c, names in aliases.items() for a in (c, *names)}
    out: dict[str, int] = {}
    for place, cell in enumerate(header):
        if (column := of.get(plain(cell))) and column not in out:
            out[column] = place
    return out


def file_profile(lines: DataFrame, records: DataFrame) -> DataFrame:
    """(path, member, physical_rows, logical_rows, continuation_rows, longest): how a file was put together."""
    physical = lines.groupBy("path", "member").agg(F.count("*").alias("physical_rows"))
    logical = records.where("record > 0").groupBy("path", "member").agg(F.count("*").alias("logical_rows"), F.sum(F.col("last_line") - F.col("first_line")).alias("continuation_rows"), F.max(F.length("text")).alias("longest"))
    return physical.join(logical, ["path", "member"], "left")
