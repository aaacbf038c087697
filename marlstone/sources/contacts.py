"""Contact files of many formats as one table of cells: delimited text, JSON, HTML, workbooks, documents, plain text."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archives import decode, delimiter, members

_NS = re.compile(r"\{[^}]*\}")


class _Tables(HTMLParser):
    """Rows of the tables of a page; text outside tables as rows of one cell."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[str]] = []
        self.row: list[str] | None = None
        self.skip = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.row.append("")
        elif tag == "br" and self.row:
            self.row[-1] += " "

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "tr" and self.row is not None:
            self.rows.append(self.row)
            self.row = None

    def handle_data(self, data: str) -> None:
        if self.skip or not data.strip():
            return
        if self.row is None:
            self.rows.append([data.strip()])
        elif self.row:
            self.row[-1] += data


def _workbook(data: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter() if _NS.sub("", t.tag) == "t"))
        for name in sorted(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
            rows = []
            for row in ElementTree.fromstring(book.read(name)).iter():
                if _NS.sub("", row.tag) != "row":
                    continue
                cells: dict[int, str] = {}
                for cell in row:
                    letters = re.match("[A-Z]+", cell.get("r", "")) or ["A"]
                    place = 0
                    for c in letters[0]:
                        place = place * 26 + ord(c) - 64
                    text = "".join(t.text or "" for t in cell.iter() if _NS.sub("", t.tag) in ("v", "t"))
                    cells[place] = shared[int(text)] if cell.get("t") == "s" and text.isdigit() else text
                rows.append([cells.get(k, "") for k in range(1, max(cells, default=0) + 1)])
            yield name.rsplit("/", 1)[-1], rows


def _document(data: bytes) -> list[list[str]]:
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        body = ElementTree.fromstring(file.read("word/document.xml"))
    words = lambda node: "".join(t.text or "" for t in node.iter() if _NS.sub("", t.tag) == "t")
    rows = [[words(c) for c in row if _NS.sub("", c.tag) == "tc"] for row in body.iter() if _NS.sub("", row.tag) == "tr"]
    return rows or [[words(p)] for p in body.iter() if _NS.sub("", p.tag) == "p" and words(p).strip()]


def _records(items: list) -> list[list[str]]:
    items = [i if isinstance(i, dict) else {"value": i} for i in items]
    header = list(dict.fromkeys(k for i in items for k in i))
    return [header, *[["" if i.get(k) is None else i[k] if isinstance(i[k], str) else json.dumps(i[k], ensure_ascii=False) for k in header] for i in items]]


def read_cells(name: str, data: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """(table, rows) of a file by its name's ending; archives give those of their members. An unknown ending is plain text."""
    end = name.lower().rsplit(".", 1)[-1]
    if end == "zip":
        for member, content in members(data):
            for table, rows in read_cells(member, content):
                yield f"{member}#{table}", rows
        return
    if end == "xlsx":
        yield from _workbook(data)
        return
    if end == "docx":
        yield "document", _document(data)
        return
    text, _ = decode(data)
    text = text.lstrip("﻿")
    if end in ("csv", "tsv"):
        mark = "\t" if end == "tsv" else delimiter(text.split("\n", 1)[0])
        yield "table", [row for row in csv.reader(io.StringIO(text), delimiter=mark) if any(c.strip() for c in row)]
    elif end in ("jsonl", "ndjson"):
        yield "records", _records([json.loads(line) for line in text.splitlines() if line.strip()])
    elif end == "json":
        held = json.loads(text)
        lists = {"records": held} if isinstance(held, list) else {k: v for k, v in held.items() if isinstance(v, list)} or {"records": [held]}
        for table, items in lists.items():
            yield table, _records(items)
    elif end in ("html", "htm"):
        page = _Tables()
        page.feed(text)
        yield "page", [[re.sub(r"\s+", " ", c).strip() for c in row] for row in page.rows]
    else:
        pairs = [re.match(r"\s*([^:：\t]{1,40})[:：\t]\s*(.+)", line) for line in text.splitlines()]
        yield "text", [[m[1].strip(), m[2].strip()] if m else [line.strip()] for m, line in zip(pairs, text.splitlines(), strict=True) if line.strip()]


def read_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, table, row_no, cells) of all files of a folder; a broken file gives one row with its error and no cells."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path, data in zip(frame["path"], frame["content"], strict=True):
                out: list[tuple] = []
                try:
                    for table, rows in read_cells(path, bytes(data)):
                        out += [(path, table, n, row, None) for n, row in enumerate(rows, 1)]
                except Exception as error:  # noqa: BLE001 - any reader's error belongs to its file
                    out = [(path, None, 0, None, str(error)[:500])]
                yield pd.DataFrame(out, columns=["path", "table", "row_no", "cells", "error"])

    return files.mapInPandas(run, "path string, table string, row_no bigint, cells array<string>, error string")


def with_header(cells: DataFrame, aliases: dict[str, list[str]], look: int = 60) -> DataFrame:
    """(path, table, row_no, field, value): cells under the canonical fields of the header row.

    The header is, of a table's first `look` rows, the one with most known names; tables without any keep
    their cells under no field and are left out here.
    """
    plain = lambda c: F.lower(F.regexp_replace(c, r"[\s*:：_\-]+", ""))
    names = F.create_map(*[F.lit(x) for field, known in aliases.items() for a in (field, *known) for x in ("".join(a.lower().replace("_", "").split()), field)])
    fields = F.transform("cells", lambda c: F.try_element_at(names, plain(c)))
    scored = cells.where(F.col("row_no").between(1, look)).select("path", "table", "row_no", fields.alias("fields")).withColumn("known", F.size(F.array_compact("fields"))).where("known > 0")
    header = scored.groupBy("path", "table").agg(F.max_by(F.struct("row_no", "fields"), F.struct("known", -F.col("row_no"))).alias("h"))
    body = cells.join(header, ["path", "table"]).where(F.col("row_no") > F.col("h.row_no"))
    pairs = body.select("path", "table", "row_no", F.explode(F.arrays_zip(F.col("h.fields").alias("field"), F.col("cells").alias("value"))).alias("p"))
    return pairs.select("path", "table", "row_no", "p.field", F.trim("p.value").alias("value")).where("field is not null and value <> ''")
