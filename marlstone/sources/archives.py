"""Members of archives and their lines: nested ZIPs, file names and text in the wrong code page."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code pages that register files come in, in order of preference.
ENCODINGS = ("utf-8-sig", "utf-8", "gb18030", "utf-16", "big5", "cp1252", "latin-1")
DEPTH = 2
SAMPLE_BYTES = 262_144


def _quality(text: str, terms: tuple[str, ...]) -> float:
    """How much a decoded text looks like text: Han and Latin letters and known terms for it, odd characters against it."""
    if not text:
        return 0.0
    odd = text.count("�") * 20 + len(re.findall("[\x00-\x08\x0e-\x1f-]", text)) * 10 + len(re.findall("[À-ÿ]{3,}", text)) * 4
    han = len(re.findall("[一-鿿]", text))
    return (han * 2 + sum(map(str.isascii, text)) * 0.5 - odd) / len(text) + 5 * any(t in text for t in terms)


def decode(data: bytes, forced: str | None = None, terms: tuple[str, ...] = ()) -> tuple[str, str]:
    """(text, encoding): by the forced code page, or by the one whose text looks best; broken bytes are replaced."""
    if forced:
        return data.decode(forced, "replace"), forced
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return data.decode("utf-16", "replace"), "utf-16"
    best = max((e for e in ENCODINGS if e != "utf-16"), key=lambda e: (_quality(data[:SAMPLE_BYTES].decode(e, "replace"), terms), -ENCODINGS.index(e)))
    return data.decode(best, "replace"), best


def repaired_name(info: zipfile.ZipInfo, terms: tuple[str, ...] = ()) -> str:
    """A member's name; one that was read as cp437 is read again as what looks best."""
    if info.flag_bits & 0x800:
        return info.filename
    try:
        raw = info.filename.encode("cp437")
    except UnicodeEncodeError:
        return info.filename
    names = [info.filename]
    for encoding in ("gb18030", "utf-8"):
        try:
            names.append(raw.decode(encoding))
        except UnicodeDecodeError:
            continue
    return max(names, key=lambda n: (_quality(n, terms), -names.index(n)))


# Characters that show text decoded by the wrong code page, and words of the register's texts.
MARKERS = ("ä", "å", "æ", "ç", "è", "é", "ï¼", "Â", "Ã", "锛", "锝", "鍙", "鍚", "鍏", "鍟", "鐢", "鐮", "浠", "悊", "浜", "�")
EXPECTED = ("公司", "商标", "注册", "申请", "商品", "代理", "地址", "有限")
WRONG_PAGES = ("gb18030", "gbk", "latin-1", "cp1252")


def _readable(cell: str) -> int:
    """Han characters and expected words speak for a cell, marks of wrong decoding and lost characters against it."""
    marks = sum(map(cell.count, MARKERS))
    return 2 * len(re.findall("[一-鿿]", cell)) + 100 * sum(map(cell.count, EXPECTED)) - 80 * marks - 300 * cell.count("�")


def repaired_cell(cell: str | None) -> str | None:
    """A cell that was decoded by a wrong code page, read again as what looks best; others, null and '' as they are.

    A reading may not lose more characters than the cell had lost already.
    """
    if not cell or not any(m in cell for m in MARKERS):
        return cell
    read = [cell.encode(page, "replace").decode("utf-8", "replace") for page in WRONG_PAGES]
    best = max([cell, *(r for r in read if r.count("�") <= cell.count("�"))], key=_readable)
    return best if _readable(best) > _readable(cell) else cell


@F.pandas_udf(StringType())
def repaired_cells(cells: pd.Series) -> pd.Series:
    return cells.map(repaired_cell, na_action="ignore")


def members(data: bytes, terms: tuple[str, ...] = (), path: str = "", depth: int = DEPTH) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the files of an archive, those of archives inside it under both names, to a depth of two."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        for info in archive.infolist():
            if info.is_dir():
                continue
            name, content = path + repaired_name(info, terms), archive.read(info)
            if name.lower().endswith(".zip") and depth > 1:
                yield from members(content, terms, name + "!", depth - 1)
            else:
                yield name, content


def is_workbook(data: bytes) -> bool:
    """Whether a file that claims to be delimited text is a binary or XML workbook."""
    return data[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" or b"urn:schemas-microsoft-com:office:spreadsheet" in data[:4096]


def delimiter(line: str) -> str:
    """The delimiter of a header line: the commonest of tab, bar, semicolon and comma."""
    return max("\t|;,", key=lambda d: (line.count(d), -"\t|;,".index(d)))


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.zip", encoding: str | None = None, terms: tuple[str, ...] = ()) -> DataFrame:
    """(path, member, line_no, line, encoding) of all text members of all archives; an archive is read by one task, lines from 1."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path, data in zip(frame["path"], frame["content"], strict=True):
                for name, content in members(bytes(data), terms):
                    if is_workbook(content):
                        raise ValueError(f"{path}!{name} is a workbook, not delimited text")
                    text, used = decode(content, encoding, terms)
                    lines = text.splitlines()
                    for at in range(0, len(lines), 20_000):
                        part = lines[at : at + 20_000]
                        yield pd.DataFrame({"path": path, "member": name, "line_no": range(at + 1, at + len(part) + 1), "line": part, "encoding": used})

    return files.mapInPandas(run, "path string, member string, line_no bigint, line string, encoding string")
