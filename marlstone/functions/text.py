"""Text normalisation as column expressions; only the Unicode forms need Python, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Texts that stand for "nothing" in register files and in contact files.
NULL_LIKE = ("null", "none", "nan", "n/a", "na", "-", "--")
CONTACT_NULL_LIKE = (*NULL_LIKE, "无", "暂无", "未知", "不详")


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t) if isinstance(t, str) else t)


# Full-width forms of the printable ASCII characters and the blank.
WIDE, NARROW = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000", "".join(map(chr, range(0x21, 0x7F))) + " "


def narrow(text: Column) -> Column:
    """Full-width characters as ASCII, the part of NFKC that needs no Python; nfkc does the rest."""
    return F.translate(text, WIDE, NARROW)


def clean_text(text: Column, null_like: tuple[str, ...] = NULL_LIKE, keep_lines: bool = False) -> Column:
    """In narrow characters, without control characters and repeated blanks; null and null-like texts become ''."""
    blanks = r"[ \t\f\x0B　 ]+" if keep_lines else r"[\s　 ]+"
    bare = F.trim(F.regexp_replace(F.regexp_replace(narrow(F.coalesce(text, F.lit(""))), r"[\x00-\x08\x0E-\x1F\x7F]", ""), blanks, " "))
    return F.when(F.lower(bare).isin(*null_like), F.lit("")).otherwise(bare)


def match_text(text: Column) -> Column:
    """For exact matching: in narrow characters and lower case, only Latin letters, digits and Han characters."""
    return F.regexp_replace(F.lower(narrow(F.coalesce(text, F.lit("")))), "[^a-z0-9\\u4e00-\\u9fff]+", "")


def name_key(text: Column) -> Column:
    """Lower case with single blanks."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def split_values(text: Column, pattern: str = r"[;,|/、，；\n]+") -> Column:
    """Distinct trimmed parts of a text, in order, empty ones left out."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), pattern), F.trim), lambda x: x != ""))


def strip_id_mask(text: Column) -> Column:
    """A name without the masked identity number that registers put behind it."""
    out = text
    for pattern in (r"[（(]?\d{0,6}[*＊]{2,}[\dXx]{0,4}[）)]?$", r"[（(](?:身份证|证件|ID)[^（）()]*[）)]$", r"\s*\d{6}[*＊xX]+\d*$"):
        out = F.trim(F.regexp_replace(out, pattern, ""))
    return out


def application_number(text: Column) -> Column:
    """struct(full, root, suffix, route, derived) of a register number: optional G, digits, optional letters."""
    full = F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", ""))
    part = lambda k: F.regexp_extract(full, r"^(G?)(\d+)([A-Z]*)$", k)
    return F.struct(
        full.alias("full"), part(2).alias("root"), part(3).alias("suffix"), F.when(part(1) == "G", "INTERNATIONAL").otherwise("NATIONAL").alias("route"), (part(3) != "").alias("derived")
    )


def email(text: Column) -> Column:
    """An address in lower case without mailto:, null if it has no address's form."""
    bare = F.lower(F.regexp_replace(F.trim(text), r"^mailto:|[<>\s]", ""))
    return F.when(bare.rlike(r"^[a-z0-9._%+\-]+@[a-z0-9\-]+(\.[a-z0-9\-]+)+$"), bare)


def phone(text: Column) -> Column:
    """Digits with an optional leading +, null with fewer than 6 or more than 15 digits."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^00", "+"), r"(?<!^)\+|[^0-9+]", "")
    return F.when(F.length(F.regexp_replace(bare, r"\+", "")).between(6, 15), bare)


def phone_class(text: Column) -> Column:
    """MOBILE, LANDLINE or UNKNOWN of a Chinese number."""
    bare = F.regexp_replace(phone(text), r"^\+?86", "")
    return F.when(bare.rlike(r"^1[3-9]\d{9}$"), "MOBILE").when(bare.rlike(r"^0\d{9,11}$"), "LANDLINE").otherwise("UNKNOWN")


def website_host(text: Column) -> Column:
    """The host in lower case without www., null if there is none."""
    host = F.regexp_extract(F.lower(F.trim(text)), r"^(?:[a-z]+://)?(?:[^/@\s]*@)?(?:www\.)?([a-z0-9\-]+(?:\.[a-z0-9\-]+)+)", 1)
    return F.when(host != "", host)


def has_replacement_character(text: Column) -> Column:
    return F.contains(text, F.lit("�"))


def class_number(text: Column) -> Column:
    """A class of 1 to 45, else null."""
    number = F.try_to_number(F.regexp_extract(F.coalesce(text.cast("string"), F.lit("")), r"^\s*0*(\d{1,2})\s*$", 1), F.lit("99")).cast("int")
    return F.when(number.between(1, 45), number)


def flag(text: Column) -> Column:
    """True, false, or null for texts that mean neither."""
    bare = F.lower(F.trim(text.cast("string")))
    return F.when(bare.isin("1", "t", "true", "y", "yes", "是"), True).when(bare.isin("0", "f", "false", "n", "no", "否"), False)


# What a company's name ends with in Chinese, and the words of legal forms in other names.
COMPANY_ENDS = ("有限公司", "有限责任公司", "股份有限公司", "集团", "公司", "工厂", "厂", "商行", "合作社", "研究院", "研究所", "事务所", "中心", "企业", "合伙企业")
COMPANY_WORDS = r"(?i)(?:^|[^a-z])(?:co\.?,? ?ltd|limited|ltd|inc|incorporated|corp|corporation|llc|plc|gmbh|ag|s\.?a\.?|b\.?v|pty|company)(?:[^a-z]|$)"


def company_signal(name: Column) -> Column:
    """Whether a name has the form of a company's: a Chinese ending or a word of a legal form; false for null and blank."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"[\s　，,。.;；]+$", "")
    compact = F.regexp_replace(bare, r"[\s　]", "")
    return compact.rlike(f"(?:{'|'.join(COMPANY_ENDS)})$") | bare.rlike(COMPANY_WORDS)
