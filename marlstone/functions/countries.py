"""Countries and regions from codes, names, numbers, hosts and addresses, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import match_text

# Names of countries, in letters and digits only.
ALIASES = {
    "CN": "cn china 中国 中国大陆",
    "US": "us usa unitedstates unitedstatesofamerica 美国",
    "GB": "gb uk unitedkingdom 英国",
    "HK": "hk hongkong 香港",
    "SG": "sg singapore 新加坡",
    "JP": "jp japan 日本",
    "KR": "kr southkorea korea 韩国",
    "AU": "au australia 澳大利亚",
    "CA": "ca canada 加拿大",
    "DE": "de germany 德国",
    "FR": "fr france 法国",
}
# Regions of Chinese addresses by their full names, and the short forms that stand for them.
REGIONS = {
    "北京市": "CN-BJ", "天津市": "CN-TJ", "上海市": "CN-SH", "重庆市": "CN-CQ", "河北省": "CN-HE", "山西省": "CN-SX", "辽宁省": "CN-LN", "吉林省": "CN-JL", "黑龙江省": "CN-HL", "江苏省": "CN-JS",
    "浙江省": "CN-ZJ", "安徽省": "CN-AH", "福建省": "CN-FJ", "江西省": "CN-JX", "山东省": "CN-SD", "河南省": "CN-HA", "湖北省": "CN-HB", "湖南省": "CN-HN", "广东省": "CN-GD", "海南省": "CN-HI",
    "四川省": "CN-SC", "贵州省": "CN-GZ", "云南省": "CN-YN", "陕西省": "CN-SN", "甘肃省": "CN-GS", "青海省": "CN-QH", "台湾省": "CN-TW",
    "内蒙古自治区": "CN-NM", "广西壮族自治区": "CN-GX", "西藏自治区": "CN-XZ", "宁夏回族自治区": "CN-NX", "新疆维吾尔自治区": "CN-XJ", "香港特别行政区": "CN-HK", "澳门特别行政区": "CN-MO",
}
_ENDS = ("特别行政区", "维吾尔自治区", "壮族自治区", "回族自治区", "自治区", "省", "市")
MUNICIPALITIES = ("北京市", "天津市", "上海市", "重庆市")
SPECIAL = {"香港": "HK", "澳门": "MO", "台湾": "TW"}
FOREIGN = {"美国": "US", "英国": "GB", "日本": "JP", "韩国": "KR", "德国": "DE", "法国": "FR", "意大利": "IT", "瑞士": "CH", "荷兰": "NL", "新加坡": "SG", "加拿大": "CA", "澳大利亚": "AU", "俄罗斯": "RU", "印度": "IN"}
# Calling codes, the longest first, and top-level domains that are not the country's code.
CALLING = {"852": "HK", "853": "MO", "886": "TW", "86": "CN", "81": "JP", "82": "KR", "65": "SG", "61": "AU", "44": "GB", "49": "DE", "33": "FR", "1": "US"}
DOMAINS = {"uk": "GB"}
SHORT_REGIONS = {
    next(name.removesuffix(e) for e in _ENDS if name.endswith(e)): (name, code) for name, code in REGIONS.items() if name not in ("台湾省", "香港特别行政区", "澳门特别行政区")
}
CITY = "([一-鿿]{2,12}(?:自治州|地区|盟|市))"


def country_code(text: Column) -> Column:
    """The two-letter code of a country's name or code, '' if it names none."""
    key = match_text(text)
    table = F.create_map(*[F.lit(x) for code, names in ALIASES.items() for name in names.split() for x in (name, code)])
    upper = F.upper(F.trim(text))
    return F.coalesce(F.try_element_at(table, key), F.when(upper.rlike("^[A-Z]{2}$"), upper), F.lit(""))


def country_of_phone(number: Column) -> Column:
    """The country of an international number (+ or 00 before the calling code), '' if there is none or it is not listed."""
    code = F.regexp_extract(F.coalesce(number, F.lit("")), rf"^\s*(?:\+|00)\s*({'|'.join(CALLING)})", 1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in CALLING.items() for x in pair]), code), F.lit(""))


def country_of_host(host: Column) -> Column:
    """The country of a host's two-letter top-level domain, '' for others."""
    end = F.regexp_extract(F.lower(F.trim(F.coalesce(host, F.lit("")))), r"\.([a-z]{2})$", 1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in DOMAINS.items() for x in pair]), end), F.upper(end))


def infer_geo(address: Column, foreign: Column | None = None) -> Column:
    """struct(country, region, city, confidence) of an address in Chinese; the first of: a special region (.95), a foreign
    country (.9), a region by full name, then by short form (.85; municipalities .95), any other text (.6), only a
    foreign address (.2), nothing (0)."""
    text = F.trim(F.coalesce(address, F.lit("")))
    has = lambda term: F.contains(text, F.lit(term))
    found = lambda country, region, city, sure: F.struct(F.lit(country).alias("country"), region.alias("region"), city.alias("city"), sure.alias("confidence"))
    none = F.lit("")
    pairs = [(name, name, code) for name, code in REGIONS.items()] + [(short, name, code) for short, (name, code) in SHORT_REGIONS.items()]
    first = lambda value: F.coalesce(*[F.when(has(term), F.lit(value(name, code))) for term, name, code in pairs], none)
    name, code = first(lambda name, _: name), first(lambda _, code: code)
    match = F.regexp_extract(text, CITY, 1)
    city = F.when(name.isin(*MUNICIPALITIES), name).when(match.isin(*REGIONS), none).otherwise(match)
    sure = F.when(name.isin(*MUNICIPALITIES), 0.95).when(code != "", 0.85).otherwise(0.6)
    other = F.trim(F.coalesce(foreign, none)) if foreign is not None else none
    steps = [(has(t), found(c, none, F.lit(t), F.lit(0.95))) for t, c in SPECIAL.items()] + [(has(t), found(c, none, none, F.lit(0.9))) for t, c in FOREIGN.items()]
    steps += [(text != "", found("CN", code, city, sure)), (other != "", found("", none, none, F.lit(0.2)))]
    return reduce(lambda rest, step: F.when(step[0], step[1]).otherwise(rest), reversed(steps), found("", none, none, F.lit(0.0)))
