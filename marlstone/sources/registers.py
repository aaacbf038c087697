"""Registers as XML or delimited files, read into typed and exploded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | StructType) -> DataFrame:
    """The elements row_tag of XML files as nested rows; files are split by element, name spaces are left out."""
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").option("mode", "PERMISSIVE").schema(schema).load(path)


def has_field(df: DataFrame, path: str) -> bool:
    kind = df.schema
    for part in path.split("."):
        while isinstance(kind, ArrayType):
            kind = kind.elementType
        if not isinstance(kind, StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return True


def first_of(df: DataFrame, *paths: str) -> Column:
    """The first non-empty value of several places that a layout may keep a field in; places the schema lacks are passed over."""
    quoted = lambda p: F.col(".".join(f"`{part}`" for part in p.split(".")))
    found = [F.when(F.trim(quoted(p).cast("string")) != "", F.trim(quoted(p).cast("string"))) for p in paths if has_field(df, p)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def children(df: DataFrame, keys: Sequence[str], path: str, fields: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """(keys, ordinal, fields) of a nested array, one row per element; no element gives no row."""
    rows = df.select(*keys, F.posexplode(F.col(path)).alias("__n", "__e"))
    return rows.select(*keys, (F.col("__n") + 1).alias(ordinal), *[F.col("__e")[f].alias(f.replace("-", "_")) for f in fields])


def read_delimited(spark: SparkSession, path: str, separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A delimited file with a header, all columns text; broken rows are kept with nulls."""
    return spark.read.csv(path, sep=separator, header=True, quote='"', escape='"', multiLine=False, encoding=encoding, mode="PERMISSIVE")


def flagged_classes(df: DataFrame, columns: Sequence[str]) -> Column:
    """The sorted numbers of the class columns (Class1 to Class45) that carry a mark."""
    hits = [F.when(F.upper(F.trim(F.col(c))).isin("Y", "YES", "TRUE", "1", "X"), F.lit(int("".join(filter(str.isdigit, c))))) for c in columns]
    return F.array_sort(F.array_compact(F.array(*hits)))


def row_hash(columns: Sequence[str]) -> Column:
    """sha256 of a row's columns as JSON with nulls kept."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def ordered_current(states: DataFrame, key: str, order: Sequence[str], operation: str) -> DataFrame:
    """The last state per key by an order, deleted ones left out; two objects of one place in the order raise when read.

    order must end in a column that is unique per delivered object; operation is UPDATE or DELETE.
    """
    place = F.struct(*order)
    best = states.groupBy(key).agg(F.max_by(F.struct(*[c for c in states.columns if c != key]), place).alias("s"), F.max(place).alias("top"))
    clash = states.join(best.select(key, "top"), key).where(place == F.col("top")).groupBy(key).agg(F.count("*").alias("n"))
    joined = best.join(clash, key)
    checked = F.when(F.col("n") > 1, F.raise_error(F.lit("two objects share a place in the order")).cast("string")).otherwise(F.col("s")[operation])
    out = joined.withColumn("__op", checked).where("__op <> 'DELETE'")
    return out.select(key, *[F.col("s")[c].alias(c) for c in states.columns if c != key])


def key_values(df: DataFrame, text: str, wanted: dict[str, Sequence[str]], line: str = r"\r?\n", mark: str = r"\s*[:：=]\s*") -> DataFrame:
    """df with a column per wanted name from lines of "key: value" text; a key's aliases count too, case and blanks aside, the first line wins."""
    plain = lambda c: F.lower(F.regexp_replace(c, r"[\s_\-]+", ""))
    pairs = F.filter(F.transform(F.split(F.col(text), line), lambda x: F.split(x, mark, 2)), lambda p: F.size(p) == 2)
    rows = df.withColumn("__kv", F.transform(pairs, lambda p: F.struct(plain(F.element_at(p, 1)).alias("k"), F.trim(F.element_at(p, 2)).alias("v"))))

    def first(names: Sequence[str]) -> Column:
        keys = sorted({"".join(a.lower().replace("_", "").replace("-", "").split()) for a in names})
        return F.get(F.transform(F.filter("__kv", lambda p: p["k"].isin(*keys) & (p["v"] != "")), lambda p: p["v"]), F.lit(0))

    return rows.select(*df.columns, *[first((name, *aliases)).alias(name) for name, aliases in wanted.items()])


def latest_assignments(records: DataFrame, parts: dict[str, DataFrame], serials: DataFrame | None = None, keys: Sequence[str] = ("reel", "frame"), order: Sequence[str] = ("source_rank", "package_id"), package: str = "package_id") -> DataFrame:
    """One row per recorded assignment: its latest record, and of that delivery only the parts as ordered arrays.

    records: keys, order and the record's columns; parts: name to rows with keys, package, ordinal; one of them is
    `property` with serial_number. With serials (serial_number) only the assignments that name one of them in
    their latest delivery come back, so a property that a later delivery took out does not count.
    """
    rest = [c for c in records.columns if c not in keys]
    latest = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, *[F.col("r")[c].alias(c) for c in rest])
    if serials is not None:
        named = parts["property"].join(serials.select("serial_number").distinct(), "serial_number", "left_semi")
        latest = latest.join(named.select(*keys, package).distinct(), [*keys, package], "left_semi")
    for name, rows in parts.items():
        fields = [c for c in rows.columns if c not in (*keys, package)]
        ordered = F.array_sort(F.collect_list(F.struct("ordinal", *[f for f in fields if f != "ordinal"]))).alias(name)
        latest = latest.join(rows.join(latest.select(*keys, package), [*keys, package], "left_semi").groupBy(*keys).agg(ordered), list(keys), "left")
    return latest
