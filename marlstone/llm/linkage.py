"""Links between texts by shared keys, and the rows that linked texts stand in; no pairs inside a bucket are compared."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hanzi import Han

NOTHING = frozenset("- -- --- — —— – / . * ? n/a na n.a. none null nil nan unknown tbd 无 暂无 没有 未知 不详 空".split())


def is_nothing(text: str | None) -> bool:
    return text is None or not text.strip(" \t\r\n　 ") or text.strip(" \t\r\n　 ").lower() in NOTHING


def key64(text: str) -> int:
    """A signed 64-bit key of a text, the same in every process."""
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >= 1 << 63 else value


def deletions(word: str) -> set[str]:
    """word and what is left when one letter is lost: two words one edit or swap apart share a member."""
    return {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}


def star_edges(keyed: DataFrame) -> DataFrame:
    """(a, b): each id joined to the smallest id that has one of its keys; keyed: id, key.

    Minima are aggregated before the shuffle and keys of a single id fall out, so a key that very many
    ids share costs one edge for each of them.
    """
    least = keyed.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("z")).where("b <> z").select("key", "b")
    return keyed.join(least, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def probe_edges(probes: DataFrame, bases: DataFrame) -> DataFrame:
    """(a, b): each probe joined to the base of one of its keys, where all bases of the key agree on their kind.

    probes: id, key; bases: id, key, kind. A key whose bases differ in kind is ambiguous and joins nothing.
    """
    sure = bases.groupBy("key").agg(F.min("id").alias("b"), F.min("kind").alias("low"), F.max("kind").alias("high")).where("low = high").select("key", "b")
    return probes.join(sure, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def row_pairs(rows: DataFrame, entities: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(within, row_id_a, row_id_b), a < b, of rows whose texts differ and belong to one entity.

    rows: row_id, text_id; entities: text_id, entity. Pairs are made between the texts of an entity and then
    joined with the rows of each text, so rows that repeat one text cost nothing but the pairs they belong to.
    within: columns of both in which the rows of a pair agree, so that several tables take one plan.
    """
    several = entities.groupBy(*within, "entity").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi")).where("lo <> hi").select(*within, "entity")
    texts = entities.join(several, [*within, "entity"]).select(*within, "entity", "text_id")
    left, right = (texts.select(*within, "entity", F.col("text_id").alias(t)) for t in ("ta", "tb"))
    pairs = left.join(right, [*within, "entity"]).where("ta < tb").select(*within, "ta", "tb")
    left, right = (rows.select(*within, F.col("text_id").alias(t), F.col("row_id").alias(r)) for t, r in (("ta", "ra"), ("tb", "rb")))
    return pairs.join(left, [*within, "ta"]).join(right, [*within, "tb"]).select(*within, F.least("ra", "rb").alias("row_id_a"), F.greatest("ra", "rb").alias("row_id_b"))


def class_rows(rows: DataFrame, entities: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(within, row_id, entity, links) of the rows whose text has an entity; links: the entity's rows of other texts.

    rows: row_id, text_id; entities: text_id, entity; within: as in row_pairs. Counts are taken per text first,
    so an entity of very many rows is never one group of rows.
    """
    texts = rows.groupBy(*within, "text_id").agg(F.count("*").alias("own")).join(entities, [*within, "text_id"])
    whole = texts.groupBy(*within, "entity").agg(F.sum("own").alias("all"))
    counted = texts.join(whole, [*within, "entity"]).select(*within, "text_id", "entity", (F.col("all") - F.col("own")).alias("links"))
    return rows.join(counted, [*within, "text_id"]).select(*within, "row_id", "entity", "links")


def with_text_ids(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, text, text_id): rows with a text, the id being a 64-bit hash of the text as it stands."""
    return rows.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(text).alias("text")).where("text is not null and trim(text) <> ''").withColumn("text_id", F.xxhash64("text"))


def spark_key(text: str) -> int:
    """What xxhash64 gives in Spark for a text."""
    value = xxhash.xxh64_intdigest(text, seed=42)
    return value - (1 << 64) if value >= 1 << 63 else value


def with_known(texts: DataFrame, known: DataFrame, forms_of: Callable[[str], Iterable[str]]) -> DataFrame:
    """texts (text_id, text) with found: the rows of known (form, kind, value, of) whose form is one of the text's forms.

    Nothing is collected or bounded: the forms of the texts and of what is known meet in a join, which Spark
    broadcasts where its statistics show that one side is small. A text without a hit has an empty list.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            keys = [[spark_key(f) for f in set(forms_of(t))] for t in frame["text"]]
            yield pd.DataFrame({"text_id": frame["text_id"], "keys": keys})

    asked = texts.select("text_id", "text").mapInPandas(run, "text_id bigint, keys array<bigint>").select("text_id", F.explode("keys").alias("key"))
    hits = asked.join(known.select(F.xxhash64("form").alias("key"), "kind", "value", "of"), "key")
    grouped = hits.groupBy("text_id").agg(F.collect_set(F.struct("kind", "value", "of")).alias("found"))
    return texts.join(grouped, "text_id", "left").withColumn("found", F.coalesce("found", F.array().cast(grouped.schema["found"].dataType)))


def spoken(known: DataFrame, han: Han) -> DataFrame:
    """known (form, kind, value, of) with a row of kind `sound` for the syllables of each form in Han characters."""
    shared = known.sparkSession.sparkContext.broadcast(han)  # of one size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame.assign(form=frame["form"].map(shared.value.syllables), kind="sound")

    return known.unionAll(known.mapInPandas(run, known.schema))
