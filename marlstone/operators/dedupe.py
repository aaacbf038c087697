"""Duplicate entities and persons by exact corroboration: blocks, components, reasons against a merge, canonical member."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

LEAST_ADDRESS = 6  # characters of a normalised address that corroborates a name


def shared_key_edges(keyed: DataFrame, kind: str) -> DataFrame:
    """(a, b, evidence): each id joined to the smallest id of one of its keys; keyed: id, key. A key may have any number of ids."""
    least = keyed.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("key", "a")
    return keyed.join(least, "key").where("id <> a").select("a", F.col("id").alias("b"), F.lit(kind).alias("evidence")).distinct()


def entity_edges(entities: DataFrame, channels: DataFrame) -> DataFrame:
    """(a, b, evidence) of entities of one name that share an address or a channel.

    entities: id, name, address (normalised); channels: id, kind, value. Null or empty names, addresses shorter
    than LEAST_ADDRESS and empty channels corroborate nothing.
    """
    named = entities.where("name is not null and name <> ''")
    by_address = named.where(F.length("address") >= LEAST_ADDRESS).select("id", F.sha2(F.concat_ws("|", "name", "address"), 256).alias("key"))
    told = channels.where("value is not null and trim(value) <> ''").join(named.select("id", "name"), "id")
    by_channel = told.select("id", F.sha2(F.concat_ws("|", "name", "kind", "value"), 256).alias("key"))
    return shared_key_edges(by_address.distinct(), "EXACT_NAME_ADDRESS").unionAll(shared_key_edges(by_channel.distinct(), "EXACT_NAME_CHANNEL"))


def person_edges(persons: DataFrame, channels: DataFrame) -> DataFrame:
    """(a, b, evidence) of persons of one entity and name that share a channel; persons: id, entity, name; channels: id, kind, value."""
    told = channels.where("value is not null and trim(value) <> ''").join(persons.where("name is not null and name <> ''"), "id")
    return shared_key_edges(told.select("id", F.sha2(F.concat_ws("|", "entity", "name", "kind", "value"), 256).alias("key")).distinct(), "SAME_PERSON_CHANNEL")


def merge_decisions(members: DataFrame, edges: DataFrame, reasons: dict[str, Column], score: Sequence[str]) -> DataFrame:
    """(canonical, duplicate, status, reasons, evidence) of each component of two or more members.

    members: id and what reasons and score read. reasons: name to an aggregate that is true where the component
    must not be merged; with one the status is BLOCKED, else CANDIDATE. The canonical member is the greatest by
    score, then by id. evidence is what joins the component, sorted.
    """
    of = components(edges).withColumnRenamed("node", "id")
    joined = members.join(of, "id")
    held = [F.when(test, F.lit(name)) for name, test in reasons.items()]
    judged = joined.groupBy("component").agg(F.max_by("id", F.struct(*score, "id")).alias("canonical"), F.array_compact(F.array(*held) if held else F.array().cast("array<string>")).alias("reasons"))
    why = edges.join(of.select(F.col("id").alias("a"), "component"), "a").groupBy("component").agg(F.array_sort(F.collect_set("evidence")).alias("evidence"))
    rows = joined.select("component", F.col("id").alias("duplicate")).join(judged, "component").where("duplicate <> canonical").join(why, "component")
    return rows.select("canonical", "duplicate", F.when(F.size("reasons") > 0, "BLOCKED").otherwise("CANDIDATE").alias("status"), "reasons", "evidence")


def several(value: Column) -> Column:
    """An aggregate: whether the known values of a component differ."""
    known = F.when(value != "", value)
    return F.coalesce(F.min(known) != F.max(known), F.lit(False))
