"""Aggregations: strongest signals, scopes, directories, models, evidence, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def strongest_signal(df: DataFrame, keys: Sequence[str], precedence: Column, line: str, values: Sequence[str]) -> DataFrame:
    """keys, the values of the row of the greatest (precedence, line), and the precedence."""
    best = F.max_by(F.struct(precedence.alias("precedence"), *values), F.struct(precedence, line))
    return df.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.precedence", *[F.col("b")[v].alias(v) for v in values])


def latest_known(columns: Sequence[str], line: str) -> list[Column]:
    """Aggregates: for each column the value of the last line that has one (nulls do not hide earlier values); of one line the greatest."""
    return [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(line, c))).alias(c) for c in columns]


def bounded_examples(df: DataFrame, keys: Sequence[str], example: str, most: int) -> DataFrame:
    """(keys, examples): the smallest `most` distinct examples of each key, sorted.

    Examples beyond the first `most` are dropped in each partition already, so a hot key is never collected.
    """
    rows = df.select(*keys, example).where(F.col(example).isNotNull()).distinct()
    few = rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(example))).where(F.col("__n") <= most)
    return few.groupBy(*keys).agg(F.array_sort(F.collect_list(example)).alias("examples"))


def only_value(value: Column) -> Column:
    """Aggregate: the value that all non-null rows share, else null."""
    return F.when(F.min(value) == F.max(value), F.max(value))


def ordered_values(position: Column, value: Column) -> Column:
    """Aggregate: the values by their position."""
    return F.transform(F.array_sort(F.collect_list(F.struct(position.alias("p"), value.alias("v")))), lambda x: x["v"])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, copies) of keys with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def dominant_value(df: DataFrame, key: str, value: str, least: int, share: float) -> DataFrame:
    """(key, value, n, total, dominance) of keys with at least `least` rows of which one value has at least `share`.

    Two aggregations: pairs, then keys over pairs. Ties go to the smallest value.
    """
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    top = pairs.groupBy(key).agg(F.sum("n").alias("total"), F.max("n").alias("n"), F.min_by(F.col(value), F.struct(-F.col("n"), F.col(value))).alias(value))
    out = top.withColumn("dominance", F.col("n") / F.col("total"))
    return out.where((F.col("total") >= least) & (F.col("dominance") >= share)).select(key, value, "n", "total", "dominance")


def noisy_or(weight: Column) -> Column:
    """Aggregate: 1 - prod(1 - w) of weights below 1, to 4 decimals."""
    return F.round(1 - F.exp(F.sum(F.log(1 - weight))), 4)


def decide_evidence(evidence: DataFrame, subject: str, candidate: str, kind: str, weight: str, accept: float, margin: float, rival: float) -> DataFrame:
    """(subject, candidate, confidence, runner_up, decision): candidates by combined evidence.

    Repeated evidence of a kind counts once, by its greatest weight. ACCEPTED with enough confidence and lead,
    CONFLICT if the runner-up is strong and near, else INSUFFICIENT.
    """
    kinds = evidence.groupBy(subject, candidate, kind).agg(F.max(weight).alias("w"))
    scores = kinds.groupBy(subject, candidate).agg(noisy_or(F.col("w")).alias("score"))
    place = F.row_number().over(W.partitionBy(subject).orderBy(F.desc("score"), candidate))
    two = scores.withColumn("place", place).where("place <= 2").groupBy(subject).agg(
        F.max(F.when(F.col("place") == 1, F.col(candidate))).alias(candidate), F.max(F.when(F.col("place") == 1, F.col("score"))).alias("confidence"), F.coalesce(F.max(F.when(F.col("place") == 2, F.col("score"))), F.lit(0.0)).alias("runner_up")
    )
    lead = F.round(F.col("confidence") - F.col("runner_up"), 4)
    decision = F.when((F.col("confidence") >= accept) & (lead >= margin), "ACCEPTED").when((F.col("runner_up") >= rival) & (lead < margin), "CONFLICT").otherwise("INSUFFICIENT")
    return two.withColumn("decision", decision)


def integrity(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """The children whose key no parent has; null keys are such children too."""
    return children.join(parents.select(*on).distinct(), list(on), "left_anti")


def flag_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(flag, rows): how many rows each condition holds for; a row may count for several."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in flags.items()]))
    return df.select(F.explode(hits).alias("flag")).groupBy("flag").agg(F.count("*").alias("rows"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, filled, blank, missing, least, greatest) of text columns: rows with a value, blank ones, nulls, and the extreme values.

    One pass of partial aggregates over all rows.
    """
    text = lambda c: F.col(c).cast("string")
    known = lambda c: F.when(F.trim(text(c)) != "", text(c))
    facts = [F.struct(F.lit(c).alias("field"), F.count(known(c)).alias("filled"), F.count_if(F.trim(text(c)) == "").alias("blank"), F.count_if(F.col(c).isNull()).alias("missing"), F.min(known(c)).alias("least"), F.max(known(c)).alias("greatest")) for c in columns]
    return df.agg(F.array(*facts).alias("x")).select(F.explode("x").alias("x")).select("x.*")
