"""Versioned rules as data: interpretation by priority, exclusive ladders, schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def interpret(subjects: DataFrame, rules: DataFrame, subject: str, status: str, events: str) -> DataFrame:
    """(subject, label, confidence, rule_id, candidates): the label of the matching rule of the highest priority.

    rules: rule_id, priority, status_codes, any_events, all_events, label, confidence; an empty array asks
    nothing. Rules of the top priority that disagree in label give UNKNOWN. Subjects without a match give NONE.
    A rule is found by one of its conditions: each status code it names, else each of its any-events, else the first
    of its all-events; so rules and subjects are joined on equal keys, and a rule without conditions has a key of all.
    """
    one = F.when(F.size("status_codes") > 0, F.transform("status_codes", lambda c: F.concat(F.lit("s"), c)))
    one = one.when(F.size("any_events") > 0, F.transform("any_events", lambda e: F.concat(F.lit("e"), e)))
    one = one.when(F.size("all_events") > 0, F.array(F.concat(F.lit("e"), F.get("all_events", F.lit(0))))).otherwise(F.array(F.lit("*")))
    keyed = rules.withColumn("__key", F.explode(F.array_distinct(one)))
    asked = subjects.select(F.col(subject), F.col(status).alias("__status"), F.coalesce(F.col(events), F.array().cast("array<string>")).alias("__events"))
    keys = F.array_compact(F.concat(F.array(F.lit("*"), F.concat(F.lit("s"), F.col("__status"))), F.transform(F.array_distinct("__events"), lambda e: F.concat(F.lit("e"), e))))
    coded = (F.size("status_codes") == 0) | F.coalesce(F.array_contains("status_codes", F.col("__status")), F.lit(False))
    fits = coded & ((F.size("any_events") == 0) | F.arrays_overlap("any_events", "__events")) & (F.size(F.array_except("all_events", "__events")) == 0)
    matched = asked.withColumn("__key", F.explode(keys)).join(keyed, "__key").where(fits).dropDuplicates([subject, "rule_id"])
    best = matched.groupBy(subject).agg(F.max("priority").alias("__top"), F.count("*").alias("candidates"))
    top = matched.join(best, subject).where(F.col("priority") == F.col("__top"))
    label = F.when(F.count_distinct("label") > 1, F.lit("UNKNOWN")).otherwise(F.max("label"))
    judged = top.groupBy(subject).agg(label.alias("label"), F.max("confidence").alias("confidence"), F.min("rule_id").alias("rule_id"), F.max("candidates").alias("candidates"))
    out = subjects.select(subject).join(judged, subject, "left")
    return out.select(subject, F.coalesce("label", F.lit("NONE")).alias("label"), F.when(F.col("label") != "UNKNOWN", F.col("confidence")).alias("confidence"), "rule_id", F.coalesce("candidates", F.lit(0)).alias("candidates"))


def ladder(steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first condition that holds."""
    out = None
    for condition, label in steps:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(otherwise)


def reasons(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in their order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def schedule(df: DataFrame, start: str, step_months: int, terms: int, as_of: Column) -> DataFrame:
    """df per term 1 to terms with opens, due (start + term x step months, end of month kept in), grace_until and state as of a day."""
    term = F.explode(F.sequence(F.lit(1), F.lit(terms))).alias("term")
    rows = df.select("*", term).withColumn("due", F.add_months(start, F.col("term") * step_months))
    rows = rows.withColumn("opens", F.add_months("due", -12)).withColumn("grace_until", F.add_months("due", 6))
    state = ladder([(as_of < F.col("opens"), "FUTURE"), (as_of <= F.col("due"), "OPEN_REGULAR"), (as_of <= F.col("grace_until"), "OPEN_GRACE")], "PAST_DEADLINE")
    return rows.withColumn("state", state)
