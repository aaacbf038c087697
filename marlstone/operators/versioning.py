"""Current state and history over versioned rows: latest versions, guarded merges, tombstones, deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """The row of the greatest order per key, without keys whose greatest row is deleted.

    One aggregation with map-side partial maxima, so a key with very many versions needs no sorted group.
    Null orders count as smallest; of rows equal in order the greatest by all other columns is taken.
    """
    rest = [c for c in df.columns if c not in keys]
    whole = F.max_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order])) if rest else F.lit(None)
    mark = [deleted.alias("__deleted")] if deleted is not None else []
    rows = df.select("*", *mark)
    if deleted is not None:
        rest, whole = [*rest, "__deleted"], F.max_by(F.struct(*rest, "__deleted"), F.struct(*order, *[c for c in rest if c not in order]))
    out = rows.groupBy(*keys).agg(whole.alias("__row")).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
    if deleted is not None:
        out = out.where(~F.coalesce("__deleted", F.lit(False))).drop("__deleted")
    return out.select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys and the values of the row of the smallest order."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), _order(order)).alias("__row")).select(*keys, *[F.col("__row")[v].alias(v) for v in values])


def latest_children(parents: DataFrame, children: DataFrame, subject: Sequence[str], package: str, order: Sequence[str]) -> DataFrame:
    """The children of each subject's latest package only; parents: subject, package and order."""
    latest = parents.groupBy(*subject).agg(F.max_by(package, _order(order)).alias(package))
    return children.join(latest, [*subject, package], "left_semi") if set(subject) <= set(children.columns) else children.join(latest, package)


def rank_guarded_merge(current: DataFrame, incoming: DataFrame, keys: Sequence[str], rank: str, keep_first: Sequence[str] = ()) -> DataFrame:
    """current with incoming rows of the same or a higher rank; keep_first columns stay as the key's earliest row has them.

    Equal ranks let the incoming row in, so a package can be published again. A rewrite of the keys that
    incoming touches: the caller keeps current partitioned by a bucket of the key to bound it.
    """
    both = current.select("*", F.lit(0).alias("__side")).unionByName(incoming.select("*", F.lit(1).alias("__side")))
    merged = latest_by(both, keys, [rank, "__side"]).drop("__side")
    if not keep_first:
        return merged
    first = first_by(both, keys, [rank, "__side"], keep_first)
    return merged.drop(*keep_first).join(first, list(keys)).select(*current.columns)


def snapshot_tombstones(current: DataFrame, incoming: DataFrame, subject: Sequence[str], child: Sequence[str], rank: str) -> DataFrame:
    """Tombstones (is_deleted = 1, the incoming rank) of children that a touched subject's new snapshot omits."""
    touched = incoming.groupBy(*subject).agg(F.max(rank).alias("__rank"))
    gone = current.where("is_deleted = 0").join(touched, list(subject)).where(F.col(rank) < F.col("__rank"))
    gone = gone.join(incoming.select(*subject, *child).distinct(), [*subject, *child], "left_anti")
    return gone.withColumn(rank, F.col("__rank")).withColumn("is_deleted", F.lit(1)).select(*current.columns)


def stale_guard(current: DataFrame, incoming: DataFrame, subject: str, time: str) -> DataFrame:
    """incoming without the subjects whose time lies before the current one (history keeps them, the current table does not)."""
    known = current.groupBy(subject).agg(F.max(time).alias("__known"))
    return incoming.join(known, subject, "left").where(F.col("__known").isNull() | (F.col(time) >= F.col("__known"))).drop("__known")


def role_closure(current: DataFrame, incoming: DataFrame, scope: Sequence[str], member: Sequence[str]) -> DataFrame:
    """Current members of the scopes that incoming touches and that incoming does not name any more."""
    touched = incoming.select(*scope).distinct()
    return current.join(touched, list(scope), "left_semi").join(incoming.select(*scope, *member).distinct(), [*scope, *member], "left_anti")


def true_delta_events(current: DataFrame, incoming: DataFrame, keys: Sequence[str], rank: str, tracked: dict[str, str]) -> DataFrame:
    """(keys, event_type, old_value, new_value): one event per tracked column that a higher-ranked incoming row changes.

    tracked: column to event type. First appearances and equal ranks make no event.
    """
    old = current.select(*keys, F.col(rank).alias("__rank"), *[F.col(c).cast("string").alias(f"__{c}") for c in tracked])
    both = incoming.join(old, list(keys)).where(F.col("__rank") < F.col(rank))
    events = F.array(*[F.struct((~F.col(c).cast("string").eqNullSafe(F.col(f"__{c}"))).alias("hit"), F.lit(kind).alias("event_type"), F.col(f"__{c}").alias("old_value"), F.col(c).cast("string").alias("new_value")) for c, kind in tracked.items()])
    return both.select(*keys, F.explode(F.filter(events, lambda e: e["hit"])).alias("e")).select(*keys, "e.event_type", "e.old_value", "e.new_value")


def append_observations(held: DataFrame, incoming: DataFrame, position: Sequence[str], content_hash: str) -> DataFrame:
    """The incoming observations that are new; a position that comes back with another content raises when it is read."""
    known = held.select(*position, F.col(content_hash).alias("__known"))
    checked = incoming.join(known, list(position), "left")
    clash = F.col("__known").isNotNull() & (F.col("__known") != F.col(content_hash))
    guarded = checked.withColumn(content_hash, F.when(clash, F.raise_error(F.lit("an observation came back with another content")).cast("string")).otherwise(F.col(content_hash)))
    return guarded.where(F.col("__known").isNull() | (F.col(content_hash) != F.col("__known"))).drop("__known")


def publish_in_order(packages: Sequence[tuple[int, DataFrame]], keys: Sequence[str], rank: str) -> DataFrame:
    """The current state after packages of any arrival order: one latest_by over all, which equals the fold by rank."""
    union = None
    for _, rows in sorted(packages, key=lambda p: p[0]):
        union = rows if union is None else union.unionByName(rows)
    return latest_by(union, keys, [rank])


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows with the same repetition, by count and fingerprint; one pass over each."""
    summed = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    return summed(left) == summed(right)
