"""Packages as a stream: current state by guarded merges, true deltas as an append-only history, and a push feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.history import feed_page
from ..operators.versioning import latest_by, rank_guarded_merge, true_delta_events
from ..sources.store import append_history, current_snapshot, publish_snapshot


def publish_batch(batch: DataFrame, number: int, state: str, history: str, keys: Sequence[str], rank: str, tracked: dict[str, str]) -> None:
    """Merges one micro-batch: later ranks win whatever their order of arrival, and the changes they make go to the history.

    The snapshot's version is the batch's number, so a batch that is run again writes the same snapshot; its
    events carry the batch number, by which readers drop repetitions.
    """
    spark = batch.sparkSession
    incoming = latest_by(batch, keys, [rank])
    current = current_snapshot(spark, state)
    if current is None:
        publish_snapshot(incoming, state, number)
        return
    events = true_delta_events(current, incoming, keys, rank, tracked)
    identity = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], "event_type", F.coalesce("old_value", F.lit("")), F.coalesce("new_value", F.lit(""))), 256)
    append_history(events.withColumn("event_id", identity).withColumn("batch", F.lit(number)).withColumn("observed_at", F.current_timestamp()), history)
    publish_snapshot(rank_guarded_merge(current, incoming, keys, rank), state, number)


def publish_stream(rows: DataFrame, state: str, history: str, checkpoint: str, keys: Sequence[str], rank: str, tracked: dict[str, str]) -> StreamingQuery:
    """Publishes a stream of versioned rows until what is there has been read, then ends; started again it goes on."""
    return (
        rows.writeStream.foreachBatch(lambda batch, number: publish_batch(batch, number, state, history, keys, rank, tracked))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def change_stream(spark: SparkSession, history: str, schema: str, late: str = "1 hour") -> DataFrame:
    """The history as a feed: each event once, repetitions within the watermark dropped by their id."""
    return spark.readStream.schema(schema).parquet(history).withWatermark("observed_at", late).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Events per window and key with a watermark; works on streams and tables alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width), key).agg(F.count("*").alias("events")).select(F.col("window.start").alias("start"), key, "events")


def next_batch(rows: DataFrame, order: Sequence[str], watermark: Sequence | None, capacity: int) -> tuple[DataFrame, tuple | None]:
    """The next `capacity` rows behind a watermark and the watermark to store once they are done.

    The watermark is that of the last row taken, so a batch that breaks off is taken again. An exhausted source
    gives no rows and the old watermark.
    """
    page = feed_page(rows, order, watermark, capacity).drop("has_more")
    last = page.agg(F.max(F.struct(*order)).alias("w")).first()["w"]
    return page, tuple(last) if last is not None else (tuple(watermark) if watermark is not None else None)
