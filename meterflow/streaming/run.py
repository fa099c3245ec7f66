"""Flows on streams, and per-interval counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.plans.flow import Flow, Task


def run_stream(
    flow: Flow, task: Task, stream: DataFrame, checkpoint: str, trigger: dict | None = None, prefix: str = ""
) -> StreamingQuery:
    """Run a task over every micro-batch of a stream and send it to the task's outputs.

    The batch id is the run key, so a batch repeated after a failure replaces its own output. A
    query started anew with another checkpoint counts from zero again and needs its own ``prefix``.
    """
    def deliver(batch: DataFrame, batch_id: int) -> None:
        flow.deliver(task, batch, f"{prefix}{batch_id}")

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def interval_counts(
    stream: DataFrame, ts: str, every: str, keys: Sequence[str], late: str
) -> DataFrame:
    """Rows per interval and key in bounded state: rows more than ``late`` behind the newest are dropped.

    ``count_batches`` drops none and needs no state.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, every), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def batch_counts(batch: DataFrame, ts: str, every: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of one batch per interval and key."""
    timed = batch.withColumn(ts, F.col(ts).cast("timestamp"))
    counts = timed.groupBy(F.window(ts, every), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def write_batch(counts: DataFrame, path: str, batch_id: int) -> None:
    """The counts of one batch in its own folder; a repeated batch replaces what it wrote before."""
    counts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def count_batches(
    stream: DataFrame, ts: str, every: str, keys: Sequence[str], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the counts of every micro-batch; ``total_counts`` adds them up.

    Rows may come in any order and however late: nothing is dropped and no state is kept.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch_counts(batch, ts, every, keys), path, batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def total_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per interval and key over all batches read back."""
    return counts.groupBy("window_start", "window_end", *keys).agg(F.sum("n").alias("n"))


def write_updates(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write changed counts of every micro-batch to its own folder, replaced if it is repeated."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_updates(updates: DataFrame, keys: Sequence[str], value: str = "n") -> DataFrame:
    """Current count of every key from the folders of ``write_updates``."""
    return updates.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))
