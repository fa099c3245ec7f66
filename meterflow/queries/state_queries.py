"""Queries whose streams keep state: runs, stored bucket states, compacted logs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from meterflow.operators.bucket_state import bucket_state, merge_state, read_state
from meterflow.operators.buckets import DateHistogram, Terms
from meterflow.queries.registry import query, table
from meterflow.sources.summaries import RESULTS, run_summaries
from meterflow.streaming.batch_log import BatchLog, log_batches
from meterflow.streaming.run import batch_counts, total_counts
from meterflow.streaming.runs import LOST, pending_runs, track_runs
from meterflow.streaming.workspace import workspace

# even events start a run, the odd ones after them end it, but for clicks; 21 days is how late a message may be
_RUNS_SQL = """
WITH m AS (SELECT event_id // 2 AS run, event_id % 2 AS e, ts,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'okay' END AS result
  FROM events WHERE event_id % 2 = 0 OR event_type <> 'click'),
r AS (SELECT run, min(ts) FILTER (e = 0) AS s, min(ts) FILTER (e = 1) AS f, min(result) FILTER (e = 1) AS result FROM m GROUP BY run),
o AS (SELECT CAST(run AS VARCHAR) AS run, s AS started_at, CASE
    WHEN f <= s + INTERVAL 5 MINUTE THEN f
    WHEN f IS NOT NULL OR s + INTERVAL 5 MINUTE < (SELECT max(ts) FROM m) - INTERVAL 21 DAY THEN s + INTERVAL 5 MINUTE
  END AS finished_at, result AS told FROM r WHERE s IS NOT NULL),
runs AS (SELECT run, started_at, finished_at, CASE WHEN finished_at IS NULL THEN 'pending'
  WHEN finished_at = started_at + INTERVAL 5 MINUTE THEN 'lost' ELSE told END AS result FROM o)
"""


def _messages(spark, sf):
    kind = F.when(F.col("event_id") % 2 == 0, "start").when(F.col("event_type") != "click", "end")
    result = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("okay")
    return table(spark, sf, "events").select(
        F.expr("event_id div 2").cast("string").alias("run"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "end", result).alias("result"), (F.col("event_id") % 10 == 0).alias("delayed"))


def _tracked(spark, sf, name):
    """The messages in three files by time, every fifth start a file later than its end; the runs told and where."""
    place = workspace(spark, name)
    messages = _messages(spark, sf)
    third = F.least(F.expr("(day(ts) - 1) div 10") + F.col("delayed").cast("int"), F.lit(2))
    for k in range(3):
        messages.where(third == k).drop("delayed").coalesce(1).write.mode("append").parquet(f"{place}/files")
    stream = spark.readStream.schema(messages.drop("delayed").schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/files")
    writer = track_runs(stream, "5m", "21d").writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint")
    writer.trigger(availableNow=True).start(f"{place}/runs").awaitTermination()
    return spark.read.parquet(f"{place}/runs"), f"{place}/checkpoint"


def _local(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_run_tracking", _RUNS_SQL + "SELECT run, started_at, finished_at, result FROM runs")
def stream_run_tracking(spark, sf):
    """Runs told by the stream, and those still pending in its state; ends may be read before their starts."""
    runs, checkpoint = _tracked(spark, sf, "runs")
    pending = pending_runs(spark, checkpoint).withColumns({"finished_at": F.lit(None).cast("timestamp"), "result": F.lit("pending")})
    return _local(runs.unionByName(pending), "started_at", "finished_at")


@query("stream_run_results", _RUNS_SQL + """
SELECT COUNT(*) FILTER (runs.result = k.result) AS metric, 'task_result' AS metric_type, k.result,
  date_trunc('day', finished_at) AS timestamp_from, date_trunc('day', finished_at) + INTERVAL 1 DAY AS timestamp_to
FROM runs, (VALUES ('okay'), ('skipped'), ('failed'), ('lost')) k(result) WHERE finished_at IS NOT NULL GROUP BY ALL
""")
def stream_run_results(spark, sf):
    """Outcomes per day in which runs were over, lost ones included; pending runs count in the day that ends them."""
    runs, _ = _tracked(spark, sf, "run-results")
    return _local(run_summaries(runs, "1d", outcomes=(*RESULTS, LOST)), "timestamp_from", "timestamp_to")


_LEVELS = [DateHistogram("day", "ts", "1d"), Terms("kind", "event_type")]
_METRICS = {
    "cents": ("sum", "CAST(ROUND(value * 100) AS BIGINT)"), "values": ("count", "value"), "low": ("min", "value"), "high": ("max", "value"),
    "users": ("cardinality", "user_id"), "median": ("percentile", "value", 0.5),
}


def _batches(spark, sf, place, parts):
    """Events in ``parts`` files, rows of all times in each."""
    events = table(spark, sf, "events")
    for k in range(parts):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == k).coalesce(1).write.mode("append").parquet(f"{place}/files")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/files")


def _state_log(spark, place, schema):
    return BatchLog(spark, f"{place}/log", schema, partial(merge_state, levels=_LEVELS, metrics=_METRICS), every=2)


@query("stream_bucket_state", """
SELECT date_trunc('day', ts) AS day, event_type AS kind, COUNT(*) AS doc_count, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents,
  COUNT(value) AS values, MIN(value) AS low, MAX(value) AS high, true AS users_near, true AS median_near
FROM events GROUP BY ALL
UNION ALL SELECT date_trunc('day', ts), NULL, COUNT(*), CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT), COUNT(value), MIN(value), MAX(value), true, true
FROM events GROUP BY ALL
""")
def stream_bucket_state(spark, sf):
    """Bucket states of five batches in a compacted log, read at both depths of the tree; sketches against exact counts."""
    place = workspace(spark, "bucket-state")
    stream = _batches(spark, sf, place, 5)
    fold = partial(bucket_state, levels=_LEVELS, metrics=_METRICS)
    log = _state_log(spark, place, fold(table(spark, sf, "events")).schema)
    log_batches(stream, log, fold, f"{place}/checkpoint").awaitTermination()
    rows = log.rows()
    inner, outer = read_state(rows, _LEVELS, _METRICS), read_state(rows, _LEVELS, _METRICS, depth=1)
    both = inner.unionByName(outer.withColumn("kind", F.lit(None).cast("string")))
    # every bucket next to its own events, at both depths
    events = table(spark, sf, "events").select(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("_day"), F.explode(F.array("event_type", F.lit(None))).alias("_kind"), "user_id", "value")
    own = events.join(both, (F.col("_day") == F.col("day")) & F.col("_kind").eqNullSafe(F.col("kind")))
    names = ["day", "kind", "doc_count", "cents", "values", "low", "high"]
    exact = own.groupBy(*names, "users", "median").agg(
        F.count_distinct("user_id").alias("_users"), F.count_if(F.col("value") <= F.col("median")).alias("_upto"),
        F.count_if(F.col("value") < F.col("median")).alias("_below"))
    users_near = F.abs(F.col("users") - F.col("_users")) <= 0.08 * F.col("_users")
    # the true rank of the estimate is within one percent of the half
    median_near = (F.col("_upto") >= 0.49 * F.col("doc_count")) & (F.col("_below") <= 0.51 * F.col("doc_count"))
    return exact.select(*names, users_near.alias("users_near"), median_near.alias("median_near"))


@query("stream_compacted_log", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS n,
FROM events GROUP BY ALL
""")
def stream_compacted_log(spark, sf):
    """Counts of nine batches; batches come again before and after the log was compacted over them."""
    place = workspace(spark, "log")
    events = table(spark, sf, "events")
    counts = partial(batch_counts, ts="ts", every="1 hour", keys=["event_type"])
    log = BatchLog(spark, f"{place}/log", counts(events).schema, partial(total_counts, keys=["event_type"]), every=2)
    for batch_id in (0, 0, 1, 2, 3, 3, 1, 4, 5, 6, 7, 8, 2, 8):
        log.append(counts(events.where(F.pmod(F.xxhash64("event_id"), F.lit(9)) == batch_id)), batch_id)
    return _local(log.read(), "window_start", "window_end")
