"""Queries that run a stream to its end and read the result back."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from meterflow.operators.filters import simple_filter
from meterflow.plans.flow import Flow, Modifiers, Output, Task, Transform
from meterflow.queries.registry import query, table
from meterflow.sinks.formats import json_lines
from meterflow.sinks.writers import documents_to, table_to
from meterflow.sources.topics import read_topic, write_topic
from meterflow.streaming.run import batch_counts, count_batches, run_stream, total_counts, write_batch
from meterflow.streaming.workspace import workspace


def _stream(spark, sf, name):
    # the pattern finds a table held in one file as well as one held in a folder
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parquet*")


@query("stream_event_counts", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
  COUNT(*) AS n FROM events GROUP BY ALL
""")
def stream_event_counts(spark, sf):
    place = workspace(spark, "event-counts")
    # files in reverse order of time: the later half first, each its own batch
    events = table(spark, sf, "events")
    middle = events.agg(F.timestamp_micros(F.avg(F.unix_micros(F.col("ts").cast("timestamp"))).cast("bigint"))).first()[0]
    for part in (F.col("ts").cast("timestamp") >= F.lit(middle), F.col("ts").cast("timestamp") < F.lit(middle)):
        events.where(part).write.mode("append").parquet(f"{place}/files")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/files")
    count_batches(stream, "ts", "1 hour", ["event_type"], f"{place}/table", f"{place}/checkpoint").awaitTermination()
    total = total_counts(spark.read.parquet(f"{place}/table"), ["event_type"])
    return total.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_repeated_batch", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, COUNT(*) AS n FROM events GROUP BY ALL
""")
def stream_repeated_batch(spark, sf):
    """Batches 0 and 1 are written, then batch 0 again, as after a failure."""
    place = workspace(spark, "repeated")
    events = table(spark, sf, "events")
    halves = [events.where("event_id % 2 = 0"), events.where("event_id % 2 <> 0")]
    for batch_id in (0, 1, 0):
        write_batch(batch_counts(halves[batch_id], "ts", "1 day"), f"{place}/table", batch_id)
    total = total_counts(spark.read.parquet(f"{place}/table"))
    return total.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_flow", """
SELECT '{"value":' || value || ',"event_id":' || event_id || ',"at":"' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.000000Z') || '"}' AS doc
FROM events WHERE value > 200
""")
def stream_flow(spark, sf):
    """A flow with two outputs over a stream; the documents are read back."""
    place = workspace(spark, "flow")
    stream = _stream(spark, sf, "events")
    task = Task(
        "events", stream, metrics="value", attributes=["event_id"], ts="ts", modifiers=Modifiers("1h")
    )
    outputs = [Output(documents_to(f"{place}/docs", "at")), Output(table_to(f"{place}/frame"))]
    flow = Flow([task], [Transform(partial(simple_filter, cond="gt 200"))], outputs)
    run_stream(flow, task, stream, f"{place}/checkpoint").awaitTermination()
    return spark.read.text(f"{place}/docs").select(F.col("value").alias("doc"))


@query("topic_messages", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
""")
def topic_messages(spark, sf):
    """Orders written as JSON messages to a topic and read again."""
    place = workspace(spark, "topic")
    orders = _stream(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    sent = write_topic(json_lines(orders), f"{place}/sent", "text", {"path": f"{place}/topic"})
    sent.trigger(availableNow=True).start().awaitTermination()
    schema = "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE"
    received = read_topic(spark, schema, "text", {"path": f"{place}/topic"})
    writer = received.writeStream.format("parquet").option("checkpointLocation", f"{place}/received")
    writer.trigger(availableNow=True).start(f"{place}/table").awaitTermination()
    return spark.read.parquet(f"{place}/table")


@query("flow_task_states", """
SELECT name, CASE WHEN n = 0 THEN 'skipped' ELSE 'finished' END AS state, n FROM (
  SELECT 'large' AS name, COUNT(*) FILTER (value > 200) AS n FROM events
  UNION ALL SELECT 'none', COUNT(*) FILTER (event_type = 'no such type') FROM events)
""")
def flow_task_states(spark, sf):
    """States of a flow's tasks: one without records is skipped and sends nothing."""
    place = workspace(spark, "states")
    events = table(spark, sf, "events")
    tasks = [
        Task("large", events.where("value > 200"), metrics="value", attributes=["event_id"], ts="ts"),
        Task("none", events.where("event_type = 'no such type'"), metrics="value", attributes=["event_id"], ts="ts"),
    ]
    states = Flow(tasks, [], [Output(table_to(f"{place}/sent"))]).run(spark)
    sent = spark.read.parquet(f"{place}/sent").groupBy("task_name").agg(F.count("*").alias("n"))
    told = spark.createDataFrame(sorted(states.items()), "name string, state string")
    return told.join(sent, told.name == sent.task_name, "left").select("name", "state", F.coalesce("n", F.lit(0)).alias("n"))
