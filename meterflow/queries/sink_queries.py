"""Queries over output formats, batches and whole flows."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from meterflow.operators.batches import batch_ids, local_batches
from meterflow.operators.filters import simple_filter
from meterflow.operators.normalize import to_metrics
from meterflow.operators.timeops import shift_time
from meterflow.plans.flow import Flow, Task, Transform
from meterflow.queries.registry import query, table
from meterflow.sinks.formats import documents, envelope, json_arrays, json_lines
from meterflow.sources.sql import sql_source

_EVENT_JSON = (
    "'{\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\",\"props\":\"'"
    " || replace(props, '\"', '\\\"') || '\"}'"
)


def _events(spark, sf, **options):
    return to_metrics(
        table(spark, sf, "events"), F.col("event_type"), "user_id", ["event_type", "props"], ts="ts",
        seq="event_id", **options,
    )


@query("json_lines", f"SELECT event_id AS seq, {_EVENT_JSON} AS value FROM events")
def lines(spark, sf):
    return json_lines(_events(spark, sf))


@query("json_lines_truncated", f"""
WITH t AS (SELECT event_id AS seq, {_EVENT_JSON} AS v FROM events)
SELECT seq, CASE WHEN length(v) > 58 THEN substring(v, 1, 55) || '...' ELSE v END AS value FROM t
""")
def lines_truncated(spark, sf):
    return json_lines(_events(spark, sf), width=58)


@query("json_array_batches", f"""
WITH t AS (SELECT event_id, {_EVENT_JSON} AS v, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events)
SELECT CAST(n // 300 AS BIGINT) AS batch_id, COUNT(*) AS n_rows, '[' || string_agg(v, ',' ORDER BY event_id) || ']' AS payload
FROM t GROUP BY n // 300
""")
def array_batches(spark, sf):
    batches = batch_ids(json_lines(_events(spark, sf)), 300, "seq")
    return json_arrays(batches, "batch_id", "seq")


@query("batch_ids", """
SELECT o_orderkey, o_totalprice, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 2000 AS BIGINT) AS batch_id FROM orders
""")
def batches_in_order(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return batch_ids(orders, 2000, "o_orderkey")


@query("batch_sizes", "SELECT COUNT(*) AS n_rows, true AS within_limit, true AS enough_batches FROM lineitem")
def batch_sizes(spark, sf):
    """Shuffle-free batches: their ids depend on the file layout, their sizes are bounded."""
    sizes = local_batches(table(spark, sf, "lineitem"), 2000).groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= 2000).alias("within_limit"),
        (F.count("*") * 2000 >= F.sum("n")).alias("enough_batches"),
    )


_ENVELOPE = """
SELECT event_id AS seq, '{"data":{"event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"')
  || '","user_id":' || user_id || '},"environment":"dev","owner":{"team":"a"},"producer":"shop","timestamp":'
  || CAST(epoch(date_trunc('day', ts)) AS BIGINT) || '.000000,"type":"' || event_type || '","type_prefix":"snw"}' AS value
FROM events
"""


@query("envelope_json", _ENVELOPE)
def envelopes(spark, sf):
    frame = shift_time(_events(spark, sf), "1d")
    return envelope(frame, "shop", "test", "snw", {"environment": "dev", "owner": {"team": "a"}})


@query("envelope_fields", """
SELECT event_id AS seq, 'shop' AS producer, event_type AS type, CAST(epoch(date_trunc('second', ts)) AS DOUBLE) AS timestamp,
  user_id, 'user_id' AS name FROM events
""")
def envelope_fields(spark, sf):
    """Envelopes read back field by field."""
    sent = envelope(shift_time(_events(spark, sf)), "shop", name_field="name")
    got = F.from_json("value", "producer STRING, type STRING, timestamp DOUBLE, data STRUCT<user_id: BIGINT, name: STRING>")
    return sent.select("seq", got.alias("e")).select("seq", "e.producer", "e.type", "e.timestamp", "e.data.*")


@query("envelope_multi_field", """
WITH m AS (SELECT o_orderkey, 'm' || x AS f, x, o_orderstatus FROM orders, (SELECT unnest(range(0, 6)) AS x))
SELECT o_orderkey AS seq, '{"data":{"' || f || '":' || (o_orderkey + x) || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus
  || '"},"environment":"default","producer":"shop","timestamp":0.250000,"type":"orders","type_prefix":"raw"}' AS value FROM m
""")
def envelope_multi_field(spark, sf):
    """More metric fields than typed branches: the name of the field is data."""
    wide = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", *[(F.col("o_orderkey") + i).alias(f"m{i}") for i in range(6)]
    ).withColumn("order", F.col("o_orderkey"))
    frame = to_metrics(
        wide, "orders", "m?", ["o_orderkey", "o_orderstatus"], ts=F.timestamp_seconds(F.lit(0.25)), seq="order"
    )
    return envelope(frame, "shop")


@query("index_documents", r"""
SELECT event_id AS seq, '{"user_id":' || user_id || ',"event_type":"' || event_type || '","props":"'
  || replace(props, '"', '\"') || '","at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value FROM events
""")
def index_documents(spark, sf):
    return documents(_events(spark, sf), ts_field="at")


_FLOW = """
WITH t AS (SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS qty, COUNT(*) AS n FROM lineitem GROUP BY ALL),
m AS (SELECT l_returnflag, l_linestatus, 'qty' AS f, qty AS v FROM t
  UNION ALL SELECT l_returnflag, l_linestatus, 'n', n FROM t)
SELECT 'demo' AS producer, 'items' AS type, 0.0 AS timestamp, l_returnflag, l_linestatus, 'prod' AS site, f AS name, v AS metric
FROM m WHERE v > 0
"""


@query("flow_sql_to_envelope", _FLOW)
def flow_sql_to_envelope(spark, sf):
    """SQL source, two metrics per row, a filter, static attributes, and the envelope."""
    def source(session):
        return sql_source(
            session,
            "SELECT SUM(l_quantity) AS qty, COUNT(*) AS n, l_returnflag, l_linestatus FROM lineitem"
            " GROUP BY l_returnflag, l_linestatus",
            tables={"lineitem": table(session, sf, "lineitem")},
        )

    task = Task(
        "items", source, metrics=["qty", "n"], static={"site": "prod"}, ts=F.timestamp_seconds(F.lit(0.25))
    )
    flow = Flow([task], [Transform(partial(simple_filter, cond="gt 0"))])
    sent = envelope(flow.frames(spark)["items"], "demo", name_field="name")
    schema = (
        "producer STRING, type STRING, timestamp DOUBLE,"
        " data STRUCT<l_returnflag: STRING, l_linestatus: STRING, site: STRING, name: STRING, qty: DOUBLE, n: DOUBLE>"
    )
    got = sent.select(F.from_json("value", schema).alias("e")).select("e.producer", "e.type", "e.timestamp", "e.data.*")
    return got.withColumn("metric", F.coalesce("qty", "n")).drop("qty", "n")
