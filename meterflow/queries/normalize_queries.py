"""Queries over normalisation, flattening and time operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterflow import frame
from meterflow.operators.flatten import flatten, flatten_array, merge_fields, set_field
from meterflow.operators.normalize import to_metrics
from meterflow.operators.timeops import shift_time, time_range
from meterflow.plans.flow import Modifiers
from meterflow.queries.registry import flat, query, table
from meterflow.sources.search import search


def _union(fields: list[str], columns: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, '{f}' AS metric_field, CAST({f} AS DOUBLE) AS metric FROM {source}" for f in fields
    )


@query("metrics_multi", _union(
    ["l_quantity", "l_extendedprice"],
    "'db' AS input_name, 'items' AS task_name, l_orderkey, l_linenumber, l_returnflag", "lineitem",
))
def metrics_multi(spark, sf):
    items = table(spark, sf, "lineitem")
    out = to_metrics(
        items, "items", ["l_quantity", "l_extendedprice"], ["l_orderkey", "l_linenumber", "l_returnflag"],
        input_name="db",
    )
    return flat(out, "input_name", "task_name")


@query("metrics_glob", _union(
    ["l_extendedprice", "l_discount", "l_tax"],
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate", "lineitem",
))
def metrics_glob(spark, sf):
    return flat(to_metrics(table(spark, sf, "lineitem"), "items", ["l_*price", "l_[dt]*", "*discount"]))


@query("metrics_static_attrs", """
SELECT p_partkey, 'fixed' AS p_brand, p_type, 'prod' AS "env.name", CAST(2 AS BIGINT) AS "env.tier",
  'p_size' AS metric_field, CAST(p_size AS BIGINT) AS metric FROM part
""")
def metrics_static_attrs(spark, sf):
    out = to_metrics(
        table(spark, sf, "part"), "parts", "p_size", ["p_partkey", "p_brand", "p_type"],
        static={"p_brand": "fixed", "env": {"name": "prod", "tier": 2}},
    )
    return flat(out)


@query("metrics_none", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS metric_field, CAST(NULL AS DOUBLE) AS metric FROM customer
""")
def metrics_none(spark, sf):
    return flat(to_metrics(table(spark, sf, "customer"), "names", "nothing*", ["c_custkey", "c_name"], allow_none=True))


@query("metrics_nested", """
SELECT CAST(event_id AS VARCHAR) AS "_id", event_id AS "_source.event_id", event_type AS "_source.meta.event_type",
  'user_id' AS f, '_source.meta.user_id' AS metric_field, CAST(user_id AS DOUBLE) AS metric FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), event_id, event_type, 'value', '_source.value', value FROM events
""")
def metrics_nested(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", F.struct("user_id", "event_type").alias("meta"))
    out = flat(to_metrics(search(events, id_column="event_id"), "events", ["_source.v*", "_source*user_id"]))
    return out.withColumn("f", F.substring_index("metric_field", ".", -1))


@query("metrics_null_kept", _union(
    ["quality", "toxic"], "doc_id", "(SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"
).replace("AS DOUBLE", "AS BIGINT"))
def metrics_null_kept(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return flat(to_metrics(docs, "labels", ["quality", "toxic"]))


@query("metrics_mixed_types", """
SELECT o_orderkey, 'o_custkey' AS metric_field, CAST(o_custkey AS DOUBLE) AS metric FROM orders
UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice FROM orders
UNION ALL SELECT o_orderkey, 'is_open', CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END FROM orders
""")
def metrics_mixed_types(spark, sf):
    orders = table(spark, sf, "orders").withColumn("is_open", F.col("o_orderstatus") == "O")
    return flat(to_metrics(orders, "orders", ["o_custkey", "o_totalprice", "is_open"], ["o_orderkey"]))


@query("flatten_struct", """
SELECT event_id AS id, user_id AS "who.user_id", event_type AS "who.what.event_type", value AS "who.what.value",
  props AS "tags.0", event_type AS "tags.1", CAST(NULL AS VARCHAR) AS "tags.2" FROM events
""")
def flatten_struct(spark, sf):
    nested = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.struct("user_id", F.struct("event_type", "value").alias("what")).alias("who"),
        F.array("props", "event_type").alias("tags"),
    )
    return flatten(nested, max_array=3)


@query("flatten_array_kv", """
SELECT vec_id, 'embedding.' || (i - 1) AS key, CAST(embedding[i] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""")
def flatten_array_kv(spark, sf):
    rows = flatten_array(table(spark, sf, "embeddings"), "embedding", ["vec_id"])
    return rows.withColumn("value", F.col("value").cast("double"))


@query("nested_set", """
SELECT event_id, user_id AS "who.user_id", event_type || '!' AS "who.what.event_type",
  user_id * 2 AS "who.what.twice", 'value' AS metric_field, value + 1 AS metric FROM events
""")
def nested_set(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "value", F.struct("user_id", F.struct("event_type").alias("what")).alias("who")
    )
    out = to_metrics(events, "events", "value")
    out = set_field(out, "who.what.twice", F.col("attributes.who.user_id") * 2)
    out = set_field(out, "who.what.event_type", F.concat("attributes.who.what.event_type", F.lit("!")))
    return flat(set_field(out, "metric", F.col("metric") + 1))


@query("merge_attributes", """
SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment || '?' AS segment, 'c_acctbal' AS metric_field,
  c_acctbal AS metric FROM customer
""")
def merge_attributes(spark, sf):
    out = to_metrics(table(spark, sf, "customer"), "customers", "c_acctbal", ["c_custkey", "c_name", "c_mktsegment"])
    out = merge_fields(out, {
        "c_name": F.upper("attributes.c_name"), "segment": F.concat("attributes.c_mktsegment", F.lit("?")),
    })
    return flat(frame.drop_field(out, "c_mktsegment"))


@query("time_modulus", """
SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS ts FROM events
""")
def time_modulus(spark, sf):
    return shift_time(table(spark, sf, "events").select("event_id", "ts"), "15m", ts="ts")


@query("time_offset", """
SELECT event_id, date_trunc('second', ts) - INTERVAL 90 MINUTE AS ts FROM events
""")
def time_offset(spark, sf):
    return shift_time(table(spark, sf, "events").select("event_id", "ts"), offset="1h:30m", ts="ts")


@query("time_modifiers_chain", """
SELECT event_id, time_bucket(INTERVAL 1 DAY, date_trunc('hour', ts) - INTERVAL 61 MINUTE, TIMESTAMP '1970-01-01')
  + INTERVAL 12 HOUR AS ts FROM events
""")
def time_modifiers_chain(spark, sf):
    events = table(spark, sf, "events")
    out = to_metrics(events, "events", "value", ["event_id"], ts="ts")
    out = Modifiers("1d", "-12h").apply(Modifiers("1h", "1h:1m").apply(out))
    return out.select("attributes.event_id", F.col("metric_ts").alias("ts"))


@query("timerange_filter", """
SELECT event_id, ts, value FROM events
WHERE ts > TIMESTAMP '2024-01-04 00:00:00' AND ts <= TIMESTAMP '2024-01-15 11:30:00'
""")
def timerange_filter(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    anchor = dt.datetime(2024, 1, 15, 12, 34, 56)
    return time_range(events, "now/M+3d", "now/h-30m", "ts", anchor, lower="gt", upper="lte")
