"""Whole lists, many metric fields, equal names, large mappings, several overlays and nested limits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterflow.operators.buckets import Terms, bucket_agg
from meterflow.operators.filters import simple_filter
from meterflow.operators.lookup import enrich
from meterflow.operators.mapping import map_values
from meterflow.operators.normalize import to_metrics
from meterflow.operators.overlay import overlay
from meterflow.queries.registry import flat, query, table
from meterflow.sinks.formats import envelope, json_lines
from meterflow.sources.payloads import json_records
from meterflow.sources.summaries import level_summary

AT = dt.datetime(2024, 5, 1)


def _parts(spark, sf, *attributes, **options):
    return to_metrics(table(spark, sf, "part"), "parts", "p_retailprice", ["p_partkey", *attributes], ts=F.lit(AT), **options)


@query("map_large_original", """
SELECT CASE WHEN p_partkey <= 300 THEN 'part-' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS p_partkey,
  'p_retailprice' AS metric_field, p_retailprice AS metric FROM part
""")
def map_large_original(spark, sf):
    return flat(map_values(_parts(spark, sf), {k: f"part-{k}" for k in range(301)}, "p_partkey", missing="original"))


@query("map_large_default", """
SELECT p_partkey, CASE WHEN p_partkey <= 300 THEN CAST(p_partkey * 2 AS VARCHAR) ELSE 'unknown' END AS double,
  'p_retailprice' AS metric_field, p_retailprice AS metric FROM part
""")
def map_large_default(spark, sf):
    return flat(map_values(_parts(spark, sf), {k: 2 * k for k in range(301)}, "p_partkey", "double", default="unknown"))


@query("map_large_bool", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size, 'p_retailprice' AS metric_field,
  p_retailprice AS metric FROM part
""")
def map_large_bool(spark, sf):
    parts = table(spark, sf, "part").withColumn("size", F.col("p_size") > 25)
    frame = to_metrics(parts, "parts", "p_retailprice", ["p_partkey", "size"])
    return flat(map_values(frame, {0: "small", 1: "large", **{k: "other" for k in range(2, 300)}}, "size"))


_CODES = "list_transform(range(len(embedding)), lambda i: '\"codes.' || i || '\":' || CAST(floor(CAST(embedding[i + 1] AS DOUBLE) * 1000) AS INT))"


def _codes(spark, sf):
    codes = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int"))
    vectors = table(spark, sf, "embeddings").withColumn("codes", codes)
    return to_metrics(vectors, "vectors", "label", ["vec_id", "codes"], ts=F.lit(AT), seq="vec_id")


@query("json_lines_lists", f"""
SELECT vec_id AS seq, '{{"label":' || label || ',"vec_id":' || vec_id || ',' || array_to_string({_CODES}, ',') || '}}' AS value
FROM embeddings
""")
def json_lines_lists(spark, sf):
    return json_lines(_codes(spark, sf))


@query("envelope_lists", f"""
SELECT vec_id AS seq, '{{"data":{{' || array_to_string(list_sort({_CODES}), ',') || ',"label":' || label || ',"vec_id":' || vec_id
  || '}},"environment":"dev","producer":"p","timestamp":1714521600.000000,"type":"vectors","type_prefix":"raw"}}' AS value
FROM embeddings
""")
def envelope_lists(spark, sf):
    return envelope(_codes(spark, sf), "p", "dev")


_FIELDS = ["l_discount", "l_extendedprice", "l_quantity", "l_tax", "half"]


@query("envelope_many_fields", """
WITH l AS (SELECT *, l_quantity / 2 AS half FROM lineitem),
m AS (UNPIVOT l ON l_discount, l_extendedprice, l_quantity, l_tax, half INTO NAME f VALUE v)
SELECT '{"data":{' || CASE WHEN f < 'l_linenumber' THEN '"' || f || '":' || v || ',' ELSE '' END || '"l_linenumber":' || l_linenumber
  || CASE WHEN f > 'l_linenumber' AND f < 'l_orderkey' THEN ',"' || f || '":' || v ELSE '' END || ',"l_orderkey":' || l_orderkey
  || CASE WHEN f > 'l_orderkey' THEN ',"' || f || '":' || v ELSE '' END
  || '},"environment":"dev","producer":"p","timestamp":1714521600.000000,"type":"items","type_prefix":"raw"}' AS value
FROM m
""")
def envelope_many_fields(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("half", F.col("l_quantity") / 2)
    return envelope(to_metrics(items, "items", _FIELDS, ["l_orderkey", "l_linenumber"], ts=F.lit(AT)), "p", "dev")


def _own_names(spark, sf):
    """Metrics beside a static attribute of the same name."""
    return to_metrics(table(spark, sf, "part"), "parts", ["p_retailprice", "p_size"], ["p_partkey"], {"p_size": 9}, ts=F.lit(AT))


@query("metric_name_precedence", """
SELECT '{"p_retailprice":' || p_retailprice || ',"p_partkey":' || p_partkey || ',"p_size":9}' AS value FROM part
UNION ALL SELECT '{"p_size":' || CAST(p_size AS DOUBLE) || ',"p_partkey":' || p_partkey || '}' FROM part
""")
def metric_name_precedence(spark, sf):
    return json_lines(_own_names(spark, sf))


@query("metric_name_filter", """
SELECT '{"p_partkey":' || p_partkey || ',"p_size":' || CAST(p_size AS DOUBLE) || '}' AS data FROM part WHERE p_size > 10
""")
def metric_name_filter(spark, sf):
    """The filter tests the metric where the row has it, else the attribute, which is 9."""
    kept = envelope(simple_filter(_own_names(spark, sf), "gt 10 p_size"), "p")
    return kept.select(F.regexp_extract("value", r'"data":(\{[^}]*\})', 1).alias("data"))


@query("metric_name_map", """
SELECT p_partkey, CAST(9 AS BIGINT) AS p_size, 'p_retailprice' AS metric_field, p_retailprice AS metric FROM part
UNION ALL SELECT p_partkey, CAST(9 AS BIGINT), 'p_size', CASE WHEN p_size = 7 THEN 700.0 ELSE CAST(p_size AS DOUBLE) END FROM part
""")
def metric_name_map(spark, sf):
    mapped = map_values(_own_names(spark, sf), {7: 700.0}, "p_size", missing="original")
    return flat(mapped).withColumn("p_size", F.col("p_size").cast("bigint"))


@query("json_inferred_keys", """
SELECT event_id AS "AVOIDED", event_type AS "OBJECT<", event_id AS id FROM events
UNION ALL SELECT event_id + 1, 'VOID', event_id FROM events
""")
def json_inferred_keys(spark, sf):
    one = F.struct(F.col("event_id").alias("AVOIDED"), F.col("event_type").alias("OBJECT<"))
    two = F.struct((F.col("event_id") + 1).alias("AVOIDED"), F.lit("VOID").alias("OBJECT<"))
    docs = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.to_json(F.array(one, two)).alias("doc"))
    return json_records(docs, "doc", keep=["id"])


@query("log_level_aliases", """
WITH l(n, v) AS (VALUES ('warn', 30), ('FATAL', 50), ('Warning', 30), ('ERROR', 40), ('trace', 0)),
e AS (SELECT v FROM events JOIN l ON n = ['warn', 'FATAL', 'Warning', 'ERROR', 'trace'][1 + event_id % 5])
SELECT CAST((SELECT COUNT(*) FROM e WHERE v = k) AS BIGINT) AS metric, 'log' AS metric_type, CAST(k AS INT) AS log_level
FROM (VALUES (30), (40), (50)) t(k)
""")
def log_level_aliases(spark, sf):
    names = F.array(*[F.lit(n) for n in ("warn", "FATAL", "Warning", "ERROR", "trace")])
    logs = table(spark, sf, "events").select(F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")).alias("level"))
    return level_summary(logs, "WARN")


@query("overlay_three", """
SELECT coalesce(s.s_suppkey, c.c_custkey, p.p_partkey, o.o_orderkey) AS name,
  coalesce(c.c_name, p.p_name, CAST(o.o_orderkey AS VARCHAR), s.s_name) AS label
FROM supplier s FULL JOIN orders o ON s.s_suppkey = o.o_orderkey
FULL JOIN part p ON coalesce(s.s_suppkey, o.o_orderkey) = p.p_partkey
FULL JOIN customer c ON coalesce(s.s_suppkey, o.o_orderkey, p.p_partkey) = c.c_custkey
""")
def overlay_three(spark, sf):
    """The first overlay listed is applied last and wins."""
    def named(name, key, label):
        return table(spark, sf, name).select(F.col(key).alias("name"), F.col(label).cast("string").alias("label"))

    return overlay(
        named("supplier", "s_suppkey", "s_name"), named("customer", "c_custkey", "c_name"), named("part", "p_partkey", "p_name"),
        named("orders", "o_orderkey", "o_orderkey"))


def _values(spark, sf, user):
    events = table(spark, sf, "events").withColumn("user", user)
    return to_metrics(events, "values", "value", ["event_id", "user", "event_type"])


@query("lookup_within", """
SELECT event_id, user_id AS "user", event_type, 'value' AS metric_field, value AS metric,
  CASE WHEN event_type = 'click' THEN c_name END AS c_name
FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def lookup_within(spark, sf):
    frame = _values(spark, sf, F.col("user_id"))
    clicks = F.col("attributes.event_type") == "click"
    return flat(enrich(frame, table(spark, sf, "customer").select("c_custkey", "c_name"), "user", "c_custkey", within=clicks))


@query("lookup_null_keys", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS "user", event_type, 'value' AS metric_field, value AS metric,
  CASE WHEN event_id % 3 = 0 THEN c_name END AS c_name
FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def lookup_null_keys(spark, sf):
    frame = _values(spark, sf, F.when(F.col("event_id") % 3 == 0, F.col("user_id")))
    return flat(enrich(frame, table(spark, sf, "customer").select("c_custkey", "c_name"), "user", "c_custkey"))


@query("lookup_default_types", """
SELECT event_id, event_id AS "user", event_type, 'value' AS metric_field, value AS metric,
  coalesce(CAST(nullif(c_nationkey, 0) AS VARCHAR), 'n/a') AS c_nationkey, coalesce(nullif(c_acctbal, 0), 0.0) AS c_acctbal
FROM events LEFT JOIN customer ON event_id = c_custkey
""")
def lookup_default_types(spark, sf):
    frame = _values(spark, sf, F.col("event_id"))
    defaults = {"c_nationkey": "n/a", "c_acctbal": 0}
    return flat(enrich(frame, table(spark, sf, "customer"), "user", "c_custkey", list(defaults), defaults))


@query("bucket_nested_top_three", """
WITH c AS (SELECT l_returnflag AS flag, l_linenumber AS line, l_suppkey AS supp, COUNT(*) AS doc_count FROM lineitem GROUP BY ALL),
f AS (SELECT flag, row_number() OVER (ORDER BY SUM(doc_count) DESC, flag) AS r FROM c GROUP BY flag QUALIFY r <= 2),
l AS (SELECT flag, line, row_number() OVER (PARTITION BY flag ORDER BY SUM(doc_count) DESC, line) AS r FROM c GROUP BY flag, line QUALIFY r <= 3)
SELECT flag, line, supp, doc_count FROM c JOIN f USING (flag) JOIN l USING (flag, line)
QUALIFY row_number() OVER (PARTITION BY flag, line ORDER BY doc_count DESC, supp) <= 4
""")
def bucket_nested_top_three(spark, sf):
    levels = [Terms("flag", "l_returnflag", 2), Terms("line", "l_linenumber", 3), Terms("supp", "l_suppkey", 4)]
    return bucket_agg(table(spark, sf, "lineitem"), levels)
