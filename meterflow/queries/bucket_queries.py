"""Queries over bucket aggregations, gauges and bucket documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators.buckets import (
    BucketLevel,
    DateHistogram,
    Filters,
    Histogram,
    Terms,
    bucket_agg,
    flatten_buckets,
    root_agg,
)
from meterflow.operators.flatten import flatten
from meterflow.operators.frequent import frequent_buckets
from meterflow.operators.gauges import gauge_rows, last_value
from meterflow.operators.normalize import to_metrics
from meterflow.queries.registry import flat, query, table


@query("bucket_terms", """
SELECT l_returnflag AS flag, 'doc_count' AS metric_field, CAST(COUNT(*) AS DOUBLE) AS metric FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT l_returnflag, 'total', SUM(l_quantity) FROM lineitem GROUP BY l_returnflag
""")
def bucket_terms(spark, sf):
    buckets = bucket_agg(
        table(spark, sf, "lineitem"), [Terms("flag", "l_returnflag")], {"total": ("sum", "l_quantity")}
    )
    return flat(to_metrics(buckets, "flags", ["total", "doc_count"]))


@query("bucket_terms_top", """
SELECT l_partkey AS part, COUNT(*) AS doc_count, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_partkey
ORDER BY doc_count DESC, part LIMIT 10
""")
def bucket_terms_top(spark, sf):
    return bucket_agg(
        table(spark, sf, "lineitem"), [Terms("part", "l_partkey", top_n=10)], {"qty": ("sum", "l_quantity")}
    )


@query("bucket_nested", """
SELECT l_returnflag AS flag, l_linestatus AS status, l_suppkey AS supplier, COUNT(*) AS doc_count,
  ROUND(SUM(l_extendedprice), 2) AS price, MAX(l_shipdate) AS last
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_suppkey
""")
def bucket_nested(spark, sf):
    levels = [Terms("flag", "l_returnflag"), Terms("status", "l_linestatus"), Terms("supplier", "l_suppkey")]
    metrics = {"price": ("sum", "l_extendedprice"), "last": ("max", "l_shipdate")}
    return bucket_agg(table(spark, sf, "lineitem"), levels, metrics).withColumn("price", F.round("price", 2))


@query("bucket_nested_top", """
WITH g AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, COUNT(*) AS doc_count FROM customer GROUP BY ALL),
n AS (SELECT nation FROM g GROUP BY nation ORDER BY SUM(doc_count) DESC, nation LIMIT 7)
SELECT * FROM g WHERE nation IN (SELECT nation FROM n)
QUALIFY row_number() OVER (PARTITION BY nation ORDER BY doc_count DESC, segment) <= 2
""")
def bucket_nested_top(spark, sf):
    levels = [Terms("nation", "c_nationkey", top_n=7), Terms("segment", "c_mktsegment", top_n=2)]
    return bucket_agg(table(spark, sf, "customer"), levels)


_FILTERS = {
    "large": "l_quantity > 40",
    "returned": "l_returnflag = 'R'",
    "cheap": "l_extendedprice < 2000",
    "never": "l_quantity < 0",
}


@query("bucket_filters", " UNION ALL ".join(
    f"SELECT '{n}' AS kind, COUNT(*) AS doc_count, SUM(l_quantity) AS qty FROM lineitem WHERE {c}"
    for n, c in _FILTERS.items()
))
def bucket_filters(spark, sf):
    return bucket_agg(table(spark, sf, "lineitem"), [Filters("kind", _FILTERS)], {"qty": ("sum", "l_quantity")})


@query("bucket_filters_below", " UNION ALL ".join(
    f"SELECT l_linestatus AS status, '{n}' AS kind, COUNT(*) FILTER (WHERE {c}) AS doc_count,"
    f" SUM(l_quantity) FILTER (WHERE {c}) AS qty FROM lineitem GROUP BY l_linestatus"
    for n, c in _FILTERS.items()
))
def bucket_filters_below(spark, sf):
    levels = [Terms("status", "l_linestatus"), Filters("kind", _FILTERS)]
    return bucket_agg(table(spark, sf, "lineitem"), levels, {"qty": ("sum", "l_quantity")})


@query("bucket_filters_above", " UNION ALL ".join(
    f"SELECT '{n}' AS kind, l_linestatus AS status, COUNT(*) AS doc_count, SUM(l_quantity) AS qty"
    f" FROM lineitem WHERE {c} GROUP BY l_linestatus"
    for n, c in _FILTERS.items()
) + " UNION ALL SELECT 'never', NULL, 0, NULL")
def bucket_filters_above(spark, sf):
    """Terms below overlapping filters; a filter without hits still is a record."""
    levels = [Filters("kind", _FILTERS), Terms("status", "l_linestatus")]
    return bucket_agg(table(spark, sf, "lineitem"), levels, {"qty": ("sum", "l_quantity")}, keep_empty=True)


@query("bucket_metrics", """
SELECT o_orderpriority AS priority, COUNT(*) AS doc_count, ROUND(SUM(o_totalprice), 2) AS total,
  ROUND(AVG(o_totalprice), 3) AS mean, MIN(o_totalprice) AS least, MAX(o_totalprice) AS most,
  COUNT(o_custkey) AS n, COUNT(DISTINCT o_custkey) AS customers
FROM orders GROUP BY o_orderpriority
""")
def bucket_metrics(spark, sf):
    out = bucket_agg(table(spark, sf, "orders"), [Terms("priority", "o_orderpriority")], {
        "total": ("sum", "o_totalprice"), "mean": ("avg", "o_totalprice"), "least": ("min", "o_totalprice"),
        "most": ("max", "o_totalprice"), "n": ("count", "o_custkey"),
        "customers": ("exact_cardinality", "o_custkey"),
    })
    return out.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 3)})


@query("bucket_approximate", """
SELECT o_orderstatus AS status, COUNT(*) AS doc_count, true AS customers_close, true AS median_close
FROM orders GROUP BY o_orderstatus
""")
def bucket_approximate(spark, sf):
    """Approximate measures against exact ones, within 10 percent."""
    orders, levels = table(spark, sf, "orders"), [Terms("status", "o_orderstatus")]
    about = bucket_agg(orders, levels, {
        "about": ("cardinality", "o_custkey"), "middle": ("percentile", "o_totalprice", 0.5),
        "mean": ("avg", "o_totalprice"),
    })
    exact = bucket_agg(orders, levels, {"exact": ("exact_cardinality", "o_custkey")}).drop("doc_count")
    close = lambda a, b: F.abs(F.col(a) / F.col(b) - 1) < 0.1
    return about.join(exact, "status").select(
        "status", "doc_count", close("about", "exact").alias("customers_close"),
        close("middle", "mean").alias("median_close"),
    )


@query("bucket_stats", """
SELECT event_type, 'v.' || m AS metric_field, ROUND(x, 3) AS metric FROM (
  SELECT event_type, CAST(COUNT(value) AS DOUBLE) AS count, MIN(value) AS min, MAX(value) AS max, AVG(value) AS avg,
    SUM(value) AS sum FROM events GROUP BY event_type)
UNPIVOT (x FOR m IN (count, min, max, avg, sum))
""")
def bucket_stats(spark, sf):
    """Several values of one metric stay nested and are selected by pattern."""
    stats = bucket_agg(table(spark, sf, "events"), [Terms("event_type", "event_type")], {"v": ("stats", "value")})
    out = flat(to_metrics(stats, "stats", "v.*", ["event_type"]))
    return out.withColumn("metric", F.round("metric", 3))


@query("bucket_keep_empty", """
SELECT c.c_mktsegment AS segment, c.c_custkey AS customer, o.o_orderstatus AS status, COUNT(*) AS doc_count,
  ROUND(SUM(o.o_totalprice), 2) AS total
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY ALL
""")
def bucket_keep_empty(spark, sf):
    """Customers without orders have no status bucket and are records of their own."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    joined = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    levels = [Terms("segment", "c_mktsegment"), Terms("customer", "c_custkey"), Terms("status", "o_orderstatus")]
    out = bucket_agg(joined, levels, {"total": ("sum", "o_totalprice")}, keep_empty=True)
    return out.withColumn("total", F.round("total", 2))


@query("bucket_keep_empty_mixed", """
WITH d AS (SELECT d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 1),
g AS (SELECT source, quality, COUNT(*) AS doc_count FROM d GROUP BY ALL)
SELECT * FROM g WHERE quality IS NOT NULL
UNION ALL SELECT * FROM g WHERE quality IS NULL AND source NOT IN (SELECT source FROM g WHERE quality IS NOT NULL)
""")
def bucket_keep_empty_mixed(spark, sf):
    """Documents without a label count only for sources that have no label at all."""
    labels = table(spark, sf, "labels").withColumn("doc_id", F.when(F.col("toxic") == 1, F.col("doc_id")).otherwise(-1 - F.col("doc_id")))
    docs = table(spark, sf, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return bucket_agg(docs, [Terms("source", "source"), Terms("quality", "quality")], keep_empty=True)


@query("bucket_date_histogram", """
SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS at, event_type AS kind, COUNT(*) AS doc_count,
  ROUND(SUM(value), 2) AS total FROM events GROUP BY ALL
""")
def bucket_date_histogram(spark, sf):
    levels = [DateHistogram("at", "ts", "6h"), Terms("kind", "event_type")]
    out = bucket_agg(table(spark, sf, "events"), levels, {"total": ("sum", "value")})
    return out.withColumn("total", F.round("total", 2))


@query("bucket_calendar_histogram", """
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, COUNT(*) AS doc_count FROM orders GROUP BY ALL
""")
def bucket_calendar_histogram(spark, sf):
    out = bucket_agg(table(spark, sf, "orders"), [DateHistogram("month", "o_orderdate", "month")])
    return out.withColumn("month", F.col("month").cast("timestamp_ntz"))


@query("bucket_histogram", """
SELECT floor(l_extendedprice / 5000) * 5000 AS price, COUNT(*) AS doc_count, SUM(l_quantity) AS qty
FROM lineitem GROUP BY ALL
""")
def bucket_histogram(spark, sf):
    return bucket_agg(
        table(spark, sf, "lineitem"), [Histogram("price", "l_extendedprice", 5000)], {"qty": ("sum", "l_quantity")}
    )


@query("agg_root", """
SELECT 'qty.value' AS metric_field, SUM(l_quantity) AS metric FROM lineitem
UNION ALL SELECT 'price.value', ROUND(SUM(l_extendedprice), 2) FROM lineitem
""")
def agg_root(spark, sf):
    record = root_agg(table(spark, sf, "lineitem"), {
        "qty": ("sum", "l_quantity"), "price": ("sum", "l_extendedprice"),
    })
    return flat(to_metrics(record, "totals", ["qty.value", "price.*"])).withColumn("metric", F.round("metric", 2))


@query("flatten_buckets", """
SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status, CAST(2 AS BIGINT) AS doc_count,
  o_totalprice AS total FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_orderpriority, NULL, CAST(3 AS BIGINT), NULL FROM orders WHERE o_orderstatus = 'P'
""")
def flatten_bucket_json(spark, sf):
    """One aggregation document per order; pending ones have an empty list of child buckets."""
    child = F.struct(
        F.col("o_orderstatus").alias("key"), F.lit(2).alias("doc_count"),
        F.struct(F.col("o_totalprice").alias("value")).alias("total"),
    )
    children = F.when(F.col("o_orderstatus") != "P", F.array(child)).otherwise(F.array().cast(
        "array<struct<key:string,doc_count:int,total:struct<value:double>>>"
    ))
    bucket = F.struct(F.lit(3).alias("doc_count"), F.struct(children.alias("buckets")).alias("status"))
    doc = F.struct(F.struct(F.create_map("o_orderpriority", bucket).alias("buckets")).alias("priority"))
    docs = table(spark, sf, "orders").select("o_orderkey", F.to_json(doc).alias("doc"))
    levels = [BucketLevel("priority", named=True), BucketLevel("status")]
    return flatten_buckets(docs, "doc", levels, {"total": "double"}, ids=["o_orderkey"])


@query("gauge_rows", """
SELECT 'shop.' || event_type AS instrument, value, user_id AS "attributes.user_id", 'eu' AS "attributes.zone",
  'value' AS "attributes.sample", ts AS metric_ts FROM events
""")
def gauges(spark, sf):
    frame = to_metrics(table(spark, sf, "events"), F.col("event_type"), "value", ["user_id"], ts="ts")
    return flatten(gauge_rows(frame, "shop", "sample", {"zone": "eu"}))


@query("gauge_last_value", """
SELECT 'shop.' || event_type AS instrument, user_id, 'value' AS sample_name, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY event_type, user_id
""")
def gauge_last_value(spark, sf):
    frame = to_metrics(
        table(spark, sf, "events"), F.col("event_type"), "value", ["user_id"], ts="ts", seq="event_id"
    )
    latest = last_value(gauge_rows(frame, "shop"), ["instrument", "attributes"], "value", ["metric_ts", "seq"])
    return latest.select("instrument", "attributes.user_id", "attributes.sample_name", "value")


@query("gauge_last_hot_series", """
SELECT l_returnflag, l_linestatus, arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS price
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def gauge_last_hot_series(spark, sf):
    """A few series holding all rows."""
    items = table(spark, sf, "lineitem").withColumnRenamed("l_extendedprice", "price")
    return last_value(
        items, ["l_returnflag", "l_linestatus"], "price", ["l_orderkey", "l_linenumber", "l_partkey", "price"]
    )


@query("bucket_terms_frequent", """
SELECT l_orderkey AS "order", COUNT(*) AS doc_count, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey
ORDER BY doc_count DESC, "order" LIMIT 10
""")
def bucket_terms_frequent(spark, sf):
    """Top buckets of a column of very many values, of nearly equal counts; a small sketch leaves many cells open."""
    return frequent_buckets(table(spark, sf, "lineitem"), Terms("order", "l_orderkey", top_n=10), {"qty": ("sum", "l_quantity")}, tracked=256, cells=4096)


@query("bucket_terms_frequent_skewed", """
SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id * user_id END AS who, COUNT(*) AS doc_count FROM events GROUP BY ALL
ORDER BY doc_count DESC, who LIMIT 3
""")
def bucket_terms_frequent_skewed(spark, sf):
    """One value has a third of all rows."""
    who = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id * user_id END"
    return frequent_buckets(table(spark, sf, "events"), Terms("who", who, top_n=3), tracked=64, cells=1024)
