"""Queries over filters, routing, mapping, lookups and user transforms."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from meterflow.operators.filters import simple_filter
from meterflow.operators.flatten import flatten, known_keys, set_field
from meterflow.operators.lookup import enrich, missing_keys
from meterflow.operators.mapping import map_values
from meterflow.operators.normalize import to_metrics
from meterflow.operators.overlay import overlay
from meterflow.operators.routing import Route, route, unmatched_routes
from meterflow.operators.rows import transform_batches, transform_frame, transform_groups, transform_rows
from meterflow.operators.versions import enrich_as_of
from meterflow.plans.flow import Transform, apply_by_priority
from meterflow.plans.templates import repeat_query
from meterflow.queries.registry import flat, query, table

_EVENTS = "SELECT event_id, event_type, 'value' AS metric_field, value AS metric FROM events WHERE "
_ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, 'o_totalprice' AS metric_field, o_totalprice AS metric FROM orders WHERE "
_LABELS = "SELECT d.doc_id, quality, 'n_chars' AS metric_field, n_chars AS metric FROM documents d LEFT JOIN labels l USING (doc_id) WHERE "


def _events(spark, sf):
    return to_metrics(table(spark, sf, "events"), "events", "value", ["event_id", "event_type"])


def _orders(spark, sf):
    return to_metrics(
        table(spark, sf, "orders"), "orders", "o_totalprice", ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    )


def _labels(spark, sf):
    """Documents with their quality label, which most lack."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left")
    return to_metrics(docs, "documents", "n_chars")


@query("filter_lt", _EVENTS + "value < 50.5")
def filter_lt(spark, sf):
    return flat(simple_filter(_events(spark, sf), "lt 50.5"))


@query("filter_le", _EVENTS + "value <= 25")
def filter_le(spark, sf):
    return flat(simple_filter(_events(spark, sf), "le 25 metric"))


@query("filter_eq", _ORDERS + "o_orderstatus = 'P'")
def filter_eq(spark, sf):
    return flat(simple_filter(_orders(spark, sf), "eq P o_orderstatus"))


@query("filter_ne", _LABELS + "quality IS DISTINCT FROM 1")
def filter_ne(spark, sf):
    return flat(simple_filter(_labels(spark, sf), "ne 1 quality"))


@query("filter_ge", _ORDERS + "o_totalprice >= 150000")
def filter_ge(spark, sf):
    return flat(simple_filter(_orders(spark, sf), "ge 150000 o_totalprice"))


@query("filter_gt", _LABELS + "n_chars > 2000")
def filter_gt(spark, sf):
    return flat(simple_filter(_labels(spark, sf), "gt 2000"))


@query("filter_in", _ORDERS + "contains(o_orderpriority, 'URG')")
def filter_in(spark, sf):
    return flat(simple_filter(_orders(spark, sf), "in URG o_orderpriority"))


@query("filter_nn", _LABELS + "quality IS NOT NULL")
def filter_nn(spark, sf):
    return flat(simple_filter(_labels(spark, sf), "nn _ quality"))


@query("filter_drop", _LABELS + "quality IS NULL OR NOT quality >= 1")
def filter_drop(spark, sf):
    return flat(simple_filter(_labels(spark, sf), "ge 1 quality", mode="drop"))


@query("filter_chain", _EVENTS + "value > 1 AND NOT value > 2")
def filter_chain(spark, sf):
    return flat(simple_filter(simple_filter(_events(spark, sf), "gt 1"), "gt 2", mode="drop"))


_ROUTED = "SELECT input_name, task_name, event_id, 'value' AS metric_field, value AS metric FROM " \
    "(SELECT *, 'Src-' || (user_id % 3) AS input_name, event_type AS task_name FROM events) WHERE "


def _routed(spark, sf):
    """All event types in one table: the type is the task, a third of the users each an input."""
    source = F.concat(F.lit("Src-"), (F.col("user_id") % 3).cast("string"))
    return to_metrics(
        table(spark, sf, "events"), F.col("event_type"), "value", ["event_id"], input_name=source
    )


@query("route_include", _ROUTED + "task_name LIKE 'c%' OR task_name LIKE '%i_n%p'")
def route_include(spark, sf):
    return flat(route(_routed(spark, sf), include_tasks=["C*", "*i?n*p"]), "input_name", "task_name")


@query("route_exclude", _ROUTED + "NOT (task_name = 'error' OR task_name LIKE 'v%')")
def route_exclude(spark, sf):
    return flat(route(_routed(spark, sf), exclude_tasks=["error", "v*"]), "input_name", "task_name")


@query("route_combined", _ROUTED + "task_name <> 'view' AND input_name IN ('Src-0', 'Src-2')")
def route_combined(spark, sf):
    return flat(route(_routed(spark, sf), exclude_tasks="view", include_inputs="src-[02]"), "input_name", "task_name")


@query("route_unmatched", """
SELECT * FROM (VALUES ('task', 'refund*'), ('input', 'src-[7-9]'), ('task', 'views')) t(side, pattern)
""")
def route_unmatched(spark, sf):
    routes = [
        Route(include_tasks=["refund*", "v*"], include_inputs="src-[7-9]"),
        Route(exclude_tasks=["views", "*gn*"], exclude_inputs="src-?"),
    ]
    return unmatched_routes(_routed(spark, sf), *routes)


@query("priority_chain", """
WITH e AS (SELECT event_id, event_type AS task_name, value AS v FROM events),
a AS (SELECT event_id, task_name, CASE WHEN task_name = 'view' THEN v * 10 ELSE v END AS v FROM e),
b AS (SELECT * FROM a WHERE v > 30),
c AS (SELECT event_id, task_name, v + 1 AS v FROM b)
SELECT task_name, event_id, 'value' AS metric_field, CASE WHEN task_name = 'click' THEN -v ELSE v END AS metric FROM c
""")
def priority_chain(spark, sf):
    steps = [
        Transform(partial(transform_rows, values={"metric": "metric + 1"})),
        Transform(partial(transform_rows, values={"metric": "-metric"}), Route(include_tasks="click"), -5),
        Transform(partial(simple_filter, cond="gt 30"), priority=10),
        Transform(partial(transform_rows, values={"metric": "metric * 10"}), Route(include_tasks="vi*"), 20),
        Transform(partial(simple_filter, cond="lt 0"), enabled=False, priority=30),
    ]
    return flat(apply_by_priority(_routed(spark, sf), steps), "task_name")


@query("map_default", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'P' THEN NULL ELSE 'unknown' END AS o_orderstatus,
  o_orderpriority, 'o_totalprice' AS metric_field, o_totalprice AS metric FROM orders
""")
def map_default(spark, sf):
    return flat(map_values(_orders(spark, sf), {"O": "open", "P": None}, "o_orderstatus", default="unknown"))


@query("map_metric", """
SELECT p_partkey, p_type, 'p_size' AS metric_field,
  CASE p_size WHEN 1 THEN 'hello' WHEN 2 THEN 'world' ELSE 'unknown' END AS metric FROM part
""")
def map_metric(spark, sf):
    frame = to_metrics(table(spark, sf, "part"), "parts", "p_size", ["p_partkey", "p_type"])
    return flat(map_values(frame, {1: "hello", 2.0: "world"}, "p_size", default="unknown"))


@query("map_cast", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2) THEN 10 * l_linenumber ELSE -1 END AS code,
  'l_quantity' AS metric_field, l_quantity AS metric FROM lineitem
""")
def map_cast(spark, sf):
    frame = to_metrics(table(spark, sf, "lineitem"), "items", "l_quantity", ["l_orderkey", "l_linenumber"])
    return flat(map_values(frame, {"1": 10, "2": 20}, "l_linenumber", "code", cast="str", default=-1))


@query("map_original", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' ELSE o_orderstatus END AS o_orderstatus,
  o_orderpriority, 'o_totalprice' AS metric_field, o_totalprice AS metric FROM orders
""")
def map_original(spark, sf):
    return flat(map_values(_orders(spark, sf), {"O": "open", "F": "final"}, "o_orderstatus", missing="original"))


@query("map_casted", """
SELECT o_orderkey, o_orderstatus, o_orderpriority,
  CASE CAST(trunc(o_totalprice) AS BIGINT) WHEN 1000 THEN -1 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS whole,
  'o_totalprice' AS metric_field, o_totalprice AS metric FROM orders
""")
def map_casted(spark, sf):
    return flat(map_values(
        _orders(spark, sf), {1000: -1}, "o_totalprice", "whole", cast="int", missing="original_casted"
    ))


@query("map_nothing", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
  o_orderpriority, 'o_totalprice' AS metric_field, o_totalprice AS metric FROM orders
""")
def map_nothing(spark, sf):
    return flat(map_values(_orders(spark, sf), {"P": None, "O": "open"}, "o_orderstatus", missing="nothing"))


@query("map_table", """
SELECT c.c_custkey, c.c_nationkey, coalesce(n.n_name, 'nowhere') AS nation, 'c_acctbal' AS metric_field,
  c.c_acctbal AS metric FROM customer c LEFT JOIN nation n
  ON c.c_nationkey = n.n_nationkey AND n.n_regionkey <> 3
""")
def map_table(spark, sf):
    """A mapping held in a table is joined."""
    # keys of one region are moved away, so customers there have no entry
    key = F.col("n_nationkey") + F.when(F.col("n_regionkey") == 3, 1000).otherwise(0)
    mapping = table(spark, sf, "nation").select(key.alias("key"), F.col("n_name").alias("value"))
    frame = to_metrics(table(spark, sf, "customer"), "customers", "c_acctbal", ["c_custkey", "c_nationkey"])
    return flat(map_values(frame, mapping, "c_nationkey", "nation", default="nowhere"))


@query("lookup_enrich", """
SELECT e.event_id, e.user_id, 'value' AS metric_field, e.value AS metric,
  c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def lookup_enrich(spark, sf):
    frame = to_metrics(table(spark, sf, "events"), "events", "value", ["event_id", "user_id"])
    return flat(enrich(frame, table(spark, sf, "customer"), "user_id", "c_custkey"))


@query("lookup_defaults", """
SELECT d.doc_id, d.lang, 'n_chars' AS metric_field, d.n_chars AS metric,
  CASE WHEN coalesce(l.quality, 0) = 0 THEN -1 ELSE l.quality END AS quality,
  CASE WHEN coalesce(l.toxic, 0) = 0 THEN NULL ELSE l.toxic END AS toxic, 'none' AS reviewer
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def lookup_defaults(spark, sf):
    frame = to_metrics(table(spark, sf, "documents"), "documents", "n_chars", ["doc_id", "lang"])
    return flat(enrich(
        frame, table(spark, sf, "labels"), "doc_id", "doc_id", include=["quality", "toxic", "reviewer"],
        defaults={"quality": -1, "reviewer": "none"},
    ))


@query("lookup_b64key", """
SELECT c.c_custkey, repeat(c.c_name || 'é?', 5) AS label, 'c_acctbal' AS metric_field, c.c_acctbal AS metric, o.n_orders
FROM customer c LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey
""")
def lookup_b64key(spark, sf):
    """Keys of about 100 characters, stored under their URL-safe encoding."""
    label = F.repeat(F.concat("c_name", F.lit("é?")), 5)
    customers = table(spark, sf, "customer")
    frame = to_metrics(customers.withColumn("label", label), "customers", "c_acctbal", ["c_custkey", "label"])
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    names = customers.select("c_custkey", F.expr("translate(replace(base64(encode(repeat(concat(c_name, 'é?'), 5), 'UTF-8')), '\\r\\n', ''), '+/', '-_')").alias("id"))
    dim = counts.join(names, counts.o_custkey == names.c_custkey).select("id", "n_orders")
    return flat(enrich(frame, dim, "label", "id", encode="b64url"))


@query("lookup_missing", """
SELECT d.doc_id, d.lang, 'n_chars' AS metric_field, d.n_chars AS metric FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def lookup_missing(spark, sf):
    frame = to_metrics(table(spark, sf, "documents"), "documents", "n_chars", ["doc_id", "lang"])
    return flat(missing_keys(frame, table(spark, sf, "labels"), "doc_id", "doc_id"))


@query("lookup_salted", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, 'l_quantity' AS metric_field, l.l_quantity AS metric,
  p.p_brand, p.p_size FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")
def lookup_salted(spark, sf):
    frame = to_metrics(table(spark, sf, "lineitem"), "items", "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey"])
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return flat(enrich(frame, part, "l_partkey", "p_partkey", salts=4))


@query("template_union", """
SELECT 'count_0' AS task_name, 0 AS task_index, COUNT(*) AS files, 'nation' AS tag FROM nation
UNION ALL SELECT 'count_1', 1, COUNT(*), 'region' FROM region
UNION ALL SELECT 'count_2', 2, COUNT(*), 'customer' FROM customer
""")
def template_union(spark, sf):
    names = ["nation", "region", "customer"]
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(name)
    return repeat_query(
        spark, "SELECT COUNT(*) AS files, :t AS tag FROM IDENTIFIER(:t)", {"t": names}, task="count_$i"
    )


@query("overlay_by_name", """
SELECT coalesce(s.s_suppkey, c.c_custkey) AS name, coalesce(c.c_name, s.s_name) AS label,
  s.s_acctbal AS "info.s_acctbal", coalesce(c.c_nationkey, s.s_nationkey) AS "info.nation",
  c.c_mktsegment AS "info.segment"
FROM supplier s FULL OUTER JOIN customer c ON s.s_suppkey = c.c_custkey
""")
def overlay_by_name(spark, sf):
    base = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("name"), F.col("s_name").alias("label"),
        F.struct("s_acctbal", F.col("s_nationkey").alias("nation")).alias("info"),
    )
    extension = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("name"), F.col("c_name").alias("label"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("info"),
    )
    return flatten(overlay(base, extension))


@query("udf_metric", """
SELECT p_partkey, CAST(p_partkey * 31 % 97 AS BIGINT) AS code, 'p_retailprice' AS metric_field,
  floor(p_retailprice) * 2 AS metric FROM part
""")
def udf_metric(spark, sf):
    """Python over Arrow batches; code without a built-in equivalent would go here."""
    parts = to_metrics(table(spark, sf, "part"), "parts", "p_retailprice", ["p_partkey"])
    rows = flat(parts).withColumn("code", F.lit(0).cast("bigint"))

    def score(batch):
        return batch.assign(code=batch["p_partkey"] * 31 % 97, metric=batch["metric"] // 1 * 2)

    return transform_batches(rows, score)


@query("expr_metric", """
SELECT event_id, event_type, CAST(123 AS BIGINT) AS "field.nested", value * 2 AS "field.double", 'value' AS metric_field,
  round(value, 1) AS metric FROM events
""")
def expr_metric(spark, sf):
    return flat(transform_rows(_events(spark, sf), {
        "field": "named_struct('nested', 123L)",
        "field.double": "metric * 2",
        "metric": "round(metric, 1)",
    }))


@query("udf_frame", """
SELECT role, 'n_chars' AS metric_field, CAST(length(text) AS BIGINT) AS metric, 'turn' AS kind FROM conversations
WHERE role <> 'system'
UNION ALL SELECT role, 'turns', COUNT(*), 'total' FROM conversations GROUP BY role
""")
def udf_frame(spark, sf):
    """A frame function that removes rows and adds totals."""
    turns = table(spark, sf, "conversations").withColumn("n_chars", F.length("text").cast("bigint"))
    rows = flat(to_metrics(turns, "turns", "n_chars", ["role"])).withColumn("kind", F.lit("turn"))

    def rebuild(df):
        totals = df.groupBy("role").agg(F.count("*").alias("metric"))
        totals = totals.withColumns({"metric_field": F.lit("turns"), "kind": F.lit("total")})
        return df.where("role <> 'system'").unionByName(totals)

    return transform_frame(rows, rebuild)


_AS_OF_SQL = """
WITH e AS (SELECT event_id, ts, value, event_type, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS who FROM events),
p AS (SELECT who, ts AS since, value AS paid, event_id AS purchase FROM e WHERE event_type = 'purchase')
"""


def _with_hot_user(spark, sf):
    """Events of which a third belong to one user, and purchases as the versions of a user's document."""
    events = table(spark, sf, "events").withColumn("who", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    purchases = events.where("event_type = 'purchase'").select("who", F.col("ts").alias("since"), F.col("value").alias("paid"), F.col("event_id").alias("purchase"))
    return to_metrics(events, "events", "value", ["event_id", "who"], ts="ts"), purchases


@query("lookup_as_of", _AS_OF_SQL + """
SELECT e.event_id, e.who, 'value' AS metric_field, e.value AS metric, p.paid, p.purchase
FROM e ASOF LEFT JOIN p ON e.who = p.who AND e.ts >= p.since
""")
def lookup_as_of(spark, sf):
    """Every event with the last purchase of its user; one user has a third of all rows."""
    frame, purchases = _with_hot_user(spark, sf)
    return flat(enrich_as_of(frame, purchases, "who", "who", "since"))


@query("lookup_as_of_ended", _AS_OF_SQL + """
SELECT e.event_id, e.who, 'value' AS metric_field, e.value AS metric, CASE WHEN p.since + INTERVAL 6 HOUR > e.ts THEN p.paid ELSE -1 END AS paid
FROM e ASOF LEFT JOIN p ON e.who = p.who AND e.ts >= p.since
""")
def lookup_as_of_ended(spark, sf):
    """A version counts for six hours."""
    frame, purchases = _with_hot_user(spark, sf)
    ending = purchases.withColumn("until", F.col("since") + F.expr("INTERVAL 6 HOURS"))
    return flat(enrich_as_of(frame, ending, "who", "who", "since", valid_to="until", include=["paid"], defaults={"paid": -1.0}, falsy_as_missing=False))


_MAP_ATTRIBUTE_SQL = """
SELECT event_id, event_type, 'value' AS metric_field, value AS metric, {shown} AS shown,
  MAP {{'kind': event_type, 'user': CAST(user_id AS VARCHAR)}}['kind'] AS kind FROM events
"""


def _map_frame(spark, sf):
    tags = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    events = table(spark, sf, "events").withColumn("tags", tags)
    return to_metrics(events, "events", "value", ["event_id", "event_type", "tags"])


def _mapped_with_map(spark, sf, keys):
    mapping = {"error": "bad", **{f"other-{i}": str(i) for i in range(keys - 1)}}
    mapped = map_values(_map_frame(spark, sf), mapping, "event_type", "shown", default="fine")
    return mapped.select("attributes.event_id", "attributes.event_type", "metric_field", "metric", "attributes.shown", F.col("attributes.tags")["kind"].alias("kind"))


@query("map_with_map_attribute", _MAP_ATTRIBUTE_SQL.format(shown="CASE event_type WHEN 'error' THEN 'bad' ELSE 'fine' END"))
def map_with_map_attribute(spark, sf):
    """Three keys on rows that hold a map."""
    return _mapped_with_map(spark, sf, 3)


@query("map_large_with_map_attribute", _MAP_ATTRIBUTE_SQL.format(shown="CASE event_type WHEN 'error' THEN 'bad' ELSE 'fine' END"))
def map_large_with_map_attribute(spark, sf):
    """The same values by 301 keys."""
    return _mapped_with_map(spark, sf, 301)


@query("lookup_with_map_attribute", """
SELECT e.event_id, 'value' AS metric_field, e.value AS metric, e.event_type AS kind, c.c_name, c.c_mktsegment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def lookup_with_map_attribute(spark, sf):
    """A lookup by a value out of a map, with salted keys."""
    frame = _map_frame(spark, sf)
    frame = set_field(frame, "user", F.col("attributes.tags")["user"].cast("bigint"))
    found = enrich(frame, table(spark, sf, "customer").drop("c_nationkey", "c_acctbal"), "user", "c_custkey", salts=3)
    return found.select("attributes.event_id", "metric_field", "metric", F.col("attributes.tags")["kind"].alias("kind"), "attributes.c_name", "attributes.c_mktsegment")


@query("udf_frame_groups", """
SELECT event_id, 'value' AS metric_field, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS DOUBLE) AS metric, user_id
FROM events QUALIFY metric <= 3
""")
def udf_frame_groups(spark, sf):
    """Python over each user's frame: the three largest values by their ranks."""
    frame = to_metrics(table(spark, sf, "events"), "events", "value", ["event_id", "user_id"])

    def ranked(rows):
        ids = rows["attributes"].map(lambda a: a["event_id"])
        rows = rows.assign(_id=ids).sort_values(["metric", "_id"], ascending=[False, True]).head(3)
        return rows.assign(metric=[float(k + 1) for k in range(len(rows))]).drop(columns="_id")

    found = transform_groups(frame, [F.col("attributes.user_id")], ranked)
    return found.select("attributes.event_id", "metric_field", "metric", "attributes.user_id")


@query("flatten_maps", """
SELECT event_id, event_type AS "tags.kind", CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS "tags.user" FROM events
""")
def flatten_maps(spark, sf):
    """Maps as columns of the keys they have."""
    kind = F.create_map(F.lit("kind"), F.col("event_type"))
    both = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, both).otherwise(kind).alias("tags"))
    return flatten(rows, maps={"tags": known_keys(rows, "tags")})
