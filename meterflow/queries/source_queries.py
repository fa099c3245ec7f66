"""Queries over the record sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterflow.operators.flatten import flatten
from meterflow.operators.normalize import to_metrics
from meterflow.operators.filters import text_match
from meterflow.queries.registry import flat, query, table
from meterflow.operators.buckets import Terms
from meterflow.sources.generated import with_random
from meterflow.sources.payloads import json_records, text_records
from meterflow.sources.reports import glob_filter, unpivot_report
from meterflow.sources.search import search, search_buckets, search_count
from meterflow.sources.sql import sql_source
from meterflow.sources.summaries import level_summary, run_summaries, run_summary

GROUP_COUNT = "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus"
SUM_COUNT = """
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS qty, ROUND(SUM(l_extendedprice), 2) AS price,
       COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""


@query("sql_group_count", GROUP_COUNT)
def sql_group_count(spark, sf):
    return sql_source(spark, GROUP_COUNT, tables={"orders": table(spark, sf, "orders")})


@query("sql_sum_count", SUM_COUNT)
def sql_sum_count(spark, sf):
    return sql_source(spark, SUM_COUNT, tables={"lineitem": table(spark, sf, "lineitem")})


@query("sql_args", """
SELECT o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 GROUP BY o_orderpriority
""")
def sql_args(spark, sf):
    text = """
        SELECT o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
        WHERE o_orderstatus = :status AND o_totalprice >= :least GROUP BY o_orderpriority
    """
    args = {"status": "F", "least": 1000}
    return sql_source(spark, text, args, {"orders": table(spark, sf, "orders")})


@query("search_documents", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE lang = 'en' AND n_chars > 500 AND source <> 'src7'
""")
def search_documents(spark, sf):
    docs = table(spark, sf, "documents")
    hits = search(docs, ["lang = 'en'", F.col("n_chars") > 500, F.col("source") != "src7"])
    return hits.select("doc_id", "lang", "source", "n_chars")


@query("search_documents_size", """
SELECT CAST(doc_id AS VARCHAR) AS "_id", source AS "_source.source", n_chars AS "_source.n_chars"
FROM documents WHERE lang = 'en' ORDER BY n_chars DESC, doc_id LIMIT 50
""")
def search_documents_size(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    hits = search(docs, ["lang = 'en'"], size=50, order_by=[F.desc("n_chars"), "doc_id"], id_column="doc_id")
    return flatten(hits).select("_id", "`_source.source`", "`_source.n_chars`")


@query("search_timerange_buckets", """
SELECT event_type, COUNT(*) AS doc_count, ROUND(SUM(value), 2) AS total FROM events
WHERE user_id >= 10 AND ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 11:30:00'
GROUP BY event_type
""")
def search_timerange_buckets(spark, sf):
    found = search_buckets(
        table(spark, sf, "events"),
        [Terms("event_type", "event_type")],
        {"total": ("sum", "value")},
        conditions=["user_id >= 10"],
        timerange={
            "start": "now/d-7d", "end": "now/h-30m", "ts": "ts", "anchor": dt.datetime(2024, 1, 15, 12, 34, 56),
        },
    )
    return found.withColumn("total", F.round("total", 2))


@query("search_count", "SELECT COUNT(*) AS metric FROM events WHERE event_type = 'error' AND value > 20")
def count_matches(spark, sf):
    return search_count(table(spark, sf, "events"), "event_type = 'error' AND value > 20")


_WORD = r"regexp_matches({c}, '(?i)(^|[^\p{{L}}\p{{N}}])({w})($|[^\p{{L}}\p{{N}}])')"


@query("text_match", f"""
SELECT doc_id, lang, n_chars FROM documents
WHERE {_WORD.format(c='text', w='the|LICENSE|dans')}
""")
def text_match_any(spark, sf):
    docs = text_match(table(spark, sf, "documents"), "text", "the LICENSE dans")
    return docs.select("doc_id", "lang", "n_chars")


@query("text_match_all", f"""
SELECT item_id, text FROM benchmark
WHERE {_WORD.format(c='text', w='the')} AND {_WORD.format(c='text', w='and')}
""")
def text_match_all(spark, sf):
    return text_match(table(spark, sf, "benchmark"), ["text"], ["the", "and"], mode="all")


@query("json_records", """
SELECT event_id, 'k' AS metric_field, CAST(json_extract_string(props, '$.k') AS BIGINT) AS metric FROM events
""")
def json_props(spark, sf):
    records = json_records(table(spark, sf, "events"), "props", "k BIGINT", keep=["event_id"])
    return flat(to_metrics(records, "props", "k", drop_absent=True))


@query("json_records_inferred", """
SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n FROM conversations
""")
def json_records_inferred(spark, sf):
    """Documents holding a list of objects, with the type derived from the data."""
    turns = table(spark, sf, "conversations")
    records = F.array(F.struct("turn", "role", F.length("text").cast("bigint").alias("n")))
    docs = turns.select("conv_id", F.to_json(records).alias("doc"))
    return json_records(docs, "doc", keep=["conv_id"]).select("conv_id", "turn", "role", "n")


@query("raw_text_records", """
SELECT page_id, html AS message, CAST(NULL AS VARCHAR) AS metric_field, CAST(NULL AS DOUBLE) AS metric FROM pages
""")
def raw_text_records(spark, sf):
    records = text_records(table(spark, sf, "pages"), "html", keep=["page_id"])
    return flat(to_metrics(records, "raw", None, allow_none=True))


@query("path_glob_filter", r"""
SELECT page_id, url FROM pages
WHERE (regexp_full_match(url, 'https://[^/]*/en/[^/]*') OR regexp_full_match(url, 'http://blog\.[^/]*/[^/][^/]/[^/]*'))
  AND NOT regexp_full_match(url, '(?s).*#top') AND NOT regexp_full_match(url, '(?s).*utm_[st].*')
""")
def path_glob_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return glob_filter(pages, "url", ["https://*/en/*", "http://blog.*/??/*"], ["*#top", "*utm_[st]*"])


@query("report_unpivot", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_returnflag, '{m}' AS metric_key, {m} AS metric FROM lineitem"
    for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
))
def report_unpivot(spark, sf):
    return unpivot_report(
        table(spark, sf, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["l_orderkey", "l_linenumber", "l_returnflag"],
    )


@query("report_unpivot_patterns", r"""
WITH p AS (SELECT *, '/' || p_brand || '/' || p_type AS path FROM part),
hit AS (
  SELECT *, '/Brand#1*/*' AS pattern FROM p WHERE regexp_full_match(path, '/Brand#1[^/]*/[^/]*')
  UNION ALL SELECT *, '/*/SMALL' AS pattern FROM p WHERE regexp_full_match(path, '/[^/]*/SMALL'))
SELECT p_partkey, p_type, pattern, 'p_size' AS metric_key, CAST(p_size AS DOUBLE) AS metric FROM hit
WHERE NOT regexp_full_match(path, '.*ECONOMY')
UNION ALL SELECT p_partkey, p_type, pattern, 'p_retailprice', p_retailprice FROM hit
WHERE NOT regexp_full_match(path, '.*ECONOMY')
""")
def report_unpivot_patterns(spark, sf):
    part = table(spark, sf, "part").withColumn("path", F.concat(F.lit("/"), "p_brand", F.lit("/"), "p_type"))
    return unpivot_report(
        part, ["p_size", "p_retailprice"], ["p_partkey", "p_type", "pattern"],
        path="path", patterns=["/Brand#1*/*", "/*/SMALL"], skip=["*ECONOMY"],
    )


@query("random_metrics", """
SELECT event_type, 'demo' AS origin, COUNT(*) AS n, COUNT(*) AS n_in_range FROM events GROUP BY event_type
""")
def random_metrics(spark, sf):
    """One draw per event; the values differ, their number and range do not."""
    drawn = with_random(table(spark, sf, "events"), lo=-5, hi=20, seed=11, attributes={"origin": "demo"})
    return drawn.groupBy("event_type", "origin").agg(
        F.count("*").alias("n"), F.count_if((F.col("metric") >= -5) & (F.col("metric") < 20)).alias("n_in_range")
    )


_RUNS = """
SELECT ts AS started_at,
  CASE WHEN user_id % 7 = 0 THEN NULL ELSE ts + (user_id % 50) * INTERVAL 1 MINUTE END AS finished_at,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'okay' WHEN 'click' THEN 'okay' ELSE 'other' END AS result
FROM events
"""


def _runs(spark, sf):
    """A run log derived from the events: some runs are pending and none is skipped."""
    minutes = (F.col("user_id") % 50).cast("int")
    done = F.when(F.col("user_id") % 7 != 0, F.timestamp_add("MINUTE", minutes, F.col("ts")))
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type").isin("view", "click"), "okay")
    return table(spark, sf, "events").select(
        F.col("ts").alias("started_at"), done.alias("finished_at"), kind.otherwise("other").alias("result")
    )


@query("run_result_summary", f"""
WITH r AS ({_RUNS}),
i AS (SELECT * FROM r WHERE finished_at >= TIMESTAMP '2024-01-03 06:00:00' AND finished_at < TIMESTAMP '2024-01-21 18:30:00'),
k AS (SELECT unnest(['okay', 'skipped', 'failed']) AS result)
SELECT k.result, 'task_result' AS metric_type,
  (SELECT COUNT(*) FROM i WHERE i.result = k.result) AS metric,
  TIMESTAMP '2024-01-03 06:00:00' AS timestamp_from, TIMESTAMP '2024-01-21 18:30:00' AS timestamp_to
FROM k
""")
def run_result_summary(spark, sf):
    return run_summary(_runs(spark, sf), "2024-01-03 06:00:00", "2024-01-21 18:30:00")


@query("run_result_summaries", f"""
WITH r AS ({_RUNS}),
i AS (SELECT time_bucket(INTERVAL 6 HOUR, finished_at, TIMESTAMP '1970-01-01') AS f, result FROM r WHERE finished_at IS NOT NULL)
SELECT f AS timestamp_from, f + INTERVAL 6 HOUR AS timestamp_to, 'task_result' AS metric_type, k.result,
  COUNT(*) FILTER (WHERE i.result = k.result) AS metric
FROM i CROSS JOIN (SELECT unnest(['okay', 'skipped', 'failed']) AS result) k
GROUP BY f, k.result
""")
def run_result_summaries(spark, sf):
    return run_summaries(_runs(spark, sf), "6h")


@query("log_level_summary", """
WITH l AS (SELECT CASE event_type WHEN 'view' THEN 'DEBUG' WHEN 'click' THEN 'INFO' WHEN 'purchase' THEN 'WARNING'
  WHEN 'error' THEN 'ERROR' ELSE 'other' END AS level FROM events),
k AS (SELECT * FROM (VALUES ('INFO', 20), ('WARNING', 30), ('ERROR', 40), ('CRITICAL', 50)) t(level, log_level))
SELECT 'log' AS metric_type, CAST(log_level AS BIGINT) AS log_level,
  (SELECT COUNT(*) FROM l WHERE l.level = k.level) AS metric FROM k
""")
def log_level_summary(spark, sf):
    names = {"view": "debug", "click": "info", "purchase": "warning", "error": "error"}
    level = F.col("event_type")
    named = F.coalesce(*[F.when(level == k, v) for k, v in names.items()], F.lit("other"))
    found = level_summary(table(spark, sf, "events").select(named.alias("level")), "info")
    return found.withColumn("log_level", F.col("log_level").cast("bigint"))
