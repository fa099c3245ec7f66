"""Queries over intervals, trailing frames and histograms without gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators.buckets import DateHistogram, Terms, bucket_agg
from meterflow.operators.intervals import interval_totals, match_intervals
from meterflow.operators.rolling import fill_gaps, rolling
from meterflow.queries.registry import query, table

_CENTS = "CAST(ROUND(value * 100) AS BIGINT)"

# an error opens an interval of as many minutes as its value, a few events one of a week
_INTERVALS_SQL = """
WITH i AS (SELECT event_id AS incident, user_id AS who, ts AS since, ts + to_minutes(CAST(ceil(value) AS BIGINT)) AS until FROM events WHERE event_type = 'error'
  UNION ALL SELECT -event_id, user_id, ts, ts + INTERVAL 7 DAY FROM events WHERE event_id % 1000 = 7)
"""


def _incidents(spark, sf):
    events = table(spark, sf, "events")
    minutes = F.timestamp_add("MINUTE", F.ceil("value").cast("bigint"), F.col("ts")).cast("timestamp_ntz")
    short = events.where("event_type = 'error'").select(
        F.col("event_id").alias("incident"), F.col("user_id").alias("who"), F.col("ts").alias("since"), minutes.alias("until"))
    long = events.where("event_id % 1000 = 7").select(
        (-F.col("event_id")).alias("incident"), F.col("user_id").alias("who"), F.col("ts").alias("since"), F.expr("ts + INTERVAL 7 DAYS").alias("until"))
    return short.unionByName(long)


@query("intervals_metrics", _INTERVALS_SQL + f"""
SELECT incident, COUNT(*) AS n, CAST(SUM({_CENTS}) AS BIGINT) AS cents, MAX(event_id) AS last
FROM i JOIN events e ON e.ts >= i.since AND e.ts < i.until GROUP BY incident
""")
def intervals_metrics(spark, sf):
    """Events within each incident; incidents last from minutes to a week."""
    events = table(spark, sf, "events").withColumn("_cents", F.expr(_CENTS))
    found = interval_totals(events, _incidents(spark, sf), "ts", "since", "until", {"n": ("count", None), "cents": ("sum", "_cents"), "last": ("max", "event_id")})
    return found.groupBy("incident").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"), F.max("last").alias("last"))


@query("intervals_of_user", _INTERVALS_SQL + """
SELECT incident, event_id, event_type FROM i JOIN events e ON e.user_id = i.who AND e.ts >= i.since AND e.ts < i.until
""")
def intervals_of_user(spark, sf):
    """Events of the user an incident belongs to."""
    events = table(spark, sf, "events")
    pairs = match_intervals(events, _incidents(spark, sf), "ts", "since", "until", keys=[("user_id", "who")])
    return pairs.select("incident", "event_id", "event_type")


@query("rolling_one_series", f"""
SELECT event_id, CAST(SUM({_CENTS}) OVER w AS BIGINT) AS cents, COUNT(*) OVER w AS n, MAX(value) OVER w AS high
FROM events WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW)
""")
def rolling_one_series(spark, sf):
    """The last three hours at every event, all events being one series."""
    events = table(spark, sf, "events").withColumn("_cents", F.expr(_CENTS))
    metrics = {"cents": ("sum", "_cents"), "n": ("count", "event_id"), "high": ("max", "value")}
    found = rolling(events, [], "ts", "3h", metrics)
    return found.select("event_id", "cents", "n", "high")


@query("rolling_per_kind", f"""
SELECT event_id, event_type, MIN(value) OVER w AS low, COUNT(*) OVER w AS n
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
""")
def rolling_per_kind(spark, sf):
    found = rolling(table(spark, sf, "events"), ["event_type"], "ts", "1d", {"low": ("min", "value"), "n": ("count", "value")}, chunk="1d")
    return found.select("event_id", "event_type", "low", "n")


@query("bucket_gaps_filled", """
WITH e AS (SELECT CASE WHEN event_id % 1000 = 3 THEN 'rare' ELSE event_type END AS kind, date_trunc('minute', ts) AS minute, value FROM events),
b AS (SELECT kind, minute, COUNT(*) AS doc_count, MAX(value) AS high FROM e GROUP BY ALL),
g AS (SELECT kind, unnest(generate_series(min(minute), max(minute), INTERVAL 1 MINUTE)) AS minute FROM b GROUP BY kind)
SELECT kind, minute, coalesce(doc_count, 0) AS doc_count, high FROM g LEFT JOIN b USING (kind, minute)
""")
def bucket_gaps_filled(spark, sf):
    """One-minute buckets per kind, empty ones included; a rare kind has days between its events."""
    kind = "CASE WHEN event_id % 1000 = 3 THEN 'rare' ELSE event_type END"
    buckets = bucket_agg(table(spark, sf, "events"), [Terms("kind", kind), DateHistogram("minute", "ts", "1m")], {"high": ("max", "value")})
    return fill_gaps(buckets, ["kind"], "minute", "1m")
