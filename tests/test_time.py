"""Versioned lookups, intervals, trailing frames, gaps and top terms against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterflow.operators.frequent import _tallies, frequent_buckets, frequent_terms
from meterflow.operators.buckets import Terms
from meterflow.operators.intervals import match_intervals
from meterflow.operators.rolling import fill_gaps, rolling
from meterflow.operators.versions import _ranged, enrich_as_of, hot_keys
from tests.test_plans import plan_of


def no_pairs(df):
    plan = plan_of(df)
    return "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


@pytest.mark.parametrize("shape", ["flat", "skewed", "one", "few", "none"])
@pytest.mark.parametrize("tracked, cells", [(5, 2), (64, 1000)])
def test_frequent_terms_are_exact(spark, shape, tracked, cells):
    rng = random.Random(1)
    values = {
        "flat": [i % 700 for i in range(2100)], "skewed": [int(rng.paretovariate(0.7)) % 5000 for _ in range(3000)],
        "one": [3] * 50, "few": [1, 1, 2, None, None, None], "none": [None],
    }[shape]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    got = [tuple(r) for r in frequent_terms(df, "v", 5, tracked, cells).collect()]
    counts = Counter(v for v in values if v is not None)
    assert got == sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:5]
    rows = df.select(F.col("v").alias("_item")).where("_item IS NOT NULL")
    assert _tallies(rows, tracked, cells).count() <= tracked + cells
    buckets = frequent_buckets(df.withColumn("w", F.col("v") * 2), Terms("term", "v", top_n=3), {"w": ("sum", "w")}, tracked, cells)
    assert {r["term"]: (r["doc_count"], r["w"]) for r in buckets.collect()} == {
        k: (n, 2 * k * n) for k, n in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:3]}


def test_frequent_terms_arguments(spark):
    with pytest.raises(ValueError):
        frequent_terms(spark.range(3), "id", 10, tracked=5)
    with pytest.raises(ValueError):
        frequent_buckets(spark.range(3), Terms("id", "id"))
    texts = spark.createDataFrame([("b",), ("a",), ("a",)], "t string")
    assert [tuple(r) for r in frequent_terms(texts, "upper(t)", 1).collect()] == [("A", 2)]


def as_of(rows, versions):
    out = []
    for i, k, t in rows:
        known = [(f, str(d), d) for kk, f, d in versions if kk == k and k is not None and f is not None and t is not None and f <= t]
        out.append((i, max(known)[2] if known else None))
    return sorted(out)


@pytest.mark.parametrize("parts", [2, 7])
def test_versions_against_all_pairs(spark, parts):
    rng = random.Random(parts)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    rows = [(i, rng.choice(keys), rng.choice([None, *range(-5, 60)])) for i in range(900)]
    versions = [(rng.choice(keys), rng.choice([None, *range(-5, 60)]), rng.randrange(9)) for _ in range(80)]
    df = spark.createDataFrame(rows, "i long, k string, t long").repartition(3).withColumn("_row", F.lit(1)).withColumn("m", F.create_map(F.lit("x"), "i"))
    dim = spark.createDataFrame(versions, "id string, since long, doc long")
    got = enrich_as_of(df, dim, "k", "id", "since", ts="t", parts=parts)
    assert got.columns == ["i", "k", "t", "_row", "m", "doc"]
    assert sorted((r["i"], r["doc"]) for r in got.collect()) == as_of(rows, versions)
    assert no_pairs(got)
    assert enrich_as_of(df.limit(0), dim, "k", "id", "since", ts="t").count() == 0
    none = enrich_as_of(df, dim.limit(0), "k", "id", "since", ts="t", include=["doc"], defaults={"doc": 4})
    assert {r["doc"] for r in none.collect()} == {4} and none.count() == 900


def test_a_key_with_a_third_of_all_rows_is_many_ranges(spark):
    parts = 8
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("_key"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("_at"))
    cuts = hot_keys(rows, parts)
    assert [r["_hot"] for r in cuts.collect()] == [-1]
    groups = _ranged(rows, cuts).groupBy("_key", "_range").count()
    assert groups.agg(F.max("count")).first()[0] <= 2 * 60_000 / (16 * parts)
    tasks = [r["n"] for r in _ranged(rows, cuts).repartition(parts, "_key", "_range").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(tasks) <= 2 * 60_000 / parts
    # equal times cannot be cut
    assert hot_keys(rows.withColumn("_at", F.lit(1)), parts).first()["_cuts"] == [1]


def test_intervals_against_all_pairs(spark):
    rng = random.Random(4)
    minute = 60_000_000
    rows = [(i, rng.choice([None, *[rng.randrange(-10**11, 10**11) for _ in range(9)]]), rng.choice("xy")) for i in range(400)]
    spans = []
    for j in range(120):
        start = rng.choice([None, *[rng.randrange(-10**11, 10**11) for _ in range(9)]])
        length = rng.choice([0, -5, 1, minute, minute + 1, 8 * minute, 10**9, 10**11, 10**15, None])
        spans.append((j, start, None if length is None or start is None else start + length, rng.choice("xy")))
    spans += [(500, rows[0][1] or 0, (rows[0][1] or 0) + 1, "x"), (501, -10**17, 10**17, "y")]
    df = spark.createDataFrame(rows, "i long, t long, k string")
    intervals = spark.createDataFrame(spans, "j long, a long, b long, kk string")
    expected = [(i, j) for i, t, k in rows for j, a, b, kk in spans if t is not None and a is not None and a <= t and (b is None or t < b)]
    found = match_intervals(df, intervals, "t", "a", "b")
    assert sorted((r["i"], r["j"]) for r in found.collect()) == sorted(expected)
    assert no_pairs(found)
    keyed = match_intervals(df, intervals, "t", "a", "b", keys=[("k", "kk")])
    by_key = {i: k for i, _, k in rows}
    assert sorted((r["i"], r["j"]) for r in keyed.collect()) == sorted((i, j) for i, j in expected if by_key[i] == dict((s[0], s[3]) for s in spans)[j])
    assert match_intervals(df, intervals.limit(0), "t", "a", "b").count() == 0 == match_intervals(df.limit(0), intervals, "t", "a", "b").count()
    with pytest.raises(ValueError):
        match_intervals(df, df, "t", "i", "t")


@pytest.mark.parametrize("chunk", [None, "1s", "1h"])
def test_trailing_frames_against_all_rows(spark, chunk):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", None]), rng.choice([None, *[rng.randrange(-300, 300) for _ in range(20)]]), rng.choice([None, *range(9)])) for i in range(300)]
    df = spark.createDataFrame([(i, s, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), v) for i, s, t, v in rows], "i long, s string, t timestamp_ntz, v int")
    got = {r["i"]: (r["n"], r["x"], r["hi"]) for r in rolling(df, ["s"], "t", "10s", {"n": ("count", "v"), "x": ("sum", "v"), "hi": ("max", "v")}, chunk).collect()}
    for i, s, t, _ in rows:
        seen = [v for _, s2, t2, v in rows if s2 == s and t is not None and t2 is not None and t - 10 <= t2 <= t and v is not None]
        assert got[i] == ((None, None, None) if t is None else (len(seen), sum(seen) if seen else None, max(seen, default=None)))


def test_one_series_is_many_tasks(spark):
    df = spark.range(20_000).withColumn("t", F.col("id") * 1_000_000)
    found = rolling(df, [], "t", "10s", {"n": ("count", "id")})
    parts = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 1 and max(parts) < 2 * 20_000 / len(parts)
    assert found.where("n <> 11").count() == 10 and "SinglePartition" not in plan_of(found)


def test_gaps_of_all_lengths(spark):
    minute = 60_000_000
    rows = [("a", 0), ("a", 3), ("a", 4), ("a", 5000), ("b", -7), ("c", -2000), ("c", 2000), (None, 1), (None, 3)]
    df = spark.createDataFrame([(p, t * minute, 2, 1.5) for p, t in rows], "p string, t long, doc_count long, high double")
    got = fill_gaps(df, ["p"], "t", "1m")
    seen = sorted(((r["p"] or "", r["t"] // minute, r["doc_count"], r["high"]) for r in got.collect()), key=str)
    expected = []
    for p in {p for p, _ in rows}:
        own = [t for q, t in rows if q == p]
        expected += [(p or "", t, 2 if t in own else 0, 1.5 if t in own else None) for t in range(min(own), max(own) + 1)]
    assert seen == sorted(expected, key=str)
    assert fill_gaps(df.limit(0), ["p"], "t", "1m").count() == 0
    alone = fill_gaps(df.where("p = 'a'").drop("p"), [], "t", "1m")
    assert alone.count() == 5001 and no_pairs(alone)
