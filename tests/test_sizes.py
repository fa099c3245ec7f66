"""Results and plans that must not depend on the size of mappings, fields, overlays or levels."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from meterflow.operators.buckets import Terms, bucket_agg
from meterflow.operators.gauges import gauge_rows
from meterflow.operators.lookup import enrich
from meterflow.operators.mapping import map_values
from meterflow.operators.normalize import to_metrics
from meterflow.operators.overlay import overlay
from meterflow.operators.rows import transform_batches, transform_frame, transform_rows
from meterflow.sinks.formats import documents, envelope, json_arrays, json_lines
from meterflow.sources.summaries import level_summary
from meterflow.streaming.run import batch_counts, total_counts, write_batch

AT = dt.datetime(2024, 5, 1)


def padded(mapping, n, key):
    """The mapping with ``n`` more keys that no row has."""
    return {**mapping, **{key(k): next(v for v in mapping.values() if v is not None) for k in range(n)}}


@pytest.mark.parametrize("options", [
    {"missing": "original"}, {"missing": "original_casted", "cast": "str"}, {"default": "unknown"}, {"default": 5}, {"missing": "nothing"},
    {"missing": "nothing", "result": "other"}, {"default": "x", "cast": "int"}, {"default": True, "cast": "bool"}, {"default": 1.5, "cast": "float"},
])
@pytest.mark.parametrize("kind", ["text", "number", "flag", "none", "nested"])
def test_mapping_forms_agree(spark, options, kind):
    df = spark.createDataFrame([(1.0, "a", 1, True), (2.0, "zz", 2, False), (3.0, None, None, None), (4.0, "1", 3, True)], "metric double, k string, n int, b boolean")
    field, mapping, more = {
        "text": ("k", {"a": 10, "b": 20}, lambda k: f"pad{k}"), "number": ("n", {1: "one", 2.0: "two"}, lambda k: 1000 + k),
        "flag": ("b", {0: "no", 1: "yes"}, lambda k: 2 + k), "none": ("n", {1: 5, None: 7}, lambda k: 1000 + k),
        "nested": ("n", {1: {"x": 1}, 2: {"x": 2}}, lambda k: 1000 + k),
    }[kind]
    if kind == "nested" and (options.get("missing") != "nothing" or "result" not in options):
        pytest.skip("records have no common type with the plain values of other modes")
    frame = to_metrics(df, "t", ts=F.lit(AT))
    few, many = (map_values(frame, padded(mapping, n, more), field, **options) for n in (1, 300))
    assert few.schema == many.schema
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_large_mapping_raises_like_a_small_one(spark):
    frame = to_metrics(spark.createDataFrame([(1.0, "zz")], "metric double, k string"), "t")
    for n in (1, 300):
        with pytest.raises(Exception, match="no mapping for key zz"):
            map_values(frame, padded({"a": 1}, n, lambda k: f"p{k}"), "k").collect()


def test_null_keys_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(40_000).select(F.col("id").cast("double").alias("metric"), F.when(F.col("id") % 1000 == 0, F.col("id")).alias("k"), (F.col("id") % 2 == 0).alias("w"))
        dim = spark.range(500).select(F.col("id").alias("key"), F.col("id").cast("string").alias("value"))
        frame = to_metrics(df, "t", ts=F.lit(AT))
        for out in (map_values(frame, dim, "k", default="none"), enrich(frame, dim, "k", "key"), enrich(frame, dim, "k", "key", within=F.col("attributes.w"))):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 40_000 and max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def nested_frame(spark, fields):
    columns = ", ".join(f"cast({k} + 0.5 as double) AS m{k}" for k in range(fields))
    df = spark.sql(f"SELECT {columns}, 2.0D AS d, array(10, 20, 30) AS tags, map('x', 'y', 'z', NULL) AS props, array() AS none, CAST(NULL AS array<int>) AS lost")
    return to_metrics(df, "t", [f"m{k}" for k in range(fields)], static={"m0": 9, "q": 'say "hi"'}, ts=F.lit(AT))


@pytest.mark.parametrize("fields", [1, 2, 6])
def test_records_are_complete_for_any_number_of_fields(spark, fields):
    frame = nested_frame(spark, fields)
    rest = '"d":2.0,"tags.0":10,"tags.1":20,"tags.2":30,"props.x":"y","props.z":null,"lost":null'
    want = sorted(f'{{"m{k}":{k}.5,{rest}' + (',"m0":9' if k else "") + ',"q":"say \\"hi\\""}' for k in range(fields))
    assert sorted(r.value for r in json_lines(frame).collect()) == want
    assert sorted(r.value for r in documents(frame).collect()) == want
    data = sorted(re.search(r'"data":(\{.*?\}),"env', r.value)[1] for r in envelope(frame, "p").collect())
    first = '{"d":2.0,"lost":null,"m0":0.5,"props.x":"y","props.z":null,"q":"say \\"hi\\"","tags.0":10,"tags.1":20,"tags.2":30}'
    assert data[0] == first and len(data) == fields
    plain = sorted(re.search(r'"data":(\{.*?\}),"env', r.value)[1] for r in envelope(frame.withColumn("attributes", F.col("attributes").dropFields("tags", "props", "none", "lost")), "p").collect())
    assert plain[0] == '{"d":2.0,"m0":0.5,"q":"say \\"hi\\""}' and all(f'"m{k}":{k}.5' in plain[k] for k in range(fields))
    gauge = gauge_rows(frame, "p").first()["attributes"]
    assert gauge["tags.2"] == "30" and gauge["props.x"] == "y" and gauge["sample_name"].startswith("m") and gauge["q"] == 'say "hi"'


def reads(df):
    """Table reads in the optimized plan."""
    return len(re.findall(r"Relation \[|LogicalRDD|LocalRelation|Range \(", df._jdf.queryExecution().optimizedPlan().toString()))


def test_nested_limits_read_the_input_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS a", "id % 5 AS b", "id % 3 AS c", "id % 2 AS d").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for depth in (1, 2, 3, 4):
        levels = [Terms(n, n, 2) for n in "abcd"[:depth]]
        assert reads(bucket_agg(df, levels)) == 1
        assert reads(bucket_agg(df, levels, keep_empty=True)) == 1
        assert "Expand" not in bucket_agg(df, levels, keep_empty=True)._jdf.queryExecution().toString()


def test_limits_rank_by_all_rows_of_a_bucket(spark):
    """Rows without a deeper key count for their outer bucket."""
    rows = [("x", None)] * 5 + [("x", "1")] + [("y", "1")] * 4 + [("z", "2")] * 3
    df = spark.createDataFrame(rows, "a string, b string")
    got = bucket_agg(df, [Terms("a", "a", 2), Terms("b", "b")])
    assert sorted(map(tuple, got.collect())) == [("x", "1", 1), ("y", "1", 4)]
    kept = bucket_agg(df.union(spark.createDataFrame([("w", None)] * 9, df.schema)), [Terms("a", "a", 2), Terms("b", "b")], keep_empty=True)
    assert sorted(kept.collect(), key=str) == sorted([("w", None, 9), ("x", "1", 1)], key=str)


def test_overlays_grow_linearly(spark, tmp_path):
    spark.range(10).selectExpr("id AS name", "id AS v").write.parquet(str(tmp_path / "t"))

    def plan(n):
        return reads(overlay(*[spark.read.parquet(str(tmp_path / "t")) for _ in range(n + 1)]))

    counts = [plan(n) for n in range(1, 7)]
    assert {b - a for a, b in zip(counts, counts[1:])} == {counts[1] - counts[0]} and counts[-1] <= 3 * 7


def test_user_code_may_not_break_the_metric(spark):
    frame = to_metrics(spark.createDataFrame([(1.0, "a"), (2.0, "b")], "metric double, k string"), "t", ts=F.lit(AT))
    with pytest.raises(ValueError):
        transform_rows(frame, {"metric": "'text'"})
    with pytest.raises(ValueError):
        transform_frame(frame, lambda d: d.withColumn("metric", F.lit("text")))
    out = transform_batches(frame, lambda b: b.assign(metric=b["metric"] * 10), within=F.col("attributes.k") == "b")
    assert sorted(r.metric for r in out.collect()) == [1.0, 20.0]
    with pytest.raises(ValueError):
        to_metrics(spark.createDataFrame([(1.0, bytearray(b"x"))], "metric double, k binary"), "t")


def test_level_names_and_bounds(spark):
    logs = spark.createDataFrame([("warn",), ("WARNING",), ("fatal",), ("odd",)], "level string")
    assert {r.log_level: r.metric for r in level_summary(logs, "warn").collect()} == {30: 2, 40: 0, 50: 1}
    with pytest.raises(Exception, match="more than 2 rows"):
        json_arrays(spark.range(3).selectExpr("id AS seq", "'x' AS value", "0 AS b"), "b", "seq", most=2).collect()


def test_repeated_batch_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "a"), (dt.datetime(2023, 1, 1, 5), "a")], "ts timestamp, k string")
    for batch_id in (1, 0, 1):
        write_batch(batch_counts(rows, "ts", "1 hour", ["k"]), str(tmp_path / "t"), batch_id)
    assert sorted(r.n for r in total_counts(spark.read.parquet(str(tmp_path / "t")), ["k"]).collect()) == [2, 2]
