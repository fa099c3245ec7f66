"""Lookups, overlays, bucket aggregations, gauges and batches."""

import base64
import datetime as dt
import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from meterflow.functions.values import b64, b64url
from meterflow.operators.batches import batch_ids, local_batches, number_rows, parse_rate, rows_per_batch
from meterflow.operators.buckets import (
    BucketLevel, DateHistogram, Filters, Histogram, Terms, bucket_agg, flatten_buckets, root_agg,
)
from meterflow.operators.gauges import gauge_rows, last_value
from meterflow.operators.lookup import enrich, missing_keys
from meterflow.operators.normalize import to_metrics
from meterflow.operators.overlay import overlay
from meterflow.sources.search import search, search_buckets


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# lookups

@pytest.fixture(scope="module")
def index(spark):
    """The search fixture: 120 documents with ids doc_1 to doc_120."""
    rows = [(f"doc_{i + 1}", i, "abcdefg"[i % 7], i % 11 + 1, (f"pod_{i % 3}", "testing")) for i in range(120)]
    return spark.createDataFrame(
        rows, "id string, metric bigint, field_1 string, field_2 bigint, metadata struct<host: string, environment: string>"
    )


def test_enrich_with_one_field(spark, index):
    df = spark.createDataFrame([(i, f"doc_{i + 1}", "test") for i in range(20)], "metric int, index string, env string")
    got = dicts(enrich(to_metrics(df, "t"), index, "index", "id", include=["field_2"], fail=True))
    assert sorted(got[0]["attributes"]) == ["env", "field_2", "index"]
    assert {r["metric"]: r["attributes"]["field_2"] for r in got} == {i: i % 11 + 1 for i in range(20)}


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("a", 0, "", None, [1]), ("b", 5, "x", False, [])], "id string, n int, s string, f boolean, l array<int>"
    )


def lookup(spark, dim, keys, **options):
    df = spark.createDataFrame([(1, k, "own") for k in keys], "metric int, k string, s string")
    return {r["attributes"]["k"]: r["attributes"] for r in dicts(enrich(to_metrics(df, "t"), dim, "k", "id", **options))}


def test_all_fields_win_over_attributes_only_if_found(spark, dim):
    got = lookup(spark, dim, ["a", "zz", None])
    assert got["a"] == {"k": "a", "s": "", "n": 0, "f": None, "l": [1]}
    assert got["zz"] == {"k": "zz", "s": "own", "n": None, "f": None, "l": None}
    assert got[None]["s"] == "own"


def test_falsy_fields_take_defaults(spark, dim):
    defaults = {"n": 9, "s": "d", "f": True, "new": "v"}
    got = lookup(spark, dim, ["a", "b", "zz"], include=["n", "s", "f", "l", "new", "none"], defaults=defaults)
    assert got["a"] == {"k": "a", "s": "d", "n": 9, "f": True, "l": [1], "new": "v", "none": None}
    assert got["b"] == {"k": "b", "s": "x", "n": 5, "f": True, "l": None, "new": "v", "none": None}
    assert got["zz"]["n"] == 9 and got["zz"]["s"] == "d"
    kept = lookup(spark, dim, ["a", "b"], include=["n", "s", "f"], defaults=defaults, falsy_as_missing=False)
    assert kept["a"] == {"k": "a", "s": "", "n": 0, "f": True} and kept["b"]["f"] is False


def test_missing_and_duplicate_documents(spark, dim):
    with pytest.raises(Exception, match="no document for key zz"):
        lookup(spark, dim, ["a", "zz"], fail=True)
    with pytest.raises(Exception, match="not unique"):
        lookup(spark, dim.union(dim.where("id = 'b'")), ["a"])
    df = to_metrics(spark.createDataFrame([(1, "a"), (2, "q"), (3, None)], "metric int, k string"), "t")
    assert sorted(r["metric"] for r in dicts(missing_keys(df, dim, "k", "id"))) == [2, 3]


def test_lookup_within(spark, dim):
    df = to_metrics(spark.createDataFrame([(1, "a", "own"), (2, "zz", "own"), (3, "a", "own")], "metric int, k string, s string"), "t")
    got = enrich(df, dim, "k", "id", include=["s", "n"], defaults={"s": "d"}, fail=True, within=F.col("metric") == 1)
    assert {r["metric"]: (r["attributes"]["s"], r["attributes"]["n"]) for r in dicts(got)} == {1: ("d", None), 2: ("own", None), 3: ("own", None)}


def test_salted_lookup_equals_plain(spark, dim):
    keys = ["a"] * 300 + ["b", "c"]
    df = to_metrics(spark.createDataFrame(list(enumerate(keys)), "metric int, k string"), "t")
    plain = sorted(map(str, dicts(enrich(df, dim, "k", "id").drop("metric_ts"))))
    salted = sorted(map(str, dicts(enrich(df, dim, "k", "id", salts=5).drop("metric_ts"))))
    assert len(salted) == 302 and plain == salted


def test_salted_lookup_does_not_broadcast_the_replicated_side(spark, dim):
    """Spark sizes ``dim`` before its rows are replicated per salt; broadcast, every task would hold them all."""
    df = to_metrics(spark.createDataFrame([(1, "a"), (2, "zz")], "metric int, k string"), "t")
    salted = enrich(df, dim, "k", "id", salts=4)
    salted.collect()
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_shuffled_lookup_keeps_the_skew_join_shape(spark, dim):
    """A join too large to broadcast sorts plain shuffles, which run-time skew splitting needs."""
    df = to_metrics(spark.createDataFrame([(1, "a")], "metric int, k string"), "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enrich(df, dim, "k", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    join = next(i for i, line in enumerate(lines) if line.startswith("SortMergeJoin"))
    sides = [i for i in range(join, len(lines)) if lines[i].startswith("Sort [_lookup")]
    assert len(sides) == 2 and all(lines[i + 1].startswith("Exchange hashpartitioning") for i in sides)


def test_hot_key_is_split_at_run_time(spark):
    """Most rows under one key, against a table that is not broadcast."""
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.col("id").alias("metric"),
    ).repartition(12)
    dim = spark.range(60_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100kb",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = enrich(to_metrics(hot, "t"), dim, "k", "key")
        got = out.selectExpr("attributes.k", "attributes.twice", "attributes.pad")
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "skew=true" in plan
    assert len(rows) == 60_000 and all(r["twice"] == 2 * r["k"] for r in rows)


def test_key_encodings(spark):
    keys = ["", "a", "é?>~" * 40, "x" * 57, "x" * 58]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [tuple(r) for r in df.select(b64(F.col("k")), b64url(F.col("k"))).collect()]
    assert got == [
        (base64.b64encode(k.encode()).decode(), base64.urlsafe_b64encode(k.encode()).decode()) for k in keys
    ]


# overlays

def test_overlay_merges_tasks_by_name(spark):
    schema = "name string, kind string, tasks array<struct<name: string, cron: string, payload: struct<a: int>>>"
    base = spark.createDataFrame([("abc", "debug", [("t1", "* * * * *", None), ("t2", "* * * * *", None)])], schema)
    ext = spark.createDataFrame([("abc", None, [("t1", "*/2", (1,)), ("t3", "0 0 * * *", None)]), ("new", "x", None)], schema)
    got = {r["name"]: r for r in dicts(overlay(base, ext))}
    assert [(t["name"], t["cron"]) for t in got["abc"]["tasks"]] == [("t1", "*/2"), ("t2", "* * * * *"), ("t3", "0 0 * * *")]
    assert got["abc"]["tasks"][0]["payload"] == {"a": 1} and got["abc"]["kind"] == "debug"
    assert got["new"] == {"name": "new", "kind": "x", "tasks": None}


def test_doubled_names_are_refused(spark):
    base = spark.createDataFrame([("k", 1), ("k", 2)], "name string, v int")
    with pytest.raises(Exception, match="not unique"):
        overlay(base, base.limit(1)).collect()
    assert overlay(spark.createDataFrame([(None, 1), (None, 2)], "name string, v int"), base.limit(1)).count() == 3


def test_first_listed_overlay_wins(spark):
    mk = lambda v, extra: spark.createDataFrame([("k", v, (v, extra), [extra])], "name string, v int, s struct<a: int, b: string>, l array<string>")
    base = mk(0, "base")
    got = dicts(overlay(base, mk(1, "one"), mk(2, None)))[0]
    assert got == {"name": "k", "v": 1, "s": {"a": 1, "b": "one"}, "l": ["base", None, "one"]}
    wide = spark.createDataFrame([("k", "added")], "name string, more string")
    assert dicts(overlay(base, wide))[0]["more"] == "added"


# buckets

def test_terms_of_the_search_example(index):
    got = dicts(bucket_agg(index, [Terms("title", "field_1")], {"total": ("sum", "metric")}))
    assert sorted(r["doc_count"] for r in got) == [17] * 6 + [18]
    assert sorted(r["total"] for r in got) == [969 + 17 * i for i in range(7)]
    frame = dicts(to_metrics(bucket_agg(index, [Terms("title", "field_1")], {"total": ("sum", "metric")}), "t", ["total", "doc_count"]))
    assert len(frame) == 14 and all(list(r["attributes"]) == ["title"] for r in frame)


def test_search_of_the_example(index):
    hits = search(index, [F.col("metadata.host") == "pod_1"], size=999, order_by=["metric"], id_column="id")
    got = dicts(to_metrics(hits, "t", "_source.metric"))
    assert [r["metric"] for r in got] == list(range(1, 120, 3)) and got[0]["metric_field"] == "_source.metric"
    assert search(index, size=0).count() == 0
    with pytest.raises(ValueError):
        search(index, size=5)
    assert search_buckets(index, [Terms("t", "field_1")], conditions=["metric < 0"]).count() == 0


def brute_nested(rows, keep_empty):
    """Nested terms over (a, b, v) rows in plain Python."""
    out = Counter()
    by_a = defaultdict(list)
    for a, b, v in rows:
        if a is not None:
            by_a[a].append((b, v))
    for a, items in by_a.items():
        children = defaultdict(list)
        for b, v in items:
            if b is not None:
                children[b].append(v)
        for b, vs in children.items():
            out[(a, b, len(vs), sum(vs))] += 1
        if keep_empty and not children:
            out[(a, None, len(items), sum(v for _, v in items))] += 1
    return out


@pytest.mark.parametrize("keep_empty", [False, True])
def test_nested_terms_against_brute_force(spark, keep_empty):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None, "hot", "hot", "hot"]), rng.choice([1, 2, None]), rng.randint(0, 9)) for _ in range(400)]
    rows += [("lonely", None, 4), ("lonely", None, 5)]
    df = spark.createDataFrame(rows, "a string, b int, v int")
    got = bucket_agg(df, [Terms("a", "a"), Terms("b", "b")], {"t": ("sum", "v")}, keep_empty=keep_empty)
    assert Counter(tuple(r) for r in got.collect()) == brute_nested(rows, keep_empty)


def test_three_levels_keep_the_deepest_present(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "b", None), (3, "c", "d"), (3, "c", None)], "a int, b string, c string")
    got = bucket_agg(df, [Terms("a", "a"), Terms("b", "b"), Terms("c", "c")], keep_empty=True)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None, None, 1), (2, "b", None, 1), (3, "c", "d", 1)]


def test_filters_in_every_position(spark):
    df = spark.createDataFrame([("x", 1), ("x", 5), ("y", 9), (None, 5)], "a string, v int")
    tests = {"small": "v < 6", "five": F.col("v") == 5, "none": "v > 100"}
    flat = {tuple(r) for r in bucket_agg(df, [Filters("f", tests)], {"t": ("sum", "v")}).collect()}
    assert flat == {("small", 3, 11), ("five", 2, 10), ("none", 0, None)}
    last = {tuple(r) for r in bucket_agg(df, [Terms("a", "a"), Filters("f", tests)]).collect()}
    assert last == {("x", "small", 2), ("x", "five", 1), ("x", "none", 0), ("y", "small", 0), ("y", "five", 0), ("y", "none", 0)}
    first = {tuple(r) for r in bucket_agg(df, [Filters("f", tests), Terms("a", "a")]).collect()}
    assert first == {("small", "x", 2), ("five", "x", 1)}
    kept = {tuple(r) for r in bucket_agg(df, [Filters("f", tests), Terms("a", "a")], keep_empty=True).collect()}
    assert kept == first | {("none", None, 0)}
    middle = {tuple(r) for r in bucket_agg(df, [Terms("a", "a"), Filters("f", tests), Histogram("h", "v", 4)], keep_empty=True).collect()}
    assert middle == {
        ("x", "small", 0.0, 1), ("x", "small", 4.0, 1), ("x", "five", 4.0, 1), ("x", "none", None, 0),
        ("y", "small", None, 0), ("y", "five", None, 0), ("y", "none", None, 0),
    }
    two = {tuple(r) for r in bucket_agg(df, [Filters("f", {"s": "v < 6"}), Filters("g", {"five": "v = 5", "no": "v = 3"})], keep_empty=True).collect()}
    assert two == {("s", "five", 2), ("s", "no", 0)}


def test_bucket_names_do_not_hide_columns(spark):
    df = spark.createDataFrame([(1.5, "a", dt.datetime(2024, 1, 1, 5)), (1.7, "b", dt.datetime(2024, 1, 1, 7))], "v double, k string, ts timestamp_ntz")
    levels = [Terms("v", "floor(v)"), DateHistogram("ts", "ts", "1d"), Filters("k", {"late": "hour(ts) > 6", "a": "k = 'a'"})]
    metrics = {"s": ("sum", "v"), "last": ("max", "ts")}
    want = {(1, dt.datetime(2024, 1, 1), "late", 1, 1.7, dt.datetime(2024, 1, 1, 7)), (1, dt.datetime(2024, 1, 1), "a", 1, 1.5, dt.datetime(2024, 1, 1, 5))}
    for keep_empty in (False, True):
        assert set(map(tuple, bucket_agg(df, levels, metrics, keep_empty).collect())) == want
    turned = bucket_agg(df, [levels[2], levels[0]], {"s": ("sum", "v")}, keep_empty=True)
    assert set(map(tuple, turned.collect())) == {("late", 1, 1, 1.7), ("a", 1, 1, 1.5)}


def test_no_rows_no_records(spark):
    df = spark.createDataFrame([], "a string, v int")
    assert bucket_agg(df, [Filters("f", {"x": "v > 1"})]).count() == 0
    assert bucket_agg(df, [Terms("a", "a")], keep_empty=True).count() == 0
    assert root_agg(df, {"t": ("sum", "v")}).count() == 0
    kept = bucket_agg(df, [Filters("f", {"x": "v > 1"}), Terms("a", "a")], keep_empty=True)
    assert kept.count() == 0


def test_top_buckets(spark):
    rows = [("a", i % 4) for i in range(10)] + [("b", 1)] * 5 + [("c", 2)] * 5 + [("d", 3)]
    df = spark.createDataFrame(rows, "k string, j int")
    assert [tuple(r) for r in bucket_agg(df, [Terms("k", "k", top_n=2)]).collect()] == [("a", 10), ("b", 5)]
    got = bucket_agg(df, [Terms("k", "k", top_n=2), Terms("j", "j", top_n=1)])
    assert sorted(map(tuple, got.collect())) == [("a", 0, 3), ("b", 1, 5)]


def test_histograms(spark):
    df = spark.createDataFrame([(-0.5, dt.datetime(2024, 1, 31, 23)), (9.9, dt.datetime(2024, 2, 1)), (10.0, None)], "x double, ts timestamp")
    got = {tuple(r) for r in bucket_agg(df, [Histogram("h", "x", 10)]).collect()}
    assert got == {(-10.0, 1), (0.0, 1), (10.0, 1)}
    got = {tuple(r) for r in bucket_agg(df, [DateHistogram("m", "ts", "month")]).collect()}
    assert got == {(dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 2, 1), 1)}


def test_stats_are_addressed_by_path(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, v double")
    stats = bucket_agg(df, [Terms("k", "k")], {"v": ("stats", "v")})
    assert dicts(to_metrics(stats, "t", "v.avg", ["k"]))[0]["metric"] == 2.0
    root = root_agg(df, {"t": ("sum", "v"), "p": ("percentile", "v", 0.5)})
    assert {r["metric_field"]: r["metric"] for r in dicts(to_metrics(root, "t", "*.value"))} == {"t.value": 4.0, "p.value": 1.0}


def test_bucket_documents(spark):
    doc = """{"total": {"value": 9.5},
      "title": {"buckets": [
        {"key": "a", "doc_count": 3, "total": {"value": 1.5}, "kind": {"buckets": {
            "x": {"doc_count": 2, "total": {"value": 7}}, "y": {"doc_count": 0}}}},
        {"key": "b", "doc_count": 4, "kind": {"buckets": {}}}]}}"""
    df = spark.createDataFrame([(1, doc), (2, '{"title": {"buckets": []}}')], "id int, doc string")
    got = flatten_buckets(df, "doc", [BucketLevel("title"), BucketLevel("kind", named=True)], {"total": "double"}, ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "a", "x", 2, 7.0), (1, "a", "y", 0, 1.5), (1, "b", None, 4, 9.5), (2, None, None, None, None),
    ]


def python_leaves(node, levels, metrics, fields):
    """Leaf records of one bucket document, by recursion."""
    def walk(node, rest, seen):
        seen = seen | {m: node[m]["value"] for m in metrics if m in node}
        seen = seen | {f: node[f] for f in ("doc_count", *fields) if f in node}
        if not rest:
            return [seen]
        buckets = node.get(rest[0].name, {}).get("buckets", [])
        pairs = list(buckets.items()) if isinstance(buckets, dict) else [(b["key"], b) for b in buckets]
        return [leaf for key, b in pairs for leaf in walk(b, rest[1:], seen | {rest[0].name: key})] or [seen]

    return walk(node, levels, {})


def test_bucket_documents_against_recursion(spark):
    rng = random.Random(5)
    levels = [BucketLevel("a"), BucketLevel("b", named=True), BucketLevel("c", "bigint")]

    def bucket(depth):
        node = {"doc_count": rng.randint(0, 9)} if depth else {}
        if rng.random() < 0.6:
            node["m"] = {"value": rng.randint(0, 99)}
        if depth and rng.random() < 0.5:
            node["key_as_string"] = f"k{rng.randint(0, 9)}"
        if depth < 3:
            children = [bucket(depth + 1) for _ in range(rng.randint(0, 3))]
            if levels[depth].named:
                node[levels[depth].name] = {"buckets": {f"n{i}": c for i, c in enumerate(children)}}
            else:
                keyed = [{"key": i if depth == 2 else f"v{i}", **c} for i, c in enumerate(children)]
                node[levels[depth].name] = {"buckets": keyed}
        return node

    docs = [bucket(0) for _ in range(60)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, doc string")
    got = flatten_buckets(df, "doc", levels, {"m": "bigint"}, ["id"], {"key_as_string": "string"})
    names = ["id", "a", "b", "c", "doc_count", "m", "key_as_string"]
    want = Counter(
        tuple((leaf | {"id": i}).get(n) for n in names)
        for i, d in enumerate(docs) for leaf in python_leaves(d, levels, ["m"], ["key_as_string"])
    )
    assert Counter(map(tuple, got.select(names).collect())) == want


# gauges

def test_gauge_rows_and_last_value(spark):
    rows = [(1.0, "a", 1, 10), (2.0, "a", 1, 11), (3.0, "a", 1, 9), (4.0, "b", 1, 1), (None, "b", 1, 2)]
    df = to_metrics(spark.createDataFrame(rows, "metric double, k string, z int, n bigint"), "T", attributes=["k", "z"],
                    ts=F.lit(dt.datetime(2024, 1, 1)), seq="n")
    gauges = gauge_rows(df, "prod", static={"z": 5})
    assert dicts(gauges)[0]["attributes"] == {"k": "a", "z": 5, "sample_name": "metric"}
    assert "sample_name" not in dicts(gauge_rows(df, "prod", None))[0]["attributes"]
    got = {r["attributes"]["k"]: r["value"] for r in dicts(last_value(gauges, ["instrument", "attributes"], "value", ["metric_ts", "seq"]))}
    assert got == {"a": 2.0, "b": None}
    assert {r["value"] for r in dicts(last_value(gauges, ["instrument", "attributes"], "value", ["seq"]))} == {2.0, None}


# batches

def test_rates():
    assert parse_rate("2000/500ms") == (2000, 500_000) and parse_rate("5/1m") == (5, 60_000_000)
    assert rows_per_batch("7/1s") == rows_per_batch(7) == 7
    for bad in ("2000", "x/1s", "0/1s"):
        with pytest.raises(ValueError):
            parse_rate(bad)
    with pytest.raises(ValueError):
        rows_per_batch(0)


@pytest.mark.parametrize("keys", [
    list(range(1000)), [i * i * i for i in range(700)], [2**60 + i for i in range(300)] + [-5, 0, 7],
    list(range(-50, 50)) + [10**12 + i for i in range(500)], [3],
])
def test_numbering_against_sorting(spark, keys):
    shuffled = random.Random(1).sample(keys, len(keys))
    df = spark.createDataFrame([(k,) for k in shuffled], "k bigint").repartition(5)
    got = {r["k"]: r["row_no"] for r in number_rows(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    sizes = Counter(r["batch_id"] for r in batch_ids(df, 64, "k").collect())
    assert [sizes[i] for i in sorted(sizes)] == [min(64, len(keys) - 64 * i) for i in range(-(-len(keys) // 64))]


def test_numbering_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "k bigint")
    assert sorted((r["row_no"], r["k"]) for r in number_rows(df, "k").collect()) == [(0, None), (1, 1), (2, 2)]
    assert number_rows(df.where("k > 5"), "k").count() == 0


def test_numbering_of_null_and_repeated_keys_is_many_tasks(spark):
    df = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS `_own`", "map('a', id) AS m")
    rows = number_rows(df, "k", "no")
    assert rows.columns == ["k", "_own", "m", "no"]
    assert sorted(r["no"] for r in rows.collect()) == list(range(4000))
    assert {r["_own"]: r["no"] for r in rows.collect()} == {r["_own"]: r["no"] for r in number_rows(df.repartition(7), "k", "no").collect()}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    mixed = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id % 50) AS k", "id")
    got = sorted((r["no"], r["k"]) for r in number_rows(mixed, "k", "no").collect())
    assert [n for n, _ in got] == list(range(3000)) and [k for _, k in got] == sorted(k for _, k in got)


def test_local_batches_follow_the_partition(spark):
    df = local_batches(spark.range(0, 1000, 1, 4), 64).withColumn("p", F.spark_partition_id())
    sizes = df.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct("p").alias("p"))
    got = [(r["n"], r["p"]) for r in sizes.collect()]
    assert sum(n for n, _ in got) == 1000 and all(n <= 64 and p == 1 for n, p in got) and len(got) == 16
