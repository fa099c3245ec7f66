"""Cases that once went wrong: ties, long batches, equal names in sources, maps beside mapped fields."""

import threading

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from meterflow.operators.gauges import last_value
from meterflow.operators.lookup import enrich
from meterflow.operators.mapping import map_values
from meterflow.sinks.formats import json_arrays
from meterflow.sources.sql import sql_source
from tests.test_plans import plan_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_last_value_of_ties_does_not_depend_on_partitions(spark, parts):
    rows = [("a", 1, 5.0), ("a", 1, 9.0), ("a", 1, 7.0), ("a", 0, 99.0), ("b", None, 1.0), ("b", None, 2.0)]
    df = spark.createDataFrame(rows, "s string, o int, v double").repartition(parts, "v")
    assert {r["s"]: r["v"] for r in last_value(df, ["s"], "v", ["o"]).collect()} == {"a": 9.0, "b": 2.0}


def test_last_value_of_a_unique_order_is_hashed(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('a', TIMESTAMP '2024-01-01 00:00:00', 9223372036854775807, 1D), ('a', TIMESTAMP '2024-01-01 00:00:00', -9223372036854775808, 2D),
        ('a', TIMESTAMP '1905-01-01 00:00:00', 5, 3D), ('b', TIMESTAMP '0001-01-01 00:00:00', CAST(NULL AS BIGINT), 4D),
        ('b', TIMESTAMP '0001-01-01 00:00:00', -9223372036854775808, 5D), ('c', NULL, 3, 6D), ('c', TIMESTAMP '0001-01-02 00:00:00', NULL, 7D),
        ('d', TIMESTAMP '9999-12-31 00:00:00', 1, 8D), ('d', TIMESTAMP '9999-12-31 00:00:00', 2, 9D) AS t(s, ts, seq, v)""")
    found = last_value(df, ["s"], "v", ["ts", "seq"])
    assert {r["s"]: r["v"] for r in found.collect()} == {"a": 1.0, "b": 5.0, "c": 7.0, "d": 9.0}
    assert {r["s"]: r["v"] for r in last_value(df, ["s"], "v", ["seq"], unique=True).where("s <> 'b'").collect()} == {"a": 1.0, "c": 6.0, "d": 9.0}
    assert "SortAggregate" not in plan_of(queries()["gauge_last_value"](spark, SF))


def test_long_batches_fail_before_they_are_gathered(spark):
    df = spark.range(30).selectExpr("id div 10 AS b", "id AS o", "CAST(id AS STRING) AS value")
    assert {r["b"]: r["payload"] for r in json_arrays(df, "b", "o", most=10).collect()}[0] == "[" + ",".join(map(str, range(10))) + "]"
    with pytest.raises(Exception, match="more than 9 rows"):
        json_arrays(df, "b", "o", most=9).collect()
    assert json_arrays(df.limit(0), "b", "o").count() == 0


def test_sources_at_the_same_time_see_their_own_tables(spark):
    found = {}

    def run(n):
        rows = spark.range(n).withColumnRenamed("id", "x")
        found[n] = sql_source(spark, "WITH y AS (SELECT * FROM `t-1`) SELECT COUNT(*) AS n FROM y WHERE x >= :least;", {"least": 1}, {"t-1": rows})

    threads = [threading.Thread(target=run, args=(n,)) for n in range(2, 10)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert {n: df.first()["n"] for n, df in found.items()} == {n: n - 1 for n in range(2, 10)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("source_")]
    ordered = sql_source(spark, "SELECT x FROM t ORDER BY x DESC", tables={"t": spark.range(5).withColumnRenamed("id", "x")})
    assert [r["x"] for r in ordered.collect()] == [4, 3, 2, 1, 0]


@pytest.mark.parametrize("keys", [3, 101, 301])
def test_mapping_and_lookup_beside_maps(spark, keys):
    df = spark.range(20).selectExpr("id % 5 AS k", "map(id, array(map('a', id))) AS m", "array(struct(map('b', id) AS n)) AS l", "named_struct('d', map('c', id)) AS s")
    mapped = map_values(df, {i: f"v{i}" for i in range(1, keys + 1)}, "k", "out", default="none")
    assert {(r["k"], r["out"]) for r in mapped.collect()} == {(0, "none"), (1, "v1"), (2, "v2"), (3, "v3"), (4, "v4" if keys > 3 else "none")}
    dim = spark.createDataFrame([(1, "x", {"p": 1}), (2, "y", None)], "id int, name string, tags map<string,int>")
    for salts in (1, 4):
        got = enrich(df, dim, "k", "id", salts=salts)
        assert got.count() == 20 and {(r["k"], r["name"]) for r in got.collect()} == {(0, None), (1, "x"), (2, "y"), (3, None), (4, None)}
    assert df.where(F.col("k").isNull()).count() == 0


def test_top_buckets_need_no_single_task(spark):
    for name in ("bucket_nested_top", "bucket_nested_top_three"):
        if name in queries():
            plan = plan_of(queries()[name](spark, SF))
            assert "Exchange SinglePartition" not in plan, name


def test_attributes_are_checked_after_user_code(spark):
    from meterflow.operators.normalize import to_metrics
    from meterflow.operators.rows import transform_frame, transform_rows
    frame = to_metrics(spark.createDataFrame([(1, "a")], "m int, t string"), "x", "m", ["t"])
    for bad in ("CAST('x' AS BINARY)", "named_struct('a', array(CAST('x' AS BINARY)))", "map(array(1), 2)", "INTERVAL '1' DAY"):
        with pytest.raises(ValueError):
            transform_rows(frame, {"t": bad})
    for field, bad in (("attributes", "'text'"), ("metric_field", "7")):
        with pytest.raises(TypeError):
            transform_frame(frame, lambda df, f=field, b=bad: df.withColumn(f, F.expr(b)))
    assert transform_rows(frame, {"t": "map('a', array(1D))", "n": "named_struct('d', current_date())"}).count() == 1


def test_python_over_frames_is_bounded(spark):
    from meterflow.operators.rows import transform_groups
    df = spark.createDataFrame([(i, i % 3 if i % 4 else None) for i in range(40)], "i long, k long")
    got = transform_groups(df, ["k"], lambda rows: rows.assign(i=len(rows)).head(1))
    assert sorted((r["i"], str(r["k"])) for r in got.collect()) == [(10, "0"), (10, "1"), (10, "2"), (10, "None")]
    with pytest.raises(Exception, match="more than 9 rows"):
        transform_groups(df, ["k"], lambda rows: rows, most=9).count()


def test_maps_become_columns_of_known_keys(spark):
    from meterflow.operators.flatten import flatten, known_keys
    df = spark.sql("SELECT * FROM VALUES (1, map('a', named_struct('x', 1)), map(7, 2)), (2, map('b', named_struct('x', 3)), NULL), (3, NULL, map()) AS t(i, m, n)")
    assert known_keys(df, "m") == ["a", "b"]
    got = flatten(df, maps={"m": ["a", "b"], "n": ["7"]})
    assert got.columns == ["i", "m.a.x", "m.b.x", "n.7"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, None, 2), (2, None, 3, None), (3, None, None, None)]
    with pytest.raises(Exception, match="other keys: b"):
        flatten(df, maps={"m": ["a"]}).collect()
    with pytest.raises(ValueError):
        known_keys(df, "m", most=1)
