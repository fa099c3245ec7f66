"""Normalisation, flattening and nested updates on small rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.operators.flatten import drop_field, flatten, flatten_array, merge_fields, set_field
from meterflow.operators.normalize import select_fields, to_metrics


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(
        [((l,), i) for l, i in [("a", 1), ("b", 2), ("c", 3)]], "name struct<letter: string>, metric bigint"
    )


def test_patterns_take_each_field_once(spark):
    df = spark.createDataFrame([(1, 2, 4, 3, 5)], "field int, field_a int, gg int, sfield int, fieldg int")
    got = rows(to_metrics(df, "t", ["field*", "*g"]))
    assert {r["metric_field"]: r["metric"] for r in got} == {"field": 1, "field_a": 2, "fieldg": 5, "gg": 4}
    assert all(r["attributes"] == {"sfield": 3} for r in got)


def test_pattern_order_then_field_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert list(select_fields(df.schema, ["c", "[!c]", "*"])) == ["c", "a", "b"]


def test_default_metric_and_nested_attribute(letters):
    got = rows(to_metrics(letters, "t"))
    assert [r["metric"] for r in got] == [1, 2, 3]
    assert [r["attributes"]["name"]["letter"] for r in got] == ["a", "b", "c"]


def test_documented_example(spark):
    df = spark.createDataFrame([(4, 9, 3, 6, 1)], "a int, b int, c int, d int, e int")
    got = rows(to_metrics(df, "t", ["a", "b"], ["c", "d"]))
    assert [(r["metric"], r["attributes"]) for r in got] == [(4, {"c": 3, "d": 6}), (9, {"c": 3, "d": 6})]


def test_nested_field_leaves_its_parent(spark):
    df = spark.createDataFrame([Row(s=Row(a=1, b=Row(c=2, d="x")), k=5)])
    got = rows(to_metrics(df, "t", "s.b.c"))
    assert got[0]["metric"] == 2 and got[0]["attributes"] == {"s": {"a": 1, "b": {"d": "x"}}, "k": 5}
    got = rows(to_metrics(df, "t", ["s.*c", "s.a"], ["s"]))
    assert [(r["metric_field"], r["metric"]) for r in got] == [("s.b.c", 2), ("s.a", 1)]
    assert got[0]["attributes"] == {"s": {"b": {"d": "x"}}}


def test_pattern_crosses_levels_and_empty_parent_goes(spark):
    df = spark.createDataFrame([Row(s=Row(a=1, b=Row(c=2)), k="x")])
    got = rows(to_metrics(df, "t", "s.*"))
    assert [r["metric_field"] for r in got] == ["s.a", "s.b.c"] and got[0]["attributes"] == {"k": "x"}


def test_fields_named_like_frame_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, "x", 5)], "seq int, metric int, metric_ts int, task_name string, attributes int")
    got = rows(to_metrics(df, "t", ["seq", "metric", "metric_ts", "attributes"], seq="seq"))
    assert [(r["metric_field"], r["metric"], r["seq"]) for r in got] == [("seq", 1, 1), ("metric", 2, 1), ("metric_ts", 3, 1), ("attributes", 5, 1)]
    assert got[0]["attributes"] == {"task_name": "x"} and got[0]["task_name"] == "t"


def test_field_name_with_separator(spark):
    df = spark.createDataFrame([(1, "x")], "`a.b` int, c string")
    got = rows(to_metrics(df, "t", "a.b"))
    assert got[0]["metric"] == 1 and got[0]["metric_field"] == "a.b" and got[0]["attributes"] == {"c": "x"}


def test_static_attributes_win(spark):
    df = spark.createDataFrame([(1, "own")], "metric int, site string")
    got = rows(to_metrics(df, "t", static={"site": "fixed", "n": [1, 2], "o": {"p": None}}))
    assert got[0]["attributes"] == {"site": "fixed", "n": [1, 2], "o": {"p": None}}


def test_no_metric_field(letters):
    with pytest.raises(ValueError):
        to_metrics(letters, "t", "missing")
    got = rows(to_metrics(letters, "t", None, allow_none=True))
    assert len(got) == 3 and got[0]["metric"] is None and got[0]["metric_field"] is None
    assert got[0]["attributes"] == {"name": {"letter": "a"}, "metric": 1}


def test_text_is_no_metric(spark):
    df = spark.createDataFrame([("1", 2)], "metric string, other int")
    with pytest.raises(ValueError):
        to_metrics(df, "t")
    with pytest.raises(ValueError):
        to_metrics(df, "t", "*")


def test_nulls_kept_or_absent(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert len(rows(to_metrics(df, "t", ["a", "b"]))) == 4
    assert [r["metric"] for r in rows(to_metrics(df, "t", ["a", "b"], drop_absent=True))] == [1, 2]
    with pytest.raises(Exception, match="none of the metrics"):
        rows(to_metrics(df.where("b IS NULL AND a IS NULL").union(spark.createDataFrame([(None, None)], df.schema)), "t", ["a", "b"], drop_absent=True))


def test_absent_everywhere(spark):
    df = spark.createDataFrame([(None, None, "x"), (2, None, "y")], "a int, b int, k string")
    got = [(r["metric_field"], r["metric"], r["attributes"]["k"]) for r in rows(to_metrics(df, "t", ["a", "b"], drop_absent=True, allow_none=True))]
    assert got == [(None, None, "x"), ("a", 2, "y")]
    single = rows(to_metrics(df, "t", "b", drop_absent=True, allow_none=True))
    assert [r["metric_field"] for r in single] == [None, None]


def test_metric_types(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.5, True, big)], "i bigint, d double, b boolean, j bigint")
    ints = to_metrics(df, "t", ["i", "j"])
    assert ints.schema["metric"].dataType.simpleString() == "bigint" and rows(ints)[0]["metric"] == big
    assert to_metrics(df, "t", ["i", "d"]).schema["metric"].dataType.simpleString() == "double"
    assert to_metrics(df, "t", "b").schema["metric"].dataType.simpleString() == "boolean"
    assert [r["metric"] for r in rows(to_metrics(df, "t", ["b", "d"]))] == [1.0, 1.5]


def test_nan_and_negative_zero_survive(spark):
    df = spark.createDataFrame([(float("nan"), -0.0)], "a double, b double")
    a, b = [r["metric"] for r in rows(to_metrics(df, "t", ["a", "b"]))]
    assert math.isnan(a) and math.copysign(1, b) == -1


def test_frame_columns_and_empty_input(spark):
    df = spark.createDataFrame([], "metric int, k string")
    out = to_metrics(df, "t", ts=F.lit(dt.datetime(2024, 1, 1)), input_name="in")
    assert out.columns == ["input_name", "task_name", "metric_ts", "metric_field", "metric", "attributes"]
    assert out.count() == 0
    only = spark.createDataFrame([(7,)], "metric int")
    assert rows(to_metrics(only, "t"))[0]["attributes"] == {}


def test_flatten(spark):
    df = spark.createDataFrame(
        [(1, True, [1, 2, 3], (1.5, (False,)), (-1,))],
        "a int, b boolean, c array<int>, d struct<e: double, f: struct<g: boolean>>, `h.i` struct<j: int>",
    )
    out = flatten(df, max_array=3)
    assert out.columns == ["a", "b", "c.0", "c.1", "c.2", "d.e", "d.f.g", "h.i.j"]
    assert list(out.first()) == [1, True, 1, 2, 3, 1.5, False, -1]
    assert flatten(df.drop("c"), sep="#").columns == ["a", "b", "d#e", "d#f#g", "h.i#j"]
    with pytest.raises(ValueError):
        flatten(df)
    with pytest.raises(Exception, match="longer than 2"):
        flatten(df, max_array=2).collect()


def test_flatten_lists_of_records(spark):
    df = spark.createDataFrame([([(1, [5]), (2, [])],)], "r array<struct<a: int, b: array<int>>>")
    out = flatten(df, max_array=2)
    assert out.columns == ["r.0.a", "r.0.b.0", "r.0.b.1", "r.1.a", "r.1.b.0", "r.1.b.1"]
    assert list(out.first()) == [1, 5, None, 2, None, None]


def test_flatten_array(spark):
    df = spark.createDataFrame([(1, ([10, None],)), (2, ([],)), (3, (None,))], "id int, s struct<v: array<int>>")
    got = [tuple(r) for r in flatten_array(df, "s.v", ["id"]).collect()]
    assert got == [(1, "s.v.0", 10), (1, "s.v.1", None)]


def test_set_get_drop(letters):
    df = to_metrics(letters, "t")
    df = set_field(df, "field", F.struct(F.lit(0).alias("old")))
    df = set_field(df, "field.nested", F.lit(123))
    got = rows(df)
    assert all(r["attributes"]["field"] == {"old": 0, "nested": 123} for r in got)
    assert frame.field(df, "field.nested")[1].simpleString() == "int"
    with pytest.raises(ValueError):
        set_field(df, "nothing.nested", F.lit(1))
    assert "name" not in rows(drop_field(df, "name"))[0]["attributes"]
    with pytest.raises(ValueError):
        drop_field(df, "field.nested")


def test_metric_is_addressed_by_its_field(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    single = set_field(to_metrics(df, "t", "a"), "a", F.lit(9))
    assert rows(single)[0]["metric"] == 9 and rows(single)[0]["attributes"] == {"b": 2}
    both = rows(set_field(to_metrics(df, "t", ["a", "b"]), "a", F.lit(9)))
    assert [(r["metric"], r["attributes"]) for r in both] == [(9, {"a": None}), (2, {"a": 9})]


def test_set_on_empty_attributes(spark):
    df = to_metrics(spark.createDataFrame([(7,)], "metric int"), "t")
    assert rows(set_field(df, "x", F.lit("y")))[0]["attributes"] == {"x": "y"}


def test_merge_right_side_wins(letters):
    df = merge_fields(to_metrics(letters, "t"), {"name": F.lit("flat"), "extra": F.col("metric") * 2})
    assert rows(df)[0]["attributes"] == {"name": "flat", "extra": 2}


def test_unknown_field_fails(letters):
    from meterflow.operators.filters import simple_filter

    with pytest.raises(Exception, match="no field"):
        simple_filter(to_metrics(letters, "t"), "eq 1 missing").collect()
