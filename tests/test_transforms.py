"""Filters, mapping, routing, time operators and user transforms."""

import datetime as dt
from fnmatch import fnmatchcase
from functools import partial

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow.functions.durations import micros
from meterflow.functions.globs import matches_any, name_regex, path_matches
from meterflow.operators.filters import condition, parse_condition, simple_filter, text_match
from meterflow.operators.mapping import map_values
from meterflow.operators.normalize import to_metrics
from meterflow.operators.routing import Route, route, unmatched_routes
from meterflow.operators.rows import transform_batches, transform_frame, transform_rows
from meterflow.operators.timeops import shift_time, time_range
from meterflow.plans.flow import Flow, Task, Transform, apply_by_priority


@pytest.fixture(scope="module")
def letters(spark):
    df = spark.createDataFrame(
        [((l,), i) for l, i in [("a", 1), ("b", 2), ("c", 3)]], "name struct<letter: string>, metric bigint"
    )
    return to_metrics(df, "letters")


def metrics(df):
    return [r["metric"] for r in df.collect()]


def values(df, name):
    return [r[name] for r in df.collect()]


# durations

@pytest.mark.parametrize("text, expected", [
    ("1h:30m:15s", 5_415_000_000), ("500ms", 500_000), (90, 90_000_000), ("90", 90_000_000), ("1.5", 1_500_000),
    ("1.5h", 5_400_000_000), ("-1h:1m", -3_660_000_000), ("1d", 86_400_000_000), (0, 0), ("2H", 7_200_000_000),
])
def test_durations(text, expected):
    assert micros(text) == expected


@pytest.mark.parametrize("text", ["abc", "1x", "h", "1h30", "1 2s"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        micros(text)


# globs

NAMES = ["", "a", "abc", "a.b", "a/b", "a\nb", "[x]", "x]", "a-b", "a^b", "a&&b", "A", "é", "a\n", "!", "a$b", "\\"]
PATTERNS = ["", "*", "?", "a*", "*b", "a?b", "[ab]*", "[!a]*", "[]x]*", "a[", "[x", "a[^]b", "a[&&]*b", "[a-c]*", "a.b",
            "a\\*", "[[]x]", "*\n*", "a$?", "[!]x]", "**", "a(b)|c"]


def test_name_patterns_match_like_fnmatch(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    for pattern in PATTERNS:
        got = {r["name"] for r in df.where(matches_any(F.col("name"), [pattern])).collect()}
        assert got == {n for n in NAMES if fnmatchcase(n, pattern)}, pattern
        got = {r["name"] for r in df.where(F.col("name").rlike(name_regex(pattern))).collect()}
        assert got == {n for n in NAMES if fnmatchcase(n, pattern)}, pattern


def test_path_patterns_stay_in_a_segment(spark):
    paths = ["/disk/a/x", "/disk/a/b/x", "/disk/.h/x", "/disk/a/.x", "/disk/a/", "/disk"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    hit = lambda pattern: {r["p"] for r in df.where(path_matches(F.col("p"), pattern)).collect()}
    assert hit("/disk/*/x") == {"/disk/a/x"}
    assert hit("/disk/.*/x") == {"/disk/.h/x"}
    assert hit("/disk/a/*") == {"/disk/a/x", "/disk/a/"}
    assert hit("/disk") == {"/disk"}


# filters

def test_keep_then_drop(letters):
    assert metrics(simple_filter(simple_filter(letters, "gt 1"), "gt 2", mode="drop")) == [2]


def test_conditions_are_checked(letters):
    assert parse_condition("eq x some field") == ("eq", "x", "some field")
    for bad in ("like x", "gt", ""):
        with pytest.raises(ValueError):
            parse_condition(bad)
    with pytest.raises(ValueError):
        simple_filter(letters, "gt 1", mode="maybe")
    with pytest.raises(ValueError):
        simple_filter(letters, "gt abc")
    with pytest.raises(ValueError):
        simple_filter(letters, "in 1")


def python_test(op, value, text):
    """The comparison in plain Python; a missing value orders as false."""
    if op == "nn":
        return value is not None
    if value is None:
        return op == "ne"
    try:
        other = type(value)(text)
    except ValueError:
        other = text
    if op == "in":
        return text in value
    if op in ("eq", "ne"):
        return (value == other) == (op == "eq")
    return {"lt": value < other, "le": value <= other, "ge": value >= other, "gt": value > other}[op]


@pytest.mark.parametrize("kind, cells, texts", [
    ("bigint", [None, -1, 0, 5, 2**60], ["0", "5", "-1"]),
    ("double", [None, -1.5, 0.0, 5.0, float("nan"), float("inf")], ["0", "5", "1.5", "nan", "inf"]),
    ("string", [None, "", "a", "ab", "5"], ["a", "5", "b"]),
])
def test_filters_agree_with_python(spark, kind, cells, texts):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"id int, metric {kind}")
    for op in ("lt", "le", "eq", "ne", "ge", "gt", "nn") + (("in",) if kind == "string" else ()):
        for text in texts:
            for mode in ("keep", "drop"):
                got = values(simple_filter(df, f"{op} {text}", mode=mode), "id")
                want = [i for i, c in enumerate(cells) if python_test(op, c, text) == (mode == "keep")]
                assert got == want, (op, text, mode)


def test_unparsable_text_equals_nothing(letters):
    assert metrics(simple_filter(letters, "eq abc")) == []
    assert metrics(simple_filter(letters, "ne 1.5")) == [1, 2, 3]


def test_large_and_dated_values(spark):
    df = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 1)), (2, 2**62, dt.datetime(2024, 1, 2))], "id int, n bigint, ts timestamp_ntz")
    assert values(simple_filter(df, f"lt {2**70} n"), "id") == [1, 2]
    assert values(simple_filter(df, f"eq {2**70} n"), "id") == []
    assert values(simple_filter(df, "gt 2024-01-01 ts"), "id") == [2]
    assert values(simple_filter(df, "ne soon ts"), "id") == [1, 2]
    with pytest.raises(ValueError):
        simple_filter(df, "gt soon ts")


def test_containment_in_nested_values(spark):
    df = spark.createDataFrame(
        [(1, ["x", None], {"k": 1}, (5,)), (2, [], {}, None)], "id int, l array<string>, m map<string,int>, s struct<f: int>"
    )
    assert values(simple_filter(df, "in x l"), "id") == [1]
    assert values(simple_filter(df, "in k m"), "id") == [1]
    assert values(simple_filter(df, "in f s"), "id") == [1]
    assert values(simple_filter(df, "in f s", mode="drop"), "id") == [2]


def test_booleans_and_strict(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, metric boolean")
    assert values(simple_filter(df, "eq False"), "id") == [2]
    with pytest.raises(Exception, match="missing value"):
        simple_filter(df, "gt false", strict=True).collect()


def test_text_match(spark):
    df = spark.createDataFrame([(1, "The end."), (2, "these"), (3, "ÉTÉ, the"), (4, None)], "id int, t string")
    assert values(text_match(df, "t", "the"), "id") == [1, 3]
    assert values(text_match(df, "t", ["the", "été"], mode="all"), "id") == [3]
    assert values(text_match(df, "t", "t.e end"), "id") == [1]


# mapping

def test_mapping_with_default(letters):
    got = map_values(letters, {1: "hello", 2: "world"}, "metric", default="unknown")
    assert metrics(got) == ["hello", "world", "unknown"]
    assert values(got.select("attributes.name.letter"), "letter") == ["a", "b", "c"]


def test_mapping_raises_on_missing(letters):
    with pytest.raises(Exception, match="no mapping for key 3"):
        map_values(letters, {1: "hello", 2: "world"}, "metric").collect()
    assert metrics(map_values(letters, {1: 1, 2: 4, 3: 9}, "metric")) == [1, 4, 9]


def test_missing_modes(letters):
    table = {1: 10}
    assert metrics(map_values(letters, table, "metric", missing="original")) == [10, 2, 3]
    assert metrics(map_values(letters, table, "metric", missing="nothing")) == [10, 2, 3]
    assert metrics(map_values(letters, table, "metric", missing="default")) == [10, None, None]
    casted = map_values(letters, {"1": "one"}, "metric", "shown", cast="str", missing="original_casted")
    assert values(casted.select("attributes.shown"), "shown") == ["one", "2", "3"]
    unset = map_values(letters, {1: "x"}, "metric", "shown", missing="nothing")
    assert values(unset.select("attributes.shown"), "shown") == ["x", None, None]


def test_presence_decides_not_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "metric string")
    assert values(map_values(df, {"a": None}, "metric", default="d"), "metric") == [None, "d", "d"]
    assert values(map_values(df, {None: "none"}, "metric", missing="original"), "metric") == ["a", "b", "none"]
    assert values(map_values(df, {}, "metric", missing="original"), "metric") == ["a", "b", None]


def test_keys_compare_by_value_and_type(spark):
    df = spark.createDataFrame([(1.0, "1", True)], "d double, s string, b boolean")
    assert values(map_values(df, {1: "hit"}, "d", "r", default="no"), "r") == ["hit"]
    assert values(map_values(df, {1: "hit"}, "s", "r", default="no"), "r") == ["no"]
    assert values(map_values(df, {1: "hit"}, "b", "r", default="no"), "r") == ["hit"]
    assert values(map_values(df, {"True": "hit"}, "b", "r", cast="str", default="no"), "r") == ["hit"]
    assert values(map_values(df, {True: "hit"}, "s", "r", cast="bool", default="no"), "r") == ["hit"]
    assert values(map_values(df, {1: "hit"}, "s", "r", cast="int", default="no"), "r") == ["hit"]


def test_mixed_values_become_text(letters):
    assert metrics(map_values(letters, {1: "x", 2: 5}, "metric", default=True)) == ["x", "5", "True"]
    assert metrics(map_values(letters, {1: "x"}, "metric", missing="original")) == ["x", "2", "3"]


def test_large_mapping_is_joined(spark):
    df = spark.range(500).select(F.col("id").alias("metric"))
    big = {i: i * 2 for i in range(300)}
    got = sorted(values(map_values(df, big, "metric", "r", default=-1), "r"))
    assert got == sorted([i * 2 for i in range(300)] + [-1] * 200)
    with pytest.raises(Exception, match="no mapping"):
        map_values(df, big, "metric").collect()


def test_mapping_by_the_metric_field(spark):
    df = to_metrics(spark.createDataFrame([(1,), (2,)], "n int"), "t", "n")
    got = map_values(df, {1: "one"}, "n", default="other")
    assert metrics(got) == ["one", "other"] and got.select("attributes.*").columns == []


# routing

def test_route_rules():
    assert Route().accepts("in", "task")
    assert Route(include_tasks="T*").accepts("in", "TASK")
    assert not Route(include_tasks="t*", exclude_inputs="in").accepts("in", "task")
    with pytest.raises(ValueError):
        Route(include_tasks="a", exclude_tasks="b")
    assert not Route(include_tasks=[]).accepts("in", "task")


def test_rows_and_driver_decide_alike(spark):
    names = [(i, t) for i in ("db", "http-1", "http-2") for t in ("alpha", "beta", "beta.x")]
    df = spark.createDataFrame(names, "input_name string, task_name string")
    for r in [
        dict(include_tasks="b*"), dict(exclude_tasks=["*x", "alpha"]), dict(include_inputs="http-[12]"),
        dict(include_tasks="beta", exclude_inputs="d?"), dict(include_tasks=[]), dict(exclude_tasks=[]),
    ]:
        for lowered in (False, True):
            got = [tuple(x) for x in route(df, lowered=lowered, **r).collect()]
            assert got == [n for n in names if Route(**r).accepts(*n)]


def test_lowered_routes_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("event_type", "task_name")
    plan = route(df.withColumn("input_name", F.lit("x")), lowered=True, include_tasks="view")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(task_name,view)" in text or "EqualTo(event_type,view)" in text


def test_unmatched_on_empty_table(spark):
    df = spark.createDataFrame([], "input_name string, task_name string")
    got = unmatched_routes(df, Route(include_tasks=["a", "b*"]))
    assert sorted(values(got, "pattern")) == ["a", "b*"]
    assert unmatched_routes(df).count() == 0


def test_priorities_are_stable(letters):
    order = []

    def step(name):
        def apply(df):
            order.append(name)
            return df
        return apply

    flow = Flow([], [
        Transform(step("low"), priority=-1), Transform(step("a")), Transform(step("b")),
        Transform(step("top"), priority=9), Transform(step("other"), Route(include_tasks="x*")),
        Transform(step("off"), enabled=False),
    ])
    task = Task("Letters", letters.select("metric"))
    flow.plan(task, task.source)
    assert order == ["top", "a", "b", "low"] and task.name == "letters"
    with pytest.raises(ValueError):
        Transform(step("x"), priority=300)


def test_routed_transforms_on_one_table(spark):
    df = spark.createDataFrame([("a", "in", 1), ("b", "in", 1), ("b", "in", 5)], "task_name string, input_name string, metric int")
    got = apply_by_priority(df, [
        Transform(partial(map_values, mapping={1: 7}, key="metric", missing="original"), Route(include_tasks="a"), 5),
        Transform(partial(simple_filter, cond="gt 3"), Route(exclude_tasks="a")),
    ])
    assert [tuple(r) for r in got.select("task_name", "metric").collect()] == [("a", 7), ("b", 5)]


# time

def test_modulus_then_offset(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-03-01 13:45:59.123456' ts, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' old")
    assert values(shift_time(df, "1d", "1h", ts="ts"), "ts") == [dt.datetime(2024, 2, 29, 23)]
    assert values(shift_time(df, ts="ts"), "ts") == [dt.datetime(2024, 3, 1, 13, 45, 59)]
    assert values(shift_time(df, 0, "-1s", ts="ts"), "ts") == [dt.datetime(2024, 3, 1, 13, 46, 0, 123456)]
    assert values(shift_time(df, "1h", ts="old"), "old") == [dt.datetime(1969, 12, 31, 23)]


def test_range_of_the_search_example(spark):
    hour = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [(i, ((hour - dt.timedelta(minutes=i + 10)).isoformat(),)) for i in range(120)], "i int, metadata struct<timestamp: string>"
    )
    anchor = hour + dt.timedelta(minutes=17)
    # the first document lies exactly on the excluded upper bound
    assert sorted(values(time_range(df, "now/h-30m", "now/h-10m", anchor=anchor), "i")) == list(range(1, 21))
    assert len(values(time_range(df, "now/h-30m", "now/h-10m", anchor=anchor, lower="gt", upper="lte"), "i")) == 20
    broken = df.union(spark.createDataFrame([(-1, ("not a time",))], df.schema))
    assert time_range(broken, "2020-01-01", hour).count() == 120
    with pytest.raises(ValueError):
        time_range(df, "now-5q")
    with pytest.raises(ValueError):
        time_range(df, "now", lower="ge")


def test_ranges_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-15 12:00:00Z' ts, TIMESTAMP_NTZ'2024-01-15 12:00:00' local")
    anchor = dt.datetime(2024, 1, 15, 12, 30)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for name in ("ts", "local"):
            assert time_range(df, "now-31m", "now-29m", name, anchor).count() == 1, name
            assert time_range(df, "2024-01-15 12:00:00", "2024-01-15T12:00:01", name).count() == 1, name
            assert time_range(df, "now-1h", "now", name).count() == 0
        now = df.select(F.current_timestamp().alias("ts"), F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")).alias("local"))
        for name in ("ts", "local"):
            assert time_range(now, "now-1h", "now+1h", name).count() == 1, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# user transforms

def test_nested_field_per_metric(letters):
    got = transform_rows(letters, {"field": "named_struct('x', 1)", "field.nested": "int('123')"})
    assert values(got.select("attributes.field.nested"), "nested") == [123, 123, 123]


def test_python_over_nested_rows(letters):
    def upper(pdf):
        letter = pdf["attributes"].map(lambda a: {"name": {"letter": a["name"]["letter"].upper()}})
        return pdf.assign(attributes=letter, metric=pdf["metric"] * 2)

    got = [(r["metric"], r["attributes"]["name"]["letter"]) for r in transform_batches(letters, upper).collect()]
    assert got == [(2, "A"), (4, "B"), (6, "C")]


def test_batches_may_drop_and_add(letters):
    flat = letters.select("metric")
    got = transform_batches(flat, lambda pdf: pdf[pdf.metric > 1].assign(twice=lambda p: p.metric * 2), "metric bigint, twice bigint")
    assert [tuple(r) for r in got.collect()] == [(2, 4), (3, 6)]
    with pytest.raises(TypeError):
        transform_frame(letters, lambda df: None)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["lt", "ge", "eq", "ne"]), st.integers(-5, 5)), min_size=1, max_size=4))
def test_filter_chains(spark, chain):
    df = spark.range(-6, 7).withColumnRenamed("id", "metric")
    want = list(range(-6, 7))
    for op, bound in chain:
        df = simple_filter(df, f"{op} {bound}")
        want = [v for v in want if python_test(op, v, str(bound))]
    assert sorted(metrics(df)) == want
