"""Properties of the physical plans that matter once tables are large."""

import re

import pytest

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"
PYTHON = {"udf_metric", "udf_frame_groups"}
STREAMS = {"stream_event_counts", "stream_flow", "topic_messages"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMS))
def test_no_pairwise_joins_and_no_row_python(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name, pushed", [
    ("filter_ge", "GreaterThanOrEqual(o_totalprice,150000.0)"),
    ("filter_lt", "LessThan(value,50.5)"),
    ("filter_eq", "EqualTo(o_orderstatus,P)"),
    ("filter_in", "StringContains(o_orderpriority,URG)"),
    ("filter_chain", "GreaterThan(value,1.0)"),
    ("timerange_filter", "GreaterThan(ts,2024-01-04T00:00)"),
    ("search_documents", "EqualTo(lang,en)"),
    ("search_timerange_buckets", "GreaterThanOrEqual(ts,2024-01"),
    ("search_count", "EqualTo(event_type,error)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name, columns", [
    ("metrics_multi", {"l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"}),
    ("bucket_terms", {"l_returnflag", "l_quantity"}),
    ("bucket_filters", {"l_quantity", "l_extendedprice", "l_returnflag"}),
    ("gauge_last_value", {"event_id", "ts", "user_id", "event_type", "value"}),
    ("text_match", {"doc_id", "text", "lang", "n_chars"}),
    ("priority_chain", {"event_id", "event_type", "value"}),
])
def test_scans_read_only_needed_columns(spark, name, columns):
    df = queries()[name](spark, SF_DIR)
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(df))
    read = {c.split("#")[0] for s in schemas for c in s.split(",") if c}
    assert read == columns


@pytest.mark.parametrize("name", [
    "metrics_multi", "metrics_glob", "metrics_nested", "flatten_struct", "time_modulus", "filter_drop", "route_combined",
    "map_default", "priority_chain", "text_match", "json_lines", "envelope_json", "report_unpivot", "flatten_buckets",
])
def test_row_operators_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name, exchanges", [
    ("bucket_terms", 1), ("bucket_nested", 1), ("bucket_filters_above", 1), ("bucket_date_histogram", 1),
    ("gauge_last_value", 1), ("gauge_last_hot_series", 1), ("run_result_summaries", 1), ("udf_frame", 1),
])
def test_one_shuffle_of_partial_results(spark, name, exchanges):
    plan = plan_of(queries()[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == exchanges
    assert "partial_" in plan


def test_top_buckets_are_cut_before_the_shuffle(spark):
    nested = plan_of(queries()["bucket_nested_top"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", nested)
    assert "TakeOrderedAndProject" in plan_of(queries()["bucket_terms_top"](spark, SF_DIR))
