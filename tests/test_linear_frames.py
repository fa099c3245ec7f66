"""Trailing frames and metrics within intervals whose work stays linear when a frame or interval holds many rows."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from meterflow.operators.intervals import interval_totals
from meterflow.operators.rolling import rolling
from tests.test_plans import plan_of


def test_crowded_frames_are_running_values(spark):
    rng = random.Random(5)
    # many rows share a time, as in tables repeated with shifted keys
    times = [rng.randrange(0, 400) for _ in range(60)]
    rows = [(i, rng.choice(["a", "b"]), rng.choice([*times, None]), rng.choice([None, *range(-5, 9)])) for i in range(600)]
    df = spark.createDataFrame([(i, s, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), v) for i, s, t, v in rows], "i long, s string, t timestamp_ntz, v int")
    metrics = {"n": ("count", "v"), "x": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    found = rolling(df, ["s"], "t", "30s", metrics)
    # a sliding frame is recomputed at every row it moves: work grows with rows times frame
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+),", plan_of(found), re.I)
    assert frames and all(lower == "unboundedpreceding$()" for _, lower in frames)
    got = {r["i"]: (r["n"], r["x"], r["lo"], r["hi"], r["m"]) for r in found.collect()}
    assert len(got) == len(rows)
    for i, s, t, _ in rows:
        seen = [v for _, s2, t2, v in rows if s2 == s and t is not None and t2 is not None and t - 30 <= t2 <= t and v is not None]
        want = (len(seen), sum(seen) if seen else None, min(seen, default=None), max(seen, default=None), sum(seen) / len(seen) if seen else None)
        assert got[i] == ((None,) * 5 if t is None else want), i
    assert found.schema["x"].dataType.simpleString() == "bigint" and found.schema["n"].dataType.simpleString() == "bigint"


def test_interval_totals_against_all_pairs(spark):
    rng = random.Random(7)
    minute = 60_000_000
    times = [None, *[rng.randrange(-10**11, 10**11) for _ in range(40)]]
    rows = [(i, rng.choice(times), rng.choice([None, *range(-3, 6)])) for i in range(400)]
    spans = []
    for j in range(120):
        start = rng.choice([None, *[t for t in times if t is not None][:12], *[rng.randrange(-10**11, 10**11) for _ in range(9)]])
        length = rng.choice([0, -5, 1, minute, minute + 1, 8 * minute, 10**9, 10**11, 10**15, None])
        spans.append((j % 100, start, None if length is None or start is None else start + length))
    spans += [(100, 0, 1), (101, -10**17, 10**17), (101, -10**17, 10**17)]
    df = spark.createDataFrame(rows, "i long, t long, v int")
    intervals = spark.createDataFrame(spans, "j long, a long, b long")
    found = interval_totals(df, intervals, "t", "a", "b", {"n": ("count", None), "nv": ("count", "v"), "x": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "i")})
    got = sorted(tuple(r) for r in found.collect())
    want = []
    for j, a, b in spans:
        inside = [(i, v) for i, t, v in rows if t is not None and a is not None and a <= t and (b is None or t < b)]
        vs = [v for _, v in inside if v is not None]
        if inside:
            want.append((j, a, b, len(inside), len(vs), sum(vs) if vs else None, min(vs, default=None), max(i for i, _ in inside)))
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r)) or got == sorted(want, key=str) or sorted(map(str, got)) == sorted(map(str, want))


def test_intervals_metrics_makes_no_pairs(spark):
    from __spark_entry__ import queries
    plan = plan_of(queries()["intervals_metrics"](spark, "/root/testdata/sf0.001"))
    # a join of events with incidents holds every event of a week-long incident
    assert "Join" not in plan
