"""Keyed state, logs of batches and mergeable bucket states."""

import datetime as dt
import itertools
import random
from functools import partial

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from meterflow.operators.bucket_state import bucket_state, merge_state, read_state
from meterflow.operators.buckets import DateHistogram, Filters, Histogram, Terms, bucket_agg
from meterflow.streaming.batch_log import BatchLog
from meterflow.streaming.run import total_counts
from meterflow.streaming.runs import RunGroups, Runs, RunTracker, pending_runs, track_runs

SF = "/root/testdata/sf0.001"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


MESSAGES = [
    ("in order", "start", 1, None), ("in order", "end", 2, "okay"),
    ("repeated", "start", 3, None), ("repeated", "start", 3, None), ("repeated", "end", 4, "failed"), ("repeated", "end", 4, "failed"),
    ("never ends", "start", 5, None), ("too long", "start", 6, None), ("too long", "end", 40, "okay"),
    ("no start", "end", 7, "okay"), ("pending", "start", 100, None), ("late start", "end", 101, "skipped"), ("late start", "start", 99, None),
    ("odd", "start", None, None), (None, "start", 8, None), ("odd", "middle", 9, None),
]


@pytest.mark.parametrize("order", range(3))
def test_runs_do_not_depend_on_the_order_of_reading(spark, tmp_path, order):
    rows = MESSAGES if order == 0 else MESSAGES[::-1] if order == 1 else random.Random(5).sample(MESSAGES, len(MESSAGES))
    schema = "name string, what string, at timestamp, outcome string, extra int"
    cut = len(rows) // 2
    for part in (rows[:cut], rows[cut:]):
        data = [(n, k, None if m is None else at(m), r, 1) for n, k, m, r in part]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    # an hour of lateness covers the order of reading; what began before minute 21 is over when it ends
    runs = track_runs(stream, "20m", "1h", run="name", kind="what", ts="at", result="outcome")
    query = runs.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    got = {r["run"]: (r["started_at"], r["finished_at"], r["result"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {
        "in order": (at(1), at(2), "okay"), "repeated": (at(3), at(4), "failed"), "never ends": (at(5), at(25), "lost"),
        "too long": (at(6), at(26), "lost"), "late start": (at(99), at(101), "skipped"),
    }
    assert [tuple(r) for r in pending_runs(spark, f"{tmp_path}/checkpoint").collect()] == [("pending", at(100))]


def counts(spark, rows):
    data = [(at(0), at(60), k, n) for k, n in rows]
    return spark.createDataFrame(data, "window_start timestamp, window_end timestamp, kind string, n long").coalesce(1)


def new_log(spark, tmp_path, every=2):
    return BatchLog(spark, str(tmp_path), "window_start timestamp, window_end timestamp, kind string, n long", partial(total_counts, keys=["kind"]), every)


def totals(log):
    return {r["kind"]: r["n"] for r in log.read().collect()}


def test_log_reads_few_folders_and_repeats_change_nothing(spark, tmp_path):
    log = new_log(spark, tmp_path)
    assert totals(log) == {} and log.folders() == []
    expected = {}
    for i in range(9):
        batch = [("a", i), (f"k{i % 3}", 1)]
        log.append(counts(spark, batch), i)
        for k, n in batch:
            expected[k] = expected.get(k, 0) + n
        # the newest batch again, as after a failure, then one that may be part of the snapshot
        log.append(counts(spark, batch), i)
        if i:
            log.append(counts(spark, [("a", i - 1), (f"k{(i - 1) % 3}", 1)]), i - 1)
        assert totals(log) == expected
        assert len(log.folders()) <= log.every + 2
    assert log.manifest()["version"] >= 3
    # what is kept on disk is bounded as well
    assert len(log.store.names("batches")) <= 2 * (log.every + 1) and len(log.store.names("snapshots")) <= 2 and len(log.store.names("manifests")) <= 2
    assert totals(new_log(spark, tmp_path)) == expected


def test_log_survives_failures_of_a_compaction(spark, tmp_path, monkeypatch):
    log = new_log(spark, tmp_path)
    for i in range(2):
        log.append(counts(spark, [("a", 1)]), i)
    publish = type(log.store).publish

    def broken(*args):
        raise OSError("lost")

    # the snapshot is written, its manifest is not
    monkeypatch.setattr(type(log.store), "publish", broken)
    with pytest.raises(OSError):
        log.append(counts(spark, [("a", 1)]), 2)
    assert totals(log) == {"a": 3}
    monkeypatch.setattr(type(log.store), "publish", publish)
    # the manifest is published, but nothing is swept
    monkeypatch.setattr(BatchLog, "_sweep", broken)
    with pytest.raises(OSError):
        log.append(counts(spark, [("a", 1)]), 2)
    monkeypatch.undo()
    assert totals(log) == {"a": 3} and log.manifest()["upto"] == 1
    log.append(counts(spark, [("a", 1)]), 2)
    log.append(counts(spark, [("a", 5)]), 3)
    assert totals(log) == {"a": 8}
    # a batch that was not written to its end is no batch
    (tmp_path / "batches" / "4").mkdir()
    assert totals(log) == {"a": 8}
    with pytest.raises(FileExistsError):
        log.store.publish(f"manifests/{log.manifest()['version']:012d}.json", "{}")


LEVELS = [Terms("kind", "k", top_n=3), Histogram("step", "v", 10.0), Terms("who", "w", top_n=2)]
METRICS = {"total": ("sum", "n"), "mean": ("avg", "n"), "least": ("min", "n"), "most": ("max", "n"), "known": ("count", "n"), "all": ("stats", "n")}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_merged_states_equal_one_aggregation(spark, depth):
    rng = random.Random(depth)
    rows = [(rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([1.0, 12.0, 35.0, None]), rng.choice(["x", "y", "z", None]), rng.choice([None, *range(9)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, v double, w string, n int")
    parts = [df.where(F.pmod(F.hash("k", "v", "w", "n"), F.lit(3)) == i) for i in range(3)]
    states = [bucket_state(p, LEVELS, METRICS) for p in parts]
    # merged in two steps, like a snapshot and a later batch
    first = merge_state(states[0].unionByName(states[1]), LEVELS, METRICS)
    got = read_state(first.unionByName(states[2]), LEVELS, METRICS, depth)
    expected = bucket_agg(df, LEVELS[:depth], METRICS)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_sketches_of_merged_states(spark):
    df = spark.range(20_000).selectExpr("'a' AS k", "id % 4321 AS who", "CAST(id AS DOUBLE) AS v", "CAST(id % 7 AS DOUBLE) AS few")
    metrics = {"who": ("cardinality", "who"), "few": ("cardinality", "few"), "p90": ("percentile", "v", 0.9)}
    states = [bucket_state(df.where(f"id % 5 = {i}".replace("id", "CAST(v AS BIGINT)")), LEVELS[:1], metrics) for i in range(5)]
    states = list(itertools.accumulate(states, lambda a, b: merge_state(a.unionByName(b), LEVELS[:1], metrics)))
    row = read_state(states[-1], LEVELS[:1], metrics).first()
    assert abs(row["who"] - 4321) < 0.08 * 4321 and row["few"] == 7 and abs(row["p90"] - 18_000) < 200
    assert max(len(v) for v in states[-1].first() if isinstance(v, (bytes, bytearray))) < 40_000


def test_states_that_cannot_merge_are_refused(spark):
    df = spark.range(3)
    for levels, metrics in (([], {}), ([Filters("f", {"a": "id > 1"})], {}), ([Terms("id", "id")], {"n": ("exact_cardinality", "id")})):
        with pytest.raises(ValueError):
            bucket_state(df, levels, metrics)
    empty = bucket_state(df.limit(0), [Terms("id", "id")], {"n": ("sum", "id")})
    assert read_state(empty, [Terms("id", "id")], {"n": ("sum", "id")}).count() == 0
    assert read_state(bucket_state(df, [DateHistogram("d", "timestamp_seconds(id)", "1d")]), [DateHistogram("d", "timestamp_seconds(id)", "1d")]).first()["doc_count"] == 3


class _Calls:
    """A state and timer handle that counts the calls, each of which is a round trip to the JVM."""

    def __init__(self):
        self.calls, self.value, self.timers = [], None, set()

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = tuple(value)

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def listTimers(self):
        self.calls.append("listTimers")
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.calls.append("registerTimer")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("deleteTimer")
        self.timers.discard(at)


def test_run_tracker_calls_the_state_few_times_per_run():
    from pyspark.sql import Row

    handle, tracker = _Calls(), RunTracker(300_000_000)
    tracker.init(handle)
    told = list(tracker.handleInputRows(("7",), iter([Row(kind="start", at=10**12, result=None), Row(kind="end", at=10**12 + 5, result="okay")]), None))
    assert [r.result for r in told] == ["okay"] and "listTimers" not in handle.calls and len(handle.calls) <= 3
    assert handle.timers == {(10**12 + 300_000_000) // 1000 + 1}
    # a repeated end changes nothing: the state is read, and neither it nor the timer is written
    handle.calls.clear()
    assert not list(tracker.handleInputRows(("7",), iter([Row(kind="end", at=10**12 + 9, result="failed")]), None))
    assert handle.calls == ["get"]
    # an end read before its start waits from the end, then from the start
    handle, tracker = _Calls(), RunTracker(300_000_000)
    tracker.init(handle)
    list(tracker.handleInputRows(("8",), iter([Row(kind="end", at=2 * 10**12, result="okay")]), None))
    list(tracker.handleInputRows(("8",), iter([Row(kind="start", at=2 * 10**12 - 7_000_000, result=None)]), None))
    assert handle.timers == {(2 * 10**12 - 7_000_000 + 300_000_000) // 1000 + 1}


class _Timers:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def getExpiryTimeInMs(self):
        return self.watermark


def _batch(processor, handle, key, rows, watermark):
    """What a processor tells of one batch: the rows first, then the timers that are due."""
    told = list(processor.handleInputRows(key, iter(rows), _Timers(watermark))) if rows else []
    for due in sorted(t for t in handle.timers if t <= watermark):
        told += processor.handleExpiredTimer(key, _Timers(watermark), _Timers(due))
        handle.timers.discard(due)
    return told


_PATIENCE = 3_000


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.tuples(
    st.sampled_from("abcde"), st.booleans(), st.integers(0, 12_000), st.sampled_from([None, "", "okay", "failed"])), max_size=12), max_size=6))
def test_groups_of_runs_tell_what_single_runs_tell(batches):
    handle, groups, singles = _Calls(), RunGroups(_PATIENCE), {}
    groups.init(handle)
    watermark = 0
    for messages in batches:
        expected, frames = [], []
        for k in range(0, len(messages), 5):  # a group's rows come in several frames
            part = messages[k:k + 5]
            frames.append(pd.DataFrame({"run": [m[0] for m in part], "starts": [m[1] for m in part], "at": [m[2] for m in part],
                                        "result": pd.Series([None if m[1] else m[3] for m in part], dtype=object)}))
        for run in "abcde":
            if run not in singles:
                singles[run] = _Calls(), RunTracker(_PATIENCE)
                singles[run][1].init(singles[run][0])
            rows = [Row(kind="start" if m[1] else "end", at=m[2], result=None if m[1] else m[3]) for m in messages if m[0] == run]
            expected += [tuple(r[c] for c in ("run", "started_at", "finished_at", "result")) for r in _batch(singles[run][1], singles[run][0], (run,), rows, watermark)]
        told = _batch(groups, handle, (0,), frames, watermark)
        assert sorted(map(repr, expected)) == sorted(repr((r.run, int(r.started_at), int(r.finished_at), r.result)) for part in told for r in part.itertuples())
        kept = Runs(handle.value[0]) if handle.value else Runs()
        held = {n: tuple(s[0].value) for n, s in singles.items() if s[0].value}
        assert {n: (s, f, r, bool(t)) for n, s, f, r, t in zip(kept.names.to_pylist(), kept.started, kept.finished, kept.results, kept.told, strict=True)} == {
            n: (2**63 - 1 if s is None else s, 2**63 - 1 if f is None else f, r, t) for n, (s, f, r, t) in held.items()}
        # one timer for the group, the earliest of its runs
        due = [t for s, _ in singles.values() for t in s.timers]
        assert handle.timers == ({min(due)} if due else set())
        watermark = max([watermark, *(m[2] // 1000 - 4 for m in messages)])


def test_a_group_of_runs_costs_as_few_calls_as_one_run():
    handle, groups = _Calls(), RunGroups(300_000_000)
    groups.init(handle)
    frame = pd.DataFrame({"run": [str(k // 2) for k in range(10_000)], "starts": [k % 2 == 0 for k in range(10_000)],
                          "at": [10**12 + k for k in range(10_000)], "result": pd.Series([None, "okay"] * 5_000, dtype=object)})
    assert sum(len(t) for t in groups.handleInputRows((0,), iter([frame]), None)) == 5_000 and len(handle.calls) <= 3
    handle.calls.clear()
    # repeated messages change nothing: the state is read, and neither it nor the timer is written
    assert not list(groups.handleInputRows((0,), iter([frame]), None)) and handle.calls == ["get"]
    due = handle.timers.pop()
    handle.calls.clear()
    assert not list(groups.handleExpiredTimer((0,), _Timers(due + 10**6), _Timers(due))) and handle.calls == ["get", "clear"]


@pytest.mark.parametrize("groups", [0, 3])
def test_state_has_a_row_for_each_group_of_runs(spark, tmp_path, groups):
    schema, n = "run string, kind string, ts timestamp, result string", 400
    first = [(f"r{k}", "start", at(k % 7), None) for k in range(n)]
    second = [(f"r{k}", "end", at(k % 7 + 1), "okay") for k in range(0, n, 2)]
    for part in (first, second):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    runs = track_runs(stream, "20m", "1h", groups=groups)
    runs.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    got = sorted((r["run"], r["started_at"], r["finished_at"], r["result"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted((f"r{k}", at(k % 7), at(k % 7 + 1), "okay") for k in range(0, n, 2))
    pending = sorted(tuple(r) for r in pending_runs(spark, f"{tmp_path}/c", groups).collect())
    assert pending == sorted((f"r{k}", at(k % 7)) for k in range(1, n, 2))
    state = spark.read.format("statestore").option("path", f"{tmp_path}/c").option("stateVarName", "runs" if groups else "run").load()
    assert state.count() == (groups or n)
