"""Runs followed through a stream of their start and end messages, with state kept for every run that is not over."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.functions.durations import micros

#: A run that did not end in time, next to the outcomes in its messages.
LOST = "lost"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# times are microseconds within the state
_RUN = "run string, started_at bigint, finished_at bigint, result string"
_STATE = "started_at bigint, finished_at bigint, result string, told boolean"

#: Groups that runs are dealt to by a hash of their name, each one state; part of a stream's checkpoint.
GROUPS = 1 << 12
_GROUP = pa.schema([
    ("run", pa.string()), ("started_at", pa.int64()), ("finished_at", pa.int64()), ("result", pa.string()), ("told", pa.bool_())])
_NEVER = np.iinfo(np.int64).max


class RunTracker(StatefulProcessor):
    """One run: waits for both messages in any order, tells the outcome once, forgets the run after ``patience``.

    A timer at the start (or, before it is known, the end) plus ``patience`` ends the wait. Times are event times, so the
    outcome does not depend on when or in which order the messages were read.
    """

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # every state or timer call is a round trip to the JVM: get() tells absence too, and the one timer of a run
        # follows from its stored state, so it need not be listed
        before = self.state.get()
        started, finished, result, told = before if before is not None else (None, None, None, False)
        for row in rows:
            if row.kind == "start":
                started = row.at if started is None else min(started, row.at)
            elif finished is None or (row.at, row.result or "") < (finished, result or ""):
                finished, result = row.at, row.result
        if started is not None and finished is not None and not told:
            told = True
            yield self._over(key[0], started, finished, result)
        after = (started, finished, result, told)
        if before is None or tuple(before) != after:
            self.state.update(after)
        self._wait(started if started is not None else finished, None if before is None else self._since(before))

    def _over(self, run: str, started: int, finished: int | None, result: str | None) -> Row:
        end = started + self.patience
        if finished is None or finished > end:
            finished, result = end, LOST
        return Row(run=run, started_at=started, finished_at=finished, result=result)

    @staticmethod
    def _since(state) -> int:
        return state[0] if state[0] is not None else state[1]

    def _due(self, since: int) -> int:
        return (since + self.patience) // 1000 + 1

    def _wait(self, since: int, known: int | None) -> None:
        """The timer at ``since`` plus patience, in place of the one at ``known``, the time the stored state waited from."""
        due = self._due(since)
        if known is not None and self._due(known) == due:
            return
        if known is not None:
            self.handle.deleteTimer(self._due(known))
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        value = self.state.get()
        if value is not None:
            started, finished, result, told = value
            # an end without a start tells nothing
            if started is not None and not told:
                yield self._over(key[0], started, finished, result)
            self.state.clear()


class Runs:
    """Runs of a group as columns: names, micros of start and end (``_NEVER`` if unknown), results, and who was told."""

    def __init__(self, stored: bytes | None = None):
        if stored is None:
            batch = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _GROUP], schema=_GROUP)
        else:
            batch = pa.ipc.read_record_batch(pa.py_buffer(stored), _GROUP)
        self.names, started, finished, results, told = batch.columns
        self.started, self.finished = (t.fill_null(_NEVER).to_numpy(zero_copy_only=False).copy() for t in (started, finished))
        self.results = np.array(results.to_pylist(), object)
        self.told = told.to_numpy(zero_copy_only=False).astype(bool)

    def stored(self) -> bytes:
        times = [pa.array(t, mask=t == _NEVER) for t in (self.started, self.finished)]
        batch = pa.RecordBatch.from_arrays([self.names, *times, pa.array(self.results, pa.string()), pa.array(self.told)], schema=_GROUP)
        return batch.serialize().to_pybytes()

    def read(self, names: list[str], starts: np.ndarray, at: np.ndarray, results: list[str | None]) -> None:
        """Messages added: the first start counts, and the first end; of ends at one time the smallest result."""
        known = len(self.names)
        both = pa.concat_arrays([self.names, pa.array(names, pa.string())]).dictionary_encode()
        self.names, run = both.dictionary, both.indices.to_numpy()[known:]  # known names keep their places
        more = len(self.names) - known
        self.started, self.finished = (np.concatenate([t, np.full(more, _NEVER)]) for t in (self.started, self.finished))
        self.results = np.concatenate([self.results, np.full(more, None, object)])
        self.told = np.concatenate([self.told, np.zeros(more, bool)])
        np.minimum.at(self.started, run[starts], at[starts])
        ends = np.flatnonzero(~starts)
        if not len(ends):
            return
        # ends read before come first among equals, then in the order of reading
        had = np.flatnonzero(self.finished != _NEVER)
        run, at = np.concatenate([had, run[ends]]), np.concatenate([self.finished[had], at[ends]])
        results = [*self.results[had], *(results[k] for k in ends)]
        ranks = {r: k for k, r in enumerate(sorted({r or "" for r in results}))}
        order = np.lexsort(([ranks[r or ""] for r in results], at, run))
        first = order[np.concatenate([[True], np.diff(run[order]) != 0])]
        self.finished[run[first]] = at[first]
        self.results[run[first]] = [results[k] for k in first]

    def due(self, patience: int) -> np.ndarray:
        """When each run is no longer waited for: milliseconds after ``patience`` from its start or, before it is known, its end."""
        since = np.where(self.started != _NEVER, self.started, self.finished)
        return since // 1000 + (since % 1000 + patience) // 1000 + 1

    def over(self, which: np.ndarray, patience: int) -> pd.DataFrame:
        started, finished, results = self.started[which], self.finished[which], self.results[which]
        lost = finished > started + patience
        return pd.DataFrame({
            "run": self.names.take(pa.array(which)).to_pylist(), "started_at": started,
            "finished_at": np.where(lost, started + patience, finished), "result": np.where(lost, LOST, results)})

    def keep(self, which: np.ndarray) -> None:
        self.names = self.names.filter(pa.array(which))
        self.started, self.finished, self.results, self.told = (c[which] for c in (self.started, self.finished, self.results, self.told))


class RunGroups(StatefulProcessor):
    """``RunTracker`` for all runs of a group at once: one state and one timer, the earliest of its runs, serve them all.

    A batch costs a few round trips for each group it has messages of, however many runs those are; the group's state, a
    part in ``GROUPS`` of all runs, is written again.
    """

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runs", "runs binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.state.get()
        runs = Runs(None if before is None else bytes(before[0]))
        waited = runs.due(self.patience).min(initial=_NEVER)
        for part in rows:
            results = [r if isinstance(r, str) else None for r in part["result"]]
            runs.read(part["run"].tolist(), part["starts"].to_numpy(bool), part["at"].to_numpy(np.int64), results)
        new = (runs.started != _NEVER) & (runs.finished != _NEVER) & ~runs.told
        runs.told |= new
        if new.any():
            yield runs.over(np.flatnonzero(new), self.patience)
        after = runs.stored()
        if before is None or after != bytes(before[0]):
            self.state.update((after,))
        due = runs.due(self.patience).min()
        if due != waited:
            if waited != _NEVER:
                self.handle.deleteTimer(int(waited))
            self.handle.registerTimer(int(due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        value = self.state.get()
        if value is not None:
            runs = Runs(bytes(value[0]))
            gone = runs.due(self.patience) <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            # an end without a start tells nothing
            lost = gone & (runs.started != _NEVER) & ~runs.told
            if lost.any():
                yield runs.over(np.flatnonzero(lost), self.patience)
            if gone.all():
                self.state.clear()
            elif gone.any():
                runs.keep(~gone)
                self.state.update((runs.stored(),))
                self.handle.registerTimer(int(runs.due(self.patience).min()))


def track_runs(
    stream: DataFrame, patience: str, late: str, run: str = "run", kind: str = "kind", ts: str = "ts", result: str = "result",
    groups: int = GROUPS,
) -> DataFrame:
    """``run, started_at, finished_at, result`` of every run that is over, in append mode.

    ``kind`` is ``start`` or ``end``; an end carries the result. Messages may come in any order, repeated, and up to
    ``late`` behind the newest. Of several starts the first counts, and the first end that was read. A run whose end is
    more than ``patience`` after its start, or does not come, is ``lost`` at that time; a run without a start is never
    told. State is kept for each run that began or ended within ``patience`` and ``late`` of the newest message, in one
    row for each of ``groups`` of runs; with 0 groups a run is a row of its own, for streams with few messages in a batch
    next to very many runs. The number of groups belongs to the checkpoint. Rows without a run, a time or a kind of message
    are left out.
    """
    spark = stream.sparkSession
    # keyed state with timers is only kept by this store
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.select(
        F.col(run).cast("string").alias("run"), F.col(kind).alias("kind"), F.col(ts).cast("timestamp").alias("ts"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.col(result).cast("string").alias("result"),
    ).where("run IS NOT NULL AND ts IS NOT NULL AND kind IN ('start', 'end')").withWatermark("ts", f"{micros(late)} microseconds")
    if groups:
        rows = rows.withColumn("starts", F.col("kind") == "start").drop("kind")
        rows = rows.withColumn("run_group", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int"))
        over = rows.groupBy("run_group").transformWithStateInPandas(RunGroups(micros(patience)), _RUN, "append", "eventTime")
    else:
        over = rows.groupBy("run").transformWithState(RunTracker(micros(patience)), _RUN, "append", "eventTime")
    return over.withColumns({c: F.timestamp_micros(c) for c in ("started_at", "finished_at")})


def _pending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0).to_pylist():
            runs = Runs(value)
            runs.keep(~runs.told & (runs.started != _NEVER))
            yield pa.RecordBatch.from_arrays([runs.names, pa.array(runs.started)], ["run", "started_at"])


def pending_runs(spark: SparkSession, checkpoint: str, groups: int = GROUPS) -> DataFrame:
    """``run, started_at`` of the runs that began and are not over, read from the state of a stopped ``track_runs`` query."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "runs" if groups else "run").load()
    if groups:
        pending = state.select("value.runs").mapInArrow(_pending, "run string, started_at bigint")
        return pending.select("run", F.timestamp_micros("started_at").alias("started_at"))
    return state.where("NOT value.told AND value.started_at IS NOT NULL").select(F.col("key.run").alias("run"), F.timestamp_micros("value.started_at").alias("started_at"))
