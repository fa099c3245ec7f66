"""Summaries of a run log and of a message log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.durations import micros
from meterflow.operators.timeops import floor_time, moment

# Outcomes of a run, and the standard log levels with their numbers.
RESULTS = ("okay", "skipped", "failed")
LEVELS = {"NOTSET": 0, "DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}
# Other names of the same levels.
LEVEL_ALIASES = {"WARN": "WARNING", "FATAL": "CRITICAL"}


def run_summary(
    runs: DataFrame,
    start: dt.datetime | str | Column,
    end: dt.datetime | str | Column,
    result: str = "result",
    finished: str = "finished_at",
) -> DataFrame:
    """Runs that ended in ``[start, end)``, counted per result; all results appear.

    A pending run has no end time and counts in the interval in which it ends.
    """
    first, last = _bounds(runs, finished, start, end)
    inside = runs.where((F.col(finished) >= first) & (F.col(finished) < last))
    counts = inside.agg(*_result_counts(result))
    return counts.select(
        F.inline(_result_rows()), first.alias("timestamp_from"), last.alias("timestamp_to")
    )


def run_summaries(
    runs: DataFrame, every: str, result: str = "result", finished: str = "finished_at", outcomes: Sequence[str] = RESULTS
) -> DataFrame:
    """``run_summary`` for every interval of the whole log in which a run ended; ``outcomes`` are counted, others are not."""
    kind = runs.schema[finished].dataType
    begin = floor_time(F.col(finished), kind, every)
    counts = (
        runs.where(F.col(finished).isNotNull())
        .groupBy(begin.alias("timestamp_from"))
        .agg(*_result_counts(result, outcomes))
    )
    until = F.timestamp_add("MICROSECOND", F.lit(micros(every)).cast("bigint"), F.col("timestamp_from"))
    return counts.select(F.inline(_result_rows(outcomes)), "timestamp_from", until.alias("timestamp_to"))


def _result_counts(result: str, outcomes: Sequence[str] = RESULTS) -> list[Column]:
    return [F.count_if(F.col(result) == r).alias(f"_{r}") for r in outcomes]


def _result_rows(outcomes: Sequence[str] = RESULTS) -> Column:
    return F.array(*[
        F.struct(F.col(f"_{r}").alias("metric"), F.lit("task_result").alias("metric_type"), F.lit(r).alias("result"))
        for r in outcomes
    ])


def level_summary(
    logs: DataFrame,
    min_level: str = "DEBUG",
    level: str = "level",
    levels: Mapping[str, int] = LEVELS,
    start: dt.datetime | str | Column | None = None,
    end: dt.datetime | str | Column | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Messages per level from ``min_level`` up, every such level present even with no message.

    ``level`` is a column of level names, their aliases or numbers; other names count nowhere. With ``start`` and ``end`` only messages of
    that interval count and the rows carry its bounds. The levels are known, so this is one row of
    conditional counts, unfolded.
    """
    numbers = {**{a: levels[n] for a, n in LEVEL_ALIASES.items() if n in levels}, **levels}
    shown = {n: v for n, v in levels.items() if v >= numbers[min_level.upper()]}
    by_name = logs.schema[level].dataType.typeName() == "string"
    number = F.element_at(F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv]), F.upper(F.col(level))) if by_name else F.col(level)
    bounds = []
    if start is not None and end is not None:
        first, last = _bounds(logs, ts, start, end)
        logs = logs.where((F.col(ts) >= first) & (F.col(ts) < last))
        bounds = [first.alias("timestamp_from"), last.alias("timestamp_to")]
    counts = [
        F.count_if(number == v).alias(f"_{v}")
        for v in shown.values()
    ]
    rows = F.array(*[
        F.struct(F.col(f"_{v}").alias("metric"), F.lit("log").alias("metric_type"), F.lit(v).alias("log_level"))
        for v in shown.values()
    ])
    return logs.agg(*counts).select(F.inline(rows), *bounds)


def _bounds(df: DataFrame, ts: str, start, end) -> list[Column]:
    kind = df.schema[ts].dataType
    return [b.cast(kind) if isinstance(b, Column) else moment(b, kind) for b in (start, end)]
