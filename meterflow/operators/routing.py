"""Routing by input and task name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.globs import matches_any

Names = str | Sequence[str] | None


def _lower(names: Names) -> tuple[str, ...] | None:
    if names is None:
        return None
    return tuple(n.lower() for n in ([names] if isinstance(names, str) else names))


@dataclass(frozen=True)
class Route:
    """Name patterns a transform or output accepts; ``None`` leaves a side unrestricted."""

    include_tasks: Names = None
    exclude_tasks: Names = None
    include_inputs: Names = None
    exclude_inputs: Names = None

    def __post_init__(self):
        for kind in ("tasks", "inputs"):
            if getattr(self, f"include_{kind}") is not None and getattr(self, f"exclude_{kind}") is not None:
                raise ValueError(f"include_{kind} and exclude_{kind} exclude each other")

    def _sides(self):
        yield "task", _lower(self.include_tasks), _lower(self.exclude_tasks)
        yield "input", _lower(self.include_inputs), _lower(self.exclude_inputs)

    def accepts(self, input_name: str, task_name: str) -> bool:
        """Decision for a whole frame, taken on the driver from its two names."""
        names = {"task": task_name.lower(), "input": input_name.lower()}
        for side, include, exclude in self._sides():
            if include is not None and not any(fnmatchcase(names[side], p) for p in include):
                return False
            if exclude is not None and any(fnmatchcase(names[side], p) for p in exclude):
                return False
        return True

    def condition(self, task: Column, input_name: Column, lowered: bool = False) -> Column:
        """The same decision per row, for tables holding many tasks.

        ``lowered`` promises lower-case names, as flows write them; exact names and prefixes are
        then pushed down to the scan.
        """
        columns = {"task": task, "input": input_name}
        if not lowered:
            columns = {side: F.lower(c) for side, c in columns.items()}
        test = F.lit(True)
        for side, include, exclude in self._sides():
            if include is not None:
                test = test & matches_any(columns[side], include)
            if exclude is not None:
                test = test & ~matches_any(columns[side], exclude)
        return test

    def patterns(self) -> list[tuple[str, str]]:
        """Every (side, pattern) mentioned."""
        return [(s, p) for s, inc, exc in self._sides() for p in (*(inc or ()), *(exc or ()))]


def route(
    df: DataFrame, task: str = frame.TASK, input_name: str = frame.INPUT, lowered: bool = False, **patterns: Names
) -> DataFrame:
    """Rows of a multi-task frame accepted by the patterns of a ``Route``."""
    return df.where(Route(**patterns).condition(F.col(task), F.col(input_name), lowered))


def unmatched_routes(
    df: DataFrame, *routes: Route, task: str = frame.TASK, input_name: str = frame.INPUT
) -> DataFrame:
    """Patterns that match no task or input present in ``df``: columns ``side, pattern``.

    The distinct names are found first with map-side combining, then each pattern is one boolean
    aggregate over them; patterns come from configuration, so the aggregate row is small.
    """
    wanted = list(dict.fromkeys(p for r in routes for p in r.patterns()))
    names = df.select(F.lower(F.col(task)).alias("task"), F.lower(F.col(input_name)).alias("input")).distinct()
    hits = [
        F.coalesce(F.bool_or(matches_any(F.col(side), [pattern])), F.lit(False)).alias(f"hit_{i}")
        for i, (side, pattern) in enumerate(wanted)
    ]
    if not hits:
        return df.sparkSession.createDataFrame([], "side string, pattern string")
    rows = F.array(*[
        F.struct(F.lit(side).alias("side"), F.lit(pattern).alias("pattern"), F.col(f"hit_{i}").alias("hit"))
        for i, (side, pattern) in enumerate(wanted)
    ])
    return names.agg(*hits).select(F.inline(rows)).where(~F.col("hit")).drop("hit")
