"""Tasks, transforms and outputs composed into one lazy plan per task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from fnmatch import fnmatchcase

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.operators.normalize import to_metrics
from meterflow.operators.routing import Route
from meterflow.operators.timeops import shift_time
from meterflow.sinks.writers import Writer

FINISHED, SKIPPED = "finished", "skipped"


@dataclass(frozen=True)
class Modifiers:
    """Rounding and shift of a frame's timestamp."""

    modulus: str | int | float = "1s"
    offset: str | int | float = 0

    def apply(self, df: DataFrame) -> DataFrame:
        return shift_time(df, self.modulus, self.offset)


@dataclass(frozen=True)
class Task:
    """A source and how its records become metrics; names are kept in lower case.

    ``skip_empty`` looks for a first record before anything is sent; switch it off where reaching
    the first record costs as much as the whole source.
    """

    name: str
    source: Callable[[SparkSession], DataFrame] | DataFrame
    input_name: str = "input"
    metrics: str | Sequence[str] | None = ("metric",)
    attributes: Sequence[str] | None = None
    static: Mapping[str, object] | None = None
    ts: str | Column | None = None
    seq: str | None = None
    allow_none: bool = False
    drop_absent: bool = False
    modifiers: Modifiers = Modifiers()
    enabled: bool = True
    skip_empty: bool = True

    def __post_init__(self):
        object.__setattr__(self, "name", self.name.lower())
        object.__setattr__(self, "input_name", self.input_name.lower())

    def frame(self, records: DataFrame) -> DataFrame:
        """Metric frame of these records."""
        df = to_metrics(
            records, self.name, self.metrics, self.attributes, self.static, self.ts, self.input_name,
            self.seq, allow_none=self.allow_none, drop_absent=self.drop_absent,
        )
        return self.modifiers.apply(df)


@dataclass(frozen=True)
class Transform:
    """A frame function with its routing; higher priorities run first."""

    apply: Callable[..., DataFrame]
    route: Route = Route()
    priority: int = 0
    enabled: bool = True

    def __post_init__(self):
        if not -256 <= self.priority <= 256:
            raise ValueError("priority must lie between -256 and 256")


@dataclass(frozen=True)
class Output:
    """A writer with its routing and its own timestamp modifiers."""

    write: Writer
    route: Route = Route()
    modifiers: Modifiers = Modifiers()
    enabled: bool = True


@dataclass(frozen=True)
class Flow:
    """Tasks, transforms and outputs that belong together."""

    tasks: Sequence[Task] = ()
    transforms: Sequence[Transform] = ()
    outputs: Sequence[Output] = ()
    disable_outputs: bool = False
    task_prefix: str = ""

    def __post_init__(self):
        named = [replace(t, name=self.task_prefix + t.name) for t in self.tasks]
        object.__setattr__(self, "tasks", named)
        names = [t.name for t in self.tasks]
        if len(names) != len(set(names)):
            raise ValueError("task names must be unique")

    def chain(self, task: Task) -> list[Transform]:
        """Transforms a task passes, in order."""
        return [t for t in by_priority(self.transforms) if t.route.accepts(task.input_name, task.name)]

    def sinks(self, task: Task) -> list[Output]:
        if self.disable_outputs:
            return []
        return [o for o in self.outputs if o.enabled and o.route.accepts(task.input_name, task.name)]

    def unmatched(self) -> list[tuple[str, str]]:
        """Route patterns that match no configured task or input: ``(side, pattern)``."""
        names = {"task": {t.name for t in self.tasks}, "input": {t.input_name for t in self.tasks}}
        patterns = dict.fromkeys(p for part in (*self.transforms, *self.outputs) for p in part.route.patterns())
        return [(side, p) for side, p in patterns if not any(fnmatchcase(n, p) for n in names[side])]

    def plan(self, task: Task, records: DataFrame) -> DataFrame:
        """Lazy frame of a task after all its transforms."""
        df = task.frame(records)
        for transform in self.chain(task):
            df = df.transform(transform.apply)
        return df

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Lazy frames of all enabled tasks by name."""
        return {t.name: self.plan(t, _records(spark, t)) for t in self.tasks if t.enabled}

    def run(self, spark: SparkSession, run: str = "0") -> dict[str, str]:
        """Run all enabled tasks into their outputs; returns the state of each."""
        return {t.name: self.deliver(t, _records(spark, t), run) for t in self.tasks if t.enabled}

    def deliver(self, task: Task, records: DataFrame, run: str) -> str:
        """Send one task's metrics to every accepting output under a run key.

        Repeating a run key replaces what it wrote before. A task without records is skipped. The
        frame is kept between outputs only if there are several; losing it merely recomputes it.
        """
        outputs = self.sinks(task)
        df = self.plan(task, records)
        shared = len(outputs) > 1
        if shared:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # a kept frame with rows proves the source had some, without reading it again
            if task.skip_empty and not (shared and not df.isEmpty()) and records.isEmpty():
                return SKIPPED
            for output in outputs:
                output.write(output.modifiers.apply(df), run)
        finally:
            if shared:
                df.unpersist()
        return FINISHED


def _records(spark: SparkSession, task: Task) -> DataFrame:
    return task.source if isinstance(task.source, DataFrame) else task.source(spark)


def apply_by_priority(df: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    """Apply routed transforms to one table of many tasks, in a single pass.

    A transform with a route is called with ``within``, the condition of the rows it may touch, as
    ``simple_filter``, ``map_values`` and ``transform_rows`` accept it.
    """
    for t in by_priority(transforms):
        if t.route == Route():
            df = t.apply(df)
        else:
            df = t.apply(df, within=t.route.condition(F.col(frame.TASK), F.col(frame.INPUT)))
    return df


def by_priority(transforms: Sequence[Transform]) -> list[Transform]:
    """Enabled transforms by falling priority, equal ones in the order given."""
    return sorted((t for t in transforms if t.enabled), key=lambda t: -t.priority)
