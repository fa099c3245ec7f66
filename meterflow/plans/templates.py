"""One parameterised query expanded over lists of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import frame


def runs(repeat_for: Mapping[str, Sequence]) -> list[dict[str, object]]:
    """Parameters of each run: the j-th value of every list, plus the index ``i``."""
    lengths = {name: len(values) for name, values in repeat_for.items()}
    if len(set(lengths.values())) != 1:
        raise ValueError(f"repeat_for needs lists of one length, got {lengths}")
    return [dict(zip(repeat_for, values)) | {"i": i} for i, values in enumerate(zip(*repeat_for.values()))]


def repeat_query(
    spark: SparkSession, query: str, repeat_for: Mapping[str, Sequence], task: str = "task_$i"
) -> DataFrame:
    """Union of the query's results for every run, with ``task_name`` and ``task_index``.

    The query takes values as ``:name`` and table or column names as ``IDENTIFIER(:name)``, so
    values are never pasted into SQL text. ``$name`` in the task name is replaced, unknown names
    stay as they are.
    """
    parts, names = [], set()
    for run in runs(repeat_for):
        name = Template(task).safe_substitute({k: str(v) for k, v in run.items()})
        if name in names:
            raise ValueError(f"task name {name!r} occurs twice; use a variable in it")
        names.add(name)
        part = spark.sql(query, args=run)
        parts.append(part.withColumns({frame.TASK: F.lit(name), "task_index": F.lit(run["i"])}))
    return reduce(DataFrame.unionByName, parts)
