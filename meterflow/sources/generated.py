"""Random metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.values import literal


def random_metrics(
    spark: SparkSession,
    count: int = 1,
    lo: float = 0,
    hi: float = 100,
    seed: int | None = None,
    attributes: Mapping[str, object] | None = None,
) -> DataFrame:
    """``count`` records with a uniform ``metric`` and constant attributes."""
    return with_random(spark.range(count), lo, hi, seed, attributes).drop("id")


def with_random(
    df: DataFrame, lo: float = 0, hi: float = 100, seed: int | None = None,
    attributes: Mapping[str, object] | None = None,
) -> DataFrame:
    """One uniform ``metric`` per row of a table, from ``lo`` over a span of ``abs(hi - lo)``."""
    draw = F.rand(seed) if seed is not None else F.rand()
    constants = {k: literal(v) for k, v in (attributes or {}).items()}
    return df.withColumns({"metric": draw * abs(hi - lo) + lo, **constants})
