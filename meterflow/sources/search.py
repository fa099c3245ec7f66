"""Search over a table: conjunction of conditions, optional time range and size."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.paths import column
from meterflow.operators.buckets import Level, Metric, bucket_agg
from meterflow.operators.filters import all_of
from meterflow.operators.timeops import time_range


def search(
    df: DataFrame,
    conditions: Iterable[str | Column] = (),
    timerange: Mapping[str, object] | None = None,
    size: int | None = None,
    order_by: Sequence[str | Column] = (),
    id_column: str | None = None,
) -> DataFrame:
    """Rows meeting every condition; ``timerange`` holds arguments of ``time_range``.

    ``size`` returns that many rows and needs an order. With ``id_column`` each row becomes a hit
    ``_id, _source``.
    """
    found = df.where(all_of(conditions))
    if timerange:
        found = time_range(found, **timerange)
    if size is not None:
        if size and not order_by:
            raise ValueError("size needs order_by, else the returned rows are arbitrary")
        found = found.orderBy(*order_by).limit(size) if size else found.limit(0)
    if id_column is None:
        return found
    source = F.struct(*[column((c,)).alias(c) for c in df.columns])
    return found.select(column((id_column,)).cast("string").alias("_id"), source.alias("_source"))


def search_buckets(
    df: DataFrame,
    levels: Sequence[Level],
    metrics: Mapping[str, Metric] | None = None,
    conditions: Iterable[str | Column] = (),
    timerange: Mapping[str, object] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Bucket aggregation over the rows of a search; no hits give no records."""
    return bucket_agg(search(df, conditions, timerange), levels, metrics, keep_empty)


def search_count(df: DataFrame, condition: str | Column) -> DataFrame:
    """Number of matching rows as one record ``metric``."""
    return search(df, [condition]).agg(F.count("*").alias("metric"))
