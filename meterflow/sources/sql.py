"""SQL sources."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from meterflow.functions.durations import micros
from meterflow.functions.paths import quote


def sql_source(
    spark: SparkSession,
    query: str,
    args: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of a Spark SQL query; ``:name`` markers take their values from ``args``.

    ``tables`` are known by their names within this query only: calls at the same time do not see each other's.
    """
    views = {name: f"source_{uuid.uuid4().hex}" for name in tables or {}}
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
    if views:
        named = ", ".join(f"{quote(name)} AS (SELECT * FROM {view})" for name, view in views.items())
        query = f"WITH {named} SELECT * FROM (\n{query.strip().rstrip(';')}\n)"
    try:
        # the plan is resolved here and needs the names no longer
        return spark.sql(query, args=dict(args or {}))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def jdbc_source(
    spark: SparkSession,
    url: str,
    query: str,
    timeout: str | int | float = 60,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 8,
    options: Mapping[str, str] | None = None,
    single: bool = False,
) -> DataFrame:
    """Rows of a query run by an external database, with a statement timeout.

    With a partition column and its bounds the result is read by several tasks; the bounds only
    divide the work and drop no rows. ``single=True`` says that one task may read it all.
    """
    if (partition_column is None) != single:
        raise ValueError("give a partition column, or single=True for a result that one task can read")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("queryTimeout", max(1, -(-micros(timeout) // 1_000_000)))
    reader = reader.options(**dict(options or {}))
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partitioned read needs bounds")
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )
