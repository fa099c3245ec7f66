"""Registry of the checked queries: a Spark function and, where possible, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import quote
from meterflow.operators.flatten import flat_view

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name together with its reference SQL."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(df: DataFrame, *keep: str) -> DataFrame:
    """Frame as plain columns: the kept frame columns, field, metric and flat attributes."""
    columns = [F.col(quote(k)) for k in (*keep, frame.FIELD, frame.METRIC)]
    return df.select(*columns, *[c.alias(n) for n, c in flat_view(df).items()])
