"""Uniqueness of join keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow.functions.paths import Path, column, leaves


def require_unique(df: DataFrame, key: str, check: bool = True) -> DataFrame:
    """The same rows, failing the job if a key occurs twice, since a join would double rows.

    The check is a subquery over the key column alone, counted with map-side combining. The table
    itself stays a plain input of the join: Spark can broadcast it by its size, or split skewed
    partitions of a shuffled join. ``check=False`` trusts keys known to be unique.
    """
    if not check:
        return df
    keys = df.select(column((key,)).alias("k")).where("k IS NOT NULL")
    twice = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*")).scalar()
    duplicate = F.raise_error(F.lit(f"key {key} is not unique")).cast("boolean")
    return df.where(F.when(twice > 0, duplicate).otherwise(True))


def row_hash(df: DataFrame) -> Column:
    """A hash of every value of a row: scalars as they are, lists and maps, which may hold maps, as their JSON text."""
    def one(path: Path, dtype: T.DataType) -> Column:
        nested = isinstance(dtype, (T.ArrayType, T.MapType))
        return F.to_json(column(path)) if nested else column(path)

    return F.xxhash64(*[one(path, dtype) for path, dtype in leaves(df.schema)])


def null_spread(df: DataFrame, key: Column, parts: int = 1000) -> Column:
    """A second join column: 0 for rows with a key, else one of ``parts`` numbers by the row's hash.

    Rows without a key match nothing, so they need not meet in one partition. The other side has ``no_spread``.
    """
    parts_of = F.pmod(row_hash(df), F.lit(parts)).cast("int") + 1
    return F.when(key.isNotNull(), 0).otherwise(parts_of)


def no_spread(key: Column) -> Column:
    """0 on the other side of the join, as an expression of its key: a constant would not stay a join column."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
