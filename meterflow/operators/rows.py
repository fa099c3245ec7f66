"""User-supplied transforms of rows and of whole frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.values import NUMBERS


def transform_rows(
    df: DataFrame, values: Mapping[str, str | Column], within: Column | None = None, sep: str = "."
) -> DataFrame:
    """Set fields of every metric from SQL expressions or Columns, in order.

    A later expression sees the earlier results, and may fill a nested field whose parent an
    earlier one created. Rows outside ``within`` keep their fields.
    """
    for name, value in values.items():
        value = F.expr(value) if isinstance(value, str) else value
        if within is not None:
            value = F.when(within, value).otherwise(frame.current(df, name, sep)[0])
        df = frame.set_field(df, name, value, sep)
    return checked(df)


def checked(df: DataFrame) -> DataFrame:
    """The frame, refused if its metric became anything but a number, a boolean or null, or its attributes no record.

    Attributes are a struct of fields that a record can hold: nested to any depth, but no binary values and no maps with
    keys that are not scalar. All of it follows from the schema, so nothing runs.
    """
    if frame.is_frame(df):
        dtype = df.schema[frame.METRIC].dataType
        if not isinstance(dtype, (*NUMBERS, T.BooleanType, T.NullType)):
            raise ValueError(f"a metric must be a number or boolean, not {dtype.simpleString()}")
        attributes = df.schema[frame.ATTRIBUTES].dataType
        if not isinstance(attributes, T.StructType):
            raise TypeError(f"attributes must be a struct, not {attributes.simpleString()}")
        if df.schema[frame.FIELD].dataType not in (T.StringType(), T.NullType()):
            raise TypeError("the name of a metric field must be text")
        _record(attributes, frame.ATTRIBUTES)
    return df


def _record(dtype: T.DataType, name: str) -> None:
    """Refuses types that no record holds, anywhere below."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            _record(f.dataType, f"{name}.{f.name}")
    elif isinstance(dtype, T.ArrayType):
        _record(dtype.elementType, name)
    elif isinstance(dtype, T.MapType):
        if isinstance(dtype.keyType, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)):
            raise ValueError(f"the keys of {name} are {dtype.keyType.simpleString()}, which no record can hold")
        _record(dtype.valueType, name)
    elif isinstance(dtype, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)):
        raise ValueError(f"{name} is {dtype.simpleString()}, which no record can hold")


def transform_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str | None = None,
    within: Column | None = None,
) -> DataFrame:
    """Run Python over Arrow batches of rows, for logic without a built-in expression.

    ``fn`` must treat rows independently: batches are arbitrary slices of a partition. It may add
    or drop rows. Rows outside ``within`` pass by it, so the schema stays the frame's.
    """
    if within is None:
        def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield fn(batch)

        return checked(df.mapInPandas(over, schema or df.schema))
    if schema is not None:
        raise ValueError("rows outside within keep the frame's schema")

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch.pop("_within").to_numpy(bool)
            if own.any():
                yield fn(batch[own].reset_index(drop=True))
            if not own.all():
                yield batch[~own].reset_index(drop=True)

    return df.withColumn("_within", F.coalesce(within, F.lit(False))).mapInPandas(inside, df.schema)


def transform_frame(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a function of the whole frame; metrics stay numbers, booleans or null."""
    out = fn(df)
    if not isinstance(out, DataFrame):
        raise TypeError("a frame transform returns a DataFrame")
    return checked(out)


def transform_groups(
    df: DataFrame, keys: Sequence[str | Column], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str | None = None,
    most: int = 100_000,
) -> DataFrame:
    """Run Python over whole frames, each the rows of equal ``keys``, for logic that looks at all rows of a frame.

    ``fn`` gets one frame and returns any number of rows. A frame is held by one task, so it is bounded: frames are counted
    first, with map-side combining, and one of more than ``most`` rows fails the job before any Python runs. Rows with
    null keys are a frame of their own.
    """
    named = {f"_key_{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    out = schema or df.schema
    keyed = df.withColumns(named)
    long = keyed.groupBy(*named).agg(F.count("*").alias("n")).where(F.col("n") > most).agg(F.count("*")).scalar()
    failure = F.raise_error(F.lit(f"a frame has more than {most} rows")).cast("boolean")
    bounded = keyed.where(F.when(long > 0, failure).otherwise(True))

    names = list(named)

    def over(rows: pd.DataFrame) -> pd.DataFrame:
        return fn(rows.drop(columns=names).reset_index(drop=True))

    return checked(bounded.groupBy(*named).applyInPandas(over, out))
