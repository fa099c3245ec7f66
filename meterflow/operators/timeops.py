"""Timestamps: rounding down, shifting and range filters."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.durations import micros

# Unit letters of date expressions.
DATE_UNITS = {
    "y": "YEAR",
    "M": "MONTH",
    "w": "WEEK",
    "d": "DAY",
    "h": "HOUR",
    "H": "HOUR",
    "m": "MINUTE",
    "s": "SECOND",
}

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_STEP = re.compile(r"([+-]\d+|/)([yMwdhHms])")


def epoch_micros(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970; zone-less timestamps count as UTC."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)
    return F.unix_micros(ts.cast("timestamp"))


def back(ts: Column, amount: Column) -> Column:
    """Timestamp moved back by a number of microseconds."""
    return F.timestamp_add("MICROSECOND", -amount, ts)


def floor_time(ts: Column, dtype: T.DataType, modulus: str | int | float) -> Column:
    """Largest multiple of ``modulus`` since 1970 that is not after ``ts``."""
    step = micros(modulus)
    if not step:
        return ts
    return back(ts, F.pmod(epoch_micros(ts, dtype), F.lit(step).cast("bigint")))


def shift_time(
    df: DataFrame, modulus: str | int | float = "1s", offset: str | int | float = 0, ts: str = frame.TS
) -> DataFrame:
    """Round a timestamp column down to ``modulus``, then move it back by ``offset``."""
    value = floor_time(F.col(ts), df.schema[ts].dataType, modulus)
    if shift := micros(offset):
        value = back(value, F.lit(shift).cast("bigint"))
    return df.withColumn(ts, value)


def moment(value: dt.datetime | str, target: T.DataType) -> Column:
    """Constant of a timestamp type; a value without a zone is UTC."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(" ")
    if isinstance(target, T.TimestampType) and not re.search(r"(Z|[+-]\d\d:?\d\d|UTC)$", value):
        value += " UTC" if ":" in value else " 00:00:00 UTC"
    return F.lit(value).cast(target)


def date_expression(
    text: str | dt.datetime | Column, anchor: Column | dt.datetime | None = None,
    target: T.DataType = T.TimestampType(),
) -> Column:
    """Column for ``now``, ``now/h-30m`` or a timestamp; steps apply left to right.

    ``/unit`` rounds down. The result is constant, so a comparison with it can be pushed down.
    """
    if isinstance(text, Column):
        return text.cast(target)
    if isinstance(text, dt.datetime) or not text.startswith("now"):
        return moment(text, target)
    if anchor is None:
        anchor = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
        value = anchor if isinstance(target, T.TimestampNTZType) else F.current_timestamp()
    else:
        value = anchor if isinstance(anchor, Column) else moment(anchor, target)
    steps = text[3:]
    if _STEP.sub("", steps):
        raise ValueError(f"not a date expression: {text!r}")
    for move, unit in _STEP.findall(steps):
        if move == "/":
            value = F.date_trunc(DATE_UNITS[unit], value)
        else:
            value = F.timestamp_add(DATE_UNITS[unit], F.lit(int(move)), value)
    return value.cast(target)


def time_range(
    df: DataFrame,
    start: str | dt.datetime | Column,
    end: str | dt.datetime | Column = "now",
    ts: str = "metadata.timestamp",
    anchor: Column | dt.datetime | None = None,
    lower: str = "gte",
    upper: str = "lt",
) -> DataFrame:
    """Rows whose timestamp lies in the range; bounds are ``gte``/``gt`` and ``lt``/``lte``."""
    return df.where(time_range_condition(df, start, end, ts, anchor, lower, upper))


def time_range_condition(
    df: DataFrame, start, end="now", ts: str = "metadata.timestamp", anchor=None,
    lower: str = "gte", upper: str = "lt",
) -> Column:
    if lower not in ("gte", "gt") or upper not in ("lt", "lte"):
        raise ValueError(f"unknown bounds {lower!r}, {upper!r}")
    value, dtype = frame.field(df, ts)
    # bounds take the column's own type, so the comparison casts the constant and not the column
    target = dtype if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)) else T.TimestampType()
    # text that is no timestamp is in no range
    value = value if dtype == target else value.try_cast(target)
    first = date_expression(start, anchor, target)
    last = date_expression(end, anchor, target)
    above = value >= first if lower == "gte" else value > first
    below = value < last if upper == "lt" else value <= last
    return above & below
