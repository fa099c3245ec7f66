"""Python values as literals, and Python's notions of truth and text as Column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONS = (T.FloatType, T.DoubleType)
NUMBERS = (*INTEGERS, *FRACTIONS, T.DecimalType)


def literal(value) -> Column:
    """Literal for any JSON-like Python value; dicts become structs, lists become arrays."""
    if isinstance(value, Column):
        return value
    if isinstance(value, Mapping):
        return F.struct(*[literal(v).alias(k) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*map(literal, value))
    if isinstance(value, int) and not isinstance(value, bool):
        return F.lit(value).cast("bigint")
    return F.lit(value)


def common_type(values: Iterable) -> T.DataType | None:
    """One Spark type for scalar Python values: integers, numbers, booleans, times, else text."""
    kinds = {type(v) for v in values if v is not None}
    if not kinds:
        return None
    if kinds <= {bool}:
        return T.BooleanType()
    if kinds <= {int}:
        return T.LongType()
    if kinds <= {int, float}:
        return T.DoubleType()
    if kinds <= {dt.datetime}:
        return T.TimestampType()
    return T.StringType()


def widest(types: Iterable[T.DataType]) -> T.DataType:
    """Type of a metric column fed by fields of these types."""
    kinds = [t for t in types if not isinstance(t, T.NullType)]
    if not kinds or all(isinstance(t, INTEGERS) for t in kinds):
        return T.LongType()
    if all(isinstance(t, T.BooleanType) for t in kinds):
        return T.BooleanType()
    if all(isinstance(t, (*INTEGERS, T.BooleanType)) for t in kinds):
        return T.LongType()
    if all(isinstance(t, (*NUMBERS, T.BooleanType)) for t in kinds):
        return T.DoubleType()
    return T.StringType()


def shared_type(left: T.DataType | None, right: T.DataType) -> T.DataType:
    """One type for values of two types: equal ones, numbers, else text."""
    if left is None or left == right or isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    if isinstance(left, NUMBERS) and isinstance(right, NUMBERS):
        return T.LongType() if isinstance(left, INTEGERS) and isinstance(right, INTEGERS) else T.DoubleType()
    return T.StringType()


def shown(value: Column, dtype: T.DataType, target: T.DataType | None) -> Column:
    """A value of type ``dtype`` as ``target``; nulls stay null in text."""
    if target is None or dtype == target:
        return value
    if isinstance(target, T.StringType):
        return F.when(value.isNotNull(), text(value, dtype))
    return value.cast(target)


def truthy(value: Column, dtype: T.DataType) -> Column:
    """Python truth of a value: not null, not zero, not false, not empty."""
    if isinstance(dtype, T.BooleanType):
        test = value
    elif isinstance(dtype, NUMBERS):
        test = value != 0
    elif isinstance(dtype, T.StringType):
        test = value != ""
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(value) > 0
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))


def text(value: Column, dtype: T.DataType) -> Column:
    """Text of a value with Python's spelling of booleans and of the missing value."""
    if isinstance(dtype, T.BooleanType):
        shown = F.when(value, "True").when(~value, "False")
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit("None"))


def b64(value: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line (Spark's own output breaks lines at 76)."""
    return F.regexp_replace(F.base64(F.encode(value, "UTF-8")), "[\\r\\n]", "")


def b64url(value: Column) -> Column:
    """URL-safe base64 with padding."""
    return F.translate(b64(value), "+/", "-_")
