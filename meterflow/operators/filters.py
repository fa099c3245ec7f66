"""Row filters: single comparisons, conjunctions and word search."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.values import FRACTIONS, INTEGERS

OPERATORS = ("lt", "le", "eq", "ne", "ge", "gt", "in", "nn")


def parse_condition(cond: str) -> tuple[str, str, str | None]:
    """Split ``"<operator> <value> [field]"``; the field may contain spaces."""
    parts = cond.split(" ", 2)
    if len(parts) < 2 or parts[0] not in OPERATORS:
        raise ValueError(f"condition must be '<operator> <value> [field]', got {cond!r}")
    return parts[0], parts[1], parts[2] if len(parts) > 2 else None


def simple_filter(
    df: DataFrame,
    cond: str,
    mode: str = "keep",
    strict: bool = False,
    within: Column | None = None,
    sep: str = ".",
) -> DataFrame:
    """Keep or drop the rows for which a comparison holds.

    The value text takes the type of the field. Nulls never satisfy an ordering or containment
    test (with ``strict`` they fail the job), equal nothing, and differ from every value; NaN
    satisfies only ``ne`` and ``nn``. ``drop`` keeps every row for which the test is not true.
    Rows outside ``within`` pass untested.
    """
    if mode not in ("keep", "drop"):
        raise ValueError(f"mode must be keep or drop, got {mode!r}")
    op, text, name = parse_condition(cond)
    value, dtype = frame.field(df, name, sep)
    test = condition(op, value, dtype, text, strict)
    kept = test if mode == "keep" else ~F.coalesce(test, F.lit(False))
    return df.where(kept if within is None else F.when(within, kept).otherwise(True))


def condition(op: str, value: Column, dtype: T.DataType, text: str, strict: bool = False) -> Column:
    """Boolean Column of one comparison."""
    if op == "nn":
        return value.isNotNull()
    if op == "in":
        test = _contains(value, dtype, text)
        return _no_nulls(value, test) if strict else test
    other, comparable = _coerce(text, dtype)
    if op in ("eq", "ne") and not comparable:
        return F.lit(op == "ne")
    if not comparable:
        raise ValueError(f"cannot order {dtype.simpleString()} and {text!r}")
    fraction = isinstance(dtype, FRACTIONS)
    if op == "eq":
        # a null test is not true, which is all a filter asks; NaN equals nothing
        return (value == other) & ~F.isnan(value) if fraction else value == other
    if op == "ne":
        test = F.coalesce(value != other, F.lit(True))
        return test | F.isnan(value) if fraction else test
    test = {"lt": value < other, "le": value <= other, "ge": value >= other, "gt": value > other}[op]
    if fraction:
        test = test & ~F.isnan(value)
        if text.strip().lower().lstrip("+-") == "nan":
            test = F.lit(False)
    return _no_nulls(value, test) if strict else test


def _no_nulls(value: Column, test: Column) -> Column:
    failed = F.raise_error(F.lit("comparison with a missing value")).cast("boolean")
    return F.when(value.isNull(), failed).otherwise(test)


def _coerce(text: str, dtype: T.DataType) -> tuple[Column | None, bool]:
    try:
        if isinstance(dtype, INTEGERS):
            number = int(text)
            fits = -(2**63) <= number < 2**63
            return F.lit(number) if fits else F.lit(str(number)).cast(T.DecimalType(38, 0)), True
        if isinstance(dtype, FRACTIONS):
            return F.lit(float(text)), True
        if isinstance(dtype, T.DecimalType):
            float(text)
            return F.lit(text).cast(T.DecimalType(38, dtype.scale)), True
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            dt.datetime.fromisoformat(text)
            return F.lit(text).cast(dtype), True
    except ValueError:
        return None, False
    if isinstance(dtype, T.BooleanType):
        known = {"true": True, "1": True, "false": False, "0": False}.get(text.strip().lower())
        return (F.lit(known), True) if known is not None else (None, False)
    if isinstance(dtype, T.StringType):
        return F.lit(text), True
    return None, False


def _contains(value: Column, dtype: T.DataType, text: str) -> Column:
    if isinstance(dtype, T.StringType):
        return value.contains(text)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.keyType
        other, comparable = _coerce(text, inner)
        if not comparable:
            return F.lit(False)
        other = other.cast(inner)
        if isinstance(dtype, T.MapType):
            return F.map_contains_key(value, other)
        return F.exists(value, lambda item: F.coalesce(item == other, F.lit(False)))
    if isinstance(dtype, T.StructType):
        return value.isNotNull() & F.lit(text in dtype.fieldNames())
    raise ValueError(f"{dtype.simpleString()} cannot contain {text!r}")


def all_of(conditions: Iterable[str | Column]) -> Column:
    """Conjunction of Columns and SQL predicates; none at all accepts every row."""
    tests = [F.expr(c) if isinstance(c, str) else c for c in conditions]
    return reduce(and_, tests) if tests else F.lit(True)


def text_condition(cols: Sequence[str], terms: str | Sequence[str], mode: str = "any") -> Column:
    """True where the columns hold any, or all, of the words; whole words, any letter case."""
    words = terms.split() if isinstance(terms, str) else list(terms)
    if mode not in ("any", "all") or not words:
        raise ValueError("text search needs words and mode any or all")
    groups = ["|".join(map(re.escape, words))] if mode == "any" else list(map(re.escape, words))
    tests = [
        reduce(or_, [F.col(c).rlike(rf"(?iu)(?:^|[^\p{{L}}\p{{N}}])(?:{g})(?:$|[^\p{{L}}\p{{N}}])") for c in cols])
        for g in groups
    ]
    return reduce(and_, tests)


def text_match(df: DataFrame, cols: str | Sequence[str], terms: str | Sequence[str], mode: str = "any") -> DataFrame:
    """Rows whose text columns contain the words."""
    return df.where(text_condition([cols] if isinstance(cols, str) else cols, terms, mode))
