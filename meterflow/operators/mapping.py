"""Key to value mapping of one field."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.keys import no_spread, null_spread, require_unique
from meterflow.functions.values import INTEGERS, NUMBERS, common_type, literal, shared_type, shown, text, truthy

# Casts of the key, and what a missing key gives.
CASTS = ("str", "int", "bool", "float")
MISSING = ("default", "original", "original_casted", "raise", "nothing")


# keys that are compared one by one rather than joined; the result is the same
BRANCHES = 100


def map_values(
    df: DataFrame,
    mapping: Mapping | DataFrame,
    key: str,
    result: str | None = None,
    cast: str | None = None,
    default=None,
    missing: str = "raise",
    within: Column | None = None,
    sep: str = ".",
) -> DataFrame:
    """Replace a field by its mapped value, or write the value to ``result``.

    ``mapping`` is a dict of constants or, for large mappings, a DataFrame ``key, value`` with
    unique keys (checked), which is joined. Whether a key is present decides, not whether its value is null.
    A ``default`` other than ``None`` implies ``missing="default"``. Rows outside ``within`` keep
    what the result field holds. Types, defaults and missing keys are the same for every size and form of mapping: up
    to ``BRANCHES`` keys are branches of an expression, more are joined.
    """
    if cast is not None and cast not in CASTS:
        raise ValueError(f"cast must be one of {CASTS}")
    missing = "default" if default is not None else missing
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    original, otype = frame.field(df, key, sep)
    looked_up, ktype = cast_key(original, otype, cast)
    target = result or key
    if result is None and frame.is_frame(df) and not frame.is_attribute(df, key, sep):
        target = frame.METRIC

    # types and the value of missing keys do not depend on how the mapping is looked up
    if isinstance(mapping, DataFrame):
        pairs, found_type = None, mapping.schema["value"].dataType
        vtype = _constants_type([default], found_type) if missing == "default" else found_type
    else:
        pairs = {k: v for k, v in mapping.items() if _can_match(k, ktype)}
        vtype = found_type = _value_type([*mapping.values(), *([default] if missing == "default" else [])])
    if missing in ("original", "original_casted"):
        vtype = shared_type(vtype, otype if missing == "original" else ktype)
    if missing == "nothing" or within is not None:
        vtype = shared_type(vtype, frame.current(df, target, sep)[1]) if vtype is not None else None
    if missing == "default":
        other = _typed(default, vtype)
    elif missing == "original":
        other = shown(original, otype, vtype)
    elif missing == "original_casted":
        other = shown(looked_up, ktype, vtype)
    elif missing == "raise":
        other = F.raise_error(F.concat(F.lit("no mapping for key "), text(looked_up, ktype)))
        other = other.cast(vtype) if vtype is not None else other
    else:
        other = _current(df, target, vtype, sep)

    # numbers and booleans compare by value; a null key only meets an explicit None
    test_key = looked_up.cast("int") if isinstance(ktype, T.BooleanType) else looked_up
    if pairs is None:
        df, hit, value = _joined(df, _table(mapping), test_key)
        mapped = F.when(hit, shown(value, found_type, vtype)).otherwise(other)
    elif len(pairs) > BRANCHES:
        # the joined table holds positions, the values are the constants a short mapping has
        keys = [k for k in pairs if k is not None]
        df, hit, at = _joined(df, _positions(df, keys), test_key)
        values = F.array(*[_typed(pairs[k], vtype) for k in keys])
        mapped = F.when(hit, F.element_at(values, at + 1)).otherwise(other)
        if None in pairs:
            mapped = F.when(looked_up.isNull(), _typed(pairs[None], vtype)).otherwise(mapped)
    else:
        branches = None
        for k, v in pairs.items():
            test = looked_up.isNull() if k is None else test_key == F.lit(_plain(k))
            branches = (F if branches is None else branches).when(test, _typed(v, vtype))
        mapped = other if branches is None else branches.otherwise(other)
    if within is not None:
        mapped = F.when(within, mapped).otherwise(_current(df, target, vtype, sep))
    return frame.set_field(df, target, mapped, sep).drop(*JOINED)


# columns of a joined mapping
JOINED = ("_map_on", "_map_spread", "_map_key", "_map_value", "_map_hit", "_map_part")


def _table(mapping: DataFrame) -> DataFrame:
    """A mapping table as ``_map_key, _map_value``; booleans compare as 0 and 1."""
    key = F.col("key").cast("int") if isinstance(mapping.schema["key"].dataType, T.BooleanType) else F.col("key")
    return require_unique(mapping, "key").select(key.alias("_map_key"), F.col("value").alias("_map_value"))


def _positions(df: DataFrame, keys: list) -> DataFrame:
    plain = [_plain(k) for k in keys]
    kind = common_type(plain) or T.StringType()
    schema = T.StructType([T.StructField("_map_key", kind), T.StructField("_map_value", T.IntegerType())])
    rows = [(float(k) if isinstance(kind, T.DoubleType) else k, i) for i, k in enumerate(plain)]
    return df.sparkSession.createDataFrame(rows, schema)


def _joined(df: DataFrame, side: DataFrame, key: Column) -> tuple[DataFrame, Column, Column]:
    """A left join whose strategy Spark chooses from table sizes; null keys, which match nothing, are spread."""
    left = df.withColumn("_map_on", key)
    left = left.withColumn("_map_spread", null_spread(left, F.col("_map_on")))
    side = side.select("_map_key", "_map_value", F.lit(True).alias("_map_hit"), no_spread(F.col("_map_key")).alias("_map_part"))
    on = (F.col("_map_on") == F.col("_map_key")) & (F.col("_map_spread") == F.col("_map_part"))
    return left.join(side, on, "left"), F.coalesce(F.col("_map_hit"), F.lit(False)), F.col("_map_value")


def cast_key(value: Column, dtype: T.DataType, cast: str | None) -> tuple[Column, T.DataType]:
    """The key as used for the lookup, with Python's conversions."""
    if cast is None:
        return value, dtype
    if cast == "str":
        return text(value, dtype), T.StringType()
    if cast == "int":
        return value.cast("bigint"), T.LongType()
    if cast == "float":
        return value.cast("double"), T.DoubleType()
    return truthy(value, dtype), T.BooleanType()


def _can_match(key, ktype: T.DataType) -> bool:
    if key is None:
        return True
    if isinstance(key, str):
        return isinstance(ktype, T.StringType)
    if isinstance(key, dt.datetime):
        return isinstance(ktype, (T.TimestampType, T.TimestampNTZType))
    if isinstance(ktype, INTEGERS) and isinstance(key, float):
        return key.is_integer()
    return isinstance(ktype, (*NUMBERS, T.BooleanType))


def _plain(key):
    if isinstance(key, bool):
        return int(key)
    return int(key) if isinstance(key, float) and key.is_integer() else key


def _constants_type(values, known: T.DataType) -> T.DataType:
    kind = _value_type(values)
    return known if kind is None else shared_type(known, kind)


def _value_type(values) -> T.DataType | None:
    nested = [v for v in values if isinstance(v, (dict, list))]
    if not nested:
        return common_type(values)
    return None if all(isinstance(v, (dict, list, type(None))) for v in values) else T.StringType()


def _typed(value, vtype: T.DataType | None) -> Column:
    if isinstance(vtype, T.StringType) and value is not None and not isinstance(value, str):
        return F.lit(str(value))
    return literal(value) if vtype is None else literal(value).cast(vtype)


def _current(df: DataFrame, target: str, vtype: T.DataType | None, sep: str) -> Column:
    """Value the result field already has, as text where the mapped values are."""
    value, dtype = frame.current(df, target, sep)
    if vtype is None or isinstance(dtype, T.NullType):
        return value
    return shown(value, dtype, shared_type(vtype, dtype))
