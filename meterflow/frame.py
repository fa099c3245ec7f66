"""The canonical metric frame.

One row per metric: ``input_name, task_name, metric_ts, [seq], metric_field, metric, attributes``.
Operators that take a field name also accept tables without an ``attributes`` struct; names then
refer to the table's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow.functions.paths import Path, column, find, quoted
from meterflow.functions.values import shared_type, shown

INPUT, TASK, TS, SEQ = "input_name", "task_name", "metric_ts", "seq"
FIELD, METRIC, ATTRIBUTES = "metric_field", "metric", "attributes"
COLUMNS = (INPUT, TASK, TS, SEQ, FIELD, METRIC, ATTRIBUTES)


def is_frame(df: DataFrame) -> bool:
    return {FIELD, METRIC, ATTRIBUTES} <= set(df.columns)


def attribute_schema(df: DataFrame) -> T.StructType:
    return df.schema[ATTRIBUTES].dataType


def field(df: DataFrame, name: str | None = None, sep: str = ".") -> tuple[Column, T.DataType]:
    """Column and type behind a field name; no name means the metric itself.

    In a frame the name is the one a metric was extracted under, which addresses the metric, or an attribute path; a row
    that has neither fails the job. A metric's own name wins over an equal attribute.
    """
    if name is None or (name == METRIC and METRIC in df.columns):
        return F.col(METRIC), df.schema[METRIC].dataType
    if not is_frame(df):
        found = find(df.schema, name, sep)
        if found is None:
            raise ValueError(f"no field {name!r} in {df.columns}")
        return column(found[0]), found[1]
    found = find(attribute_schema(df), name, sep)
    dtype = df.schema[METRIC].dataType
    if found is not None and name in metric_fields(df):
        attribute, kind = column((ATTRIBUTES, *found[0])), shared_type(dtype, found[1])
        return F.when(F.col(FIELD) == name, shown(F.col(METRIC), dtype, kind)).otherwise(shown(attribute, found[1], kind)), kind
    if found is not None:
        return column((ATTRIBUTES, *found[0])), found[1]
    unknown = F.raise_error(F.lit(f"no field {name!r} in this metric")).cast(dtype)
    return F.when(F.col(FIELD) == name, F.col(METRIC)).otherwise(unknown), dtype


def metric_fields(df: DataFrame) -> list[str]:
    """Names the metrics of a frame were extracted under, as far as the plan knows them."""
    return list(df.schema[FIELD].metadata.get("metric_fields", ())) if is_frame(df) else []


def is_attribute(df: DataFrame, name: str, sep: str = ".") -> bool:
    return is_frame(df) and find(attribute_schema(df), name, sep) is not None


def current(df: DataFrame, name: str, sep: str = ".") -> tuple[Column, T.DataType]:
    """What ``set_field`` would replace: the field's value, or null where there is no such field."""
    if is_frame(df):
        exists = name == METRIC or is_attribute(df, name, sep)
        if not exists and name in metric_fields(df):
            return F.when(F.col(FIELD) == name, F.col(METRIC)), df.schema[METRIC].dataType
    else:
        exists = find(df.schema, name, sep) is not None
    return field(df, name, sep) if exists else (F.lit(None), T.NullType())


def set_field(df: DataFrame, name: str, value: Column, sep: str = ".") -> DataFrame:
    """Write a value to the metric or to a nested path; only the last part may be new.

    ``metric``, or the name a metric was extracted under, addresses the metric.
    """
    if name == METRIC and METRIC in df.columns:
        return df.withColumn(METRIC, value)
    known = metric_fields(df)
    if name in known:
        if known == [name]:
            return df.withColumn(METRIC, value)
        own = F.col(FIELD) == name
        kept = column((ATTRIBUTES, *find(attribute_schema(df), name, sep)[0])) if is_attribute(df, name, sep) else F.lit(None)
        changed = df.withColumn("_value", value)
        return set_attribute(changed, name, F.when(~own, F.col("_value")).otherwise(kept), sep).withColumn(
            METRIC, F.when(own, F.col("_value")).otherwise(F.col(METRIC))
        ).drop("_value")
    return set_attribute(df, name, value, sep)


def set_attribute(df: DataFrame, name: str, value: Column, sep: str = ".") -> DataFrame:
    """Write an attribute (or a column of a plain table), whatever the metrics are called."""
    if name in metric_fields(df) and not is_attribute(df, name, sep):
        return merge_fields(df, {name: value})
    base: Path = (ATTRIBUTES,) if is_frame(df) else ()
    schema = attribute_schema(df) if base else df.schema
    found = find(schema, name, sep)
    if found is not None:
        path = found[0]
    else:
        parent, _, last = name.rpartition(sep)
        above = find(schema, parent, sep) if parent else ((), schema)
        if above is None or not isinstance(above[1], T.StructType):
            raise ValueError(f"parent of {name!r} does not exist")
        path = (*above[0], last)
    full = (*base, *path)
    if len(full) == 1:
        return df.withColumn(full[0], value)
    top = column(full[:1])
    if base and not schema.fields:
        return df.withColumn(ATTRIBUTES, F.struct(value.alias(path[-1])))
    return df.withColumn(full[0], top.withField(quoted(full[1:]), value))


def drop_field(df: DataFrame, name: str) -> DataFrame:
    """Remove one top-level attribute (or column)."""
    if not is_frame(df):
        if name not in df.columns:
            raise ValueError(f"no field {name!r}")
        return df.drop(name)
    kept = [f.name for f in attribute_schema(df).fields]
    if name not in kept:
        raise ValueError(f"no attribute {name!r}")
    columns = [column((ATTRIBUTES, k)).alias(k) for k in kept if k != name]
    return df.withColumn(ATTRIBUTES, F.struct(*columns))


def merge_fields(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Top-level attributes (or columns) replaced or added from ``values``; values win."""
    if not values:
        return df
    if not is_frame(df):
        return df.withColumns(values)
    names = [f.name for f in attribute_schema(df).fields]
    merged = {n: column((ATTRIBUTES, n)) for n in names} | values
    return df.withColumn(ATTRIBUTES, F.struct(*[c.alias(n) for n, c in merged.items()]))
