"""Gauge rows and the last value of every series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import column, leaves
from meterflow.functions.values import INTEGERS, literal
from meterflow.operators.flatten import flat_view, merged
from meterflow.sinks.formats import entries


def gauge_rows(
    df: DataFrame,
    producer: str,
    name_field: str | None = "sample_name",
    static: Mapping[str, object] | None = None,
    sep: str = ".",
) -> DataFrame:
    """Metrics as gauge samples: ``instrument, value, attributes, metric_ts[, seq]``.

    Attributes are the flattened metric attributes, then the static ones, then the name of the
    metric field under ``name_field`` unless that is ``None``. Where attributes hold lists or maps, whose entries are
    named per row, all attributes are one map of texts, complete.
    """
    extra = {k: literal(v) for k, v in (static or {}).items()}
    if name_field:
        extra[name_field] = F.col(frame.FIELD)
    order = [c for c in (frame.TS, frame.SEQ) if c in df.columns]
    nested = any(isinstance(t, (T.ArrayType, T.MapType)) for _, t in leaves(frame.attribute_schema(df)))
    attributes = _text_map(df, extra, sep) if nested else merged(flat_view(df, sep), extra)
    return df.select(
        F.concat(F.lit(producer + "."), F.col(frame.TASK)).alias("instrument"),
        F.col(frame.METRIC).alias("value"),
        attributes.alias("attributes"),
        *order,
    )


def _text_map(df: DataFrame, extra: Mapping[str, Column], sep: str) -> Column:
    rows = [
        entries(column((frame.ATTRIBUTES, *path)), dtype, F.lit(sep.join(path)), sep, lambda v, t: v.cast("string"))
        for path, dtype in leaves(frame.attribute_schema(df))
    ]
    own = F.filter(F.concat(*rows), lambda e: ~e.getField("k").isin(*extra)) if extra else F.concat(*rows)
    more = [F.struct(F.lit(n).alias("k"), c.cast("string").alias("v")) for n, c in extra.items()]
    return F.map_from_entries(F.concat(own, F.array(*more)) if more else own)


def last_value(df: DataFrame, series: Sequence[str], value: str, order: Sequence[str], unique: bool | None = None) -> DataFrame:
    """Latest value of each series; later entries of ``order`` break ties, then the value itself.

    Every task first keeps one row per series, so a series holding most rows is no hot spot. Where the order tells all
    rows of a series apart (``unique``; the default is whether it holds the frame's ``seq``), times and whole numbers are
    packed into one decimal and the state has fixed-width buffers, which is the fastest form. Else ties are left to the
    value, and the state is a struct that is sorted.
    """
    keys = [column((s,)) for s in series]
    unique = frame.SEQ in order if unique is None else unique
    packed = _packed(df, order) if unique else None
    if packed is not None:
        latest = F.max_by(column((value,)), packed)
    else:
        latest = F.max(F.struct(*[column((o,)) for o in order], column((value,)).alias("_value"))).getField("_value")
    return df.groupBy(*keys).agg(latest.alias(value))


def _packed(df: DataFrame, order: Sequence[str]) -> Column | None:
    """A time and a whole number, or either, as one decimal in the same order, nulls lowest; none for other columns."""
    kinds = [df.schema[o].dataType for o in order]
    times = [isinstance(t, (T.TimestampType, T.TimestampNTZType)) for t in kinds]
    if len(order) > 2 or not all(t or isinstance(k, INTEGERS) for t, k in zip(times, kinds)) or times[1:] == [True] or (len(order) == 2 and not times[0]):
        return None
    parts = [F.unix_micros(column((o,)).cast("timestamp")) if t else column((o,)).cast("bigint") for o, t in zip(order, times)]
    # times have 19 digits at most, whole numbers 20: each as at least 1, and 0 for null
    shifted = [F.coalesce(p.cast("decimal(20,0)") + F.lit(Decimal((1 << 63) + 1)), F.lit(Decimal(0))) for p in parts]
    if len(order) == 1:
        return shifted[0].cast("decimal(38,0)")
    first = F.coalesce(parts[0].cast("decimal(18,0)") + F.lit(Decimal(10**17)), F.lit(Decimal(0)))
    return (first.cast("decimal(18,0)") * F.lit(Decimal(10**20))).cast("decimal(38,0)") + shifted[1]
