"""Metric frames as JSON lines, arrays, envelopes and documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import Path, column, leaves
from meterflow.functions.values import literal
from meterflow.operators.timeops import epoch_micros

# nulls stay visible in the output
_JSON = {"ignoreNullFields": "false"}


def _leaves(df: DataFrame, sep: str) -> dict[str, tuple[Column, T.DataType]]:
    """Flat name to column and type; lists and maps are leaves here, their entries are named per row."""
    base: Path = (frame.ATTRIBUTES,) if frame.is_frame(df) else ()
    schema = frame.attribute_schema(df) if base else df.schema
    return {sep.join(path): (column((*base, *path)), dtype) for path, dtype in leaves(schema)}


def entries(value: Column, dtype: T.DataType, name: Column, sep: str, show: Callable[[Column, T.DataType], Column]) -> Column:
    """Array of ``(k, v)`` for a value of any depth: list elements by position, map entries and fields by name.

    A missing list or map is one entry without value; an empty one has none.
    """
    if isinstance(dtype, T.ArrayType):
        below = F.transform(value, lambda x, i: entries(x, dtype.elementType, F.concat(name, F.lit(sep), i.cast("string")), sep, show))
    elif isinstance(dtype, T.MapType):
        below = F.transform(F.map_entries(value), lambda e: entries(
            e.getField("value"), dtype.valueType, F.concat(name, F.lit(sep), e.getField("key").cast("string")), sep, show))
    elif isinstance(dtype, T.StructType):
        parts = [entries(value.getField(f.name), f.dataType, F.concat(name, F.lit(sep + f.name)), sep, show) for f in dtype.fields]
        return F.concat(*parts) if parts else F.array().cast("array<struct<k:string,v:string>>")
    else:
        return F.array(F.struct(name.alias("k"), show(value, dtype).alias("v")))
    none = F.array(F.struct(name.alias("k"), show(F.lit(None).cast("string"), T.StringType()).alias("v")))
    return F.coalesce(F.flatten(below), none)


def _shown_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text of one scalar."""
    text = F.to_json(F.struct(value.alias("v")), _JSON)
    return F.substr(text, F.lit(6), F.length(text) - 6)


def _bare(record: Column) -> Column:
    """Entries of a JSON object text, without its braces."""
    return F.substr(record, F.lit(2), F.length(record) - 2)


def _own() -> Column:
    """Entry of the metric under its field's name; null for a row without a metric."""
    return F.when(F.col(frame.FIELD).isNotNull(), _bare(F.to_json(F.create_map(F.col(frame.FIELD), F.col(frame.METRIC)), _JSON)))


def _pair(entry: Column) -> Column:
    name = F.to_json(F.struct(entry.getField("k").alias("k")))
    return F.concat(F.substr(name, F.lit(6), F.length(name) - 6), F.lit(":"), entry.getField("v"))


def record_text(df: DataFrame, extra: Mapping[str, Column] | None = None, sep: str = ".", ordered: bool = False) -> Column:
    """Flat record of each row as JSON text: the metric under its field's name and the attributes, complete.

    A metric wins over an attribute of its name. ``ordered`` sorts the keys, else the metric comes first. Scalars that
    stand together are one JSON writer; only lists and maps, whose names depend on the row, are handled one by one.
    """
    found = _leaves(df, sep) | {n: (c, None) for n, c in (extra or {}).items()}
    framed = frame.is_frame(df)
    known = frame.metric_fields(df)
    nested = {n for n, (_, t) in found.items() if isinstance(t, (T.ArrayType, T.MapType))}
    if ordered and nested:
        return _sorted_text(found, framed, sep)
    if ordered:
        text = _merged_text(found, known, framed)
        # a row whose metric took another name than the plan knows
        return F.when(F.col(frame.FIELD).isin(known), text).otherwise(_sorted_text(found, framed, sep)) if framed and known else text

    segments: list[Column] = []
    run: dict[str, Column] = {}
    if framed and len(known) == 1 and known[0] not in found:
        # one writer for the metric and what follows it, on rows of that name
        head = {n: c for n, (c, t) in _until(found, nested).items()}
        rest = {n: v for n, v in found.items() if n not in head}
        fast = _bare(_json({known[0]: F.col(frame.METRIC)} | head))
        slow = F.concat_ws(",", _own(), *([_bare(_json(head))] if head else []))
        segments.append(F.when(F.col(frame.FIELD) == known[0], fast).otherwise(slow))
        found = rest
    elif framed:
        segments.append(_own())

    def flush() -> None:
        if run:
            segments.append(_bare(_json(run)))
            run.clear()

    for name, (value, dtype) in found.items():
        if name in nested:
            flush()
            rows = entries(value, dtype, F.lit(name), sep, _shown_json)
            if framed:
                rows = F.filter(rows, lambda e: ~e.getField("k").eqNullSafe(F.col(frame.FIELD)))
            segments.append(F.nullif(F.array_join(F.transform(rows, _pair), ","), F.lit("")))
        elif framed and (name in known or not known):
            flush()
            segments.append(F.when(~F.col(frame.FIELD).eqNullSafe(F.lit(name)), _bare(_json({name: value}))))
        else:
            run[name] = value
    flush()
    return F.concat(F.lit("{"), F.concat_ws(",", *segments), F.lit("}")) if segments else F.lit("{}")


def _until(found: Mapping[str, tuple], nested: set[str]) -> dict[str, tuple]:
    head = {}
    for name, value in found.items():
        if name in nested:
            break
        head[name] = value
    return head


def _merged_text(found: Mapping[str, tuple], known: Sequence[str], framed: bool) -> Column:
    """Sorted record of scalars: the metric is put where each name it may have belongs."""
    segments: list[Column] = []
    run: dict[str, Column] = {}
    places = set(known if known else found) if framed else set()
    for name in sorted({*found, *places}):
        if name in places:
            if run:
                segments.append(_bare(_json(run)))
                run = {}
            entry = _bare(_json({name: found[name][0]})) if name in found else F.lit(None).cast("string")
            segments.append(F.when(F.col(frame.FIELD) == name, _own()).otherwise(entry))
        else:
            run[name] = found[name][0]
    if run:
        segments.append(_bare(_json(run)))
    if framed and not known:
        return _sorted_text(found, framed, ".")
    return F.concat(F.lit("{"), F.concat_ws(",", *segments), F.lit("}")) if segments else F.lit("{}")


def _sorted_text(found: Mapping[str, tuple], framed: bool, sep: str) -> Column:
    """Sorted record of any attributes, entry by entry."""
    rows = [entries(value, dtype if dtype is not None else T.StringType(), F.lit(name), sep, _shown_json) for name, (value, dtype) in found.items()]
    every = F.concat(*rows) if rows else F.array().cast("array<struct<k:string,v:string>>")
    if framed:
        every = F.filter(every, lambda e: ~e.getField("k").eqNullSafe(F.col(frame.FIELD)))
        own = F.struct(F.col(frame.FIELD).alias("k"), _shown_json(F.col(frame.METRIC), T.StringType()).alias("v"))
        every = F.when(F.col(frame.FIELD).isNull(), every).otherwise(F.concat(every, F.array(own)))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(every), _pair), ","), F.lit("}"))


def _json(fields: Mapping[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), _JSON)


def json_lines(df: DataFrame, width: int | None = None, sep: str = ".") -> DataFrame:
    """One JSON text per row in ``value``; longer than ``width`` characters is cut with ``...``."""
    line = record_text(df, sep=sep)
    if width is not None:
        cut = F.concat(F.substring(line, 1, width - 3), F.lit("..."))
        line = F.when(F.length(line) > width, cut).otherwise(line)
    order = [frame.SEQ] if frame.SEQ in df.columns else []
    return df.select(*order, line.alias("value"))


def json_arrays(df: DataFrame, batch: str, order: str, value: str = "value", most: int = 10_000) -> DataFrame:
    """One JSON array text per batch, in ``order``; a batch of more than ``most`` rows fails, see ``batch_ids``.

    Batches are counted, with map-side combining, before any is gathered: a batch that is too long fails the job first.
    """
    long = df.groupBy(batch).agg(F.count("*").alias("n")).where(F.col("n") > most).agg(F.count("*")).scalar()
    failure = F.raise_error(F.lit(f"a batch has more than {most} rows")).cast("boolean")
    bounded = df.where(F.when(long > 0, failure).otherwise(True))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    text = F.array_join(F.transform(rows, lambda r: r.getField("v")), ",")
    return bounded.groupBy(batch).agg(F.count("*").alias("n_rows"), F.concat(F.lit("["), text, F.lit("]")).alias("payload"))


def envelope(
    df: DataFrame,
    producer: str,
    environment: str = "default",
    prefix: str = "raw",
    static: Mapping[str, object] | None = None,
    name_field: str | None = None,
    sep: str = ".",
) -> DataFrame:
    """One envelope per metric as JSON text with sorted keys, in ``value``.

    The flat record is under ``data``; ``static`` keys replace envelope keys of the same name.
    ``name_field`` adds the name of the metric field to the record.
    """
    data = record_text(df, {name_field: F.col(frame.FIELD)} if name_field else None, sep, ordered=True)
    micros = epoch_micros(F.col(frame.TS), df.schema[frame.TS].dataType)
    outer = {
        "producer": F.lit(producer),
        "type": F.col(frame.TASK),
        "type_prefix": F.lit(prefix),
        "environment": F.lit(environment),
        # multiplying is exact and half the cost of dividing decimals
        "timestamp": (micros.cast(T.DecimalType(19, 0)) * F.lit(Decimal("0.000001"))).cast(T.DecimalType(20, 6)),
    }
    fixed = {k: literal(v) for k, v in (static or {}).items()}

    every = outer | {"data": None} | fixed
    names = sorted(every)
    cut = names.index("data") if every["data"] is None else len(names)
    segments = [_bare(_json({n: every[n] for n in part})) for part in (names[:cut], names[cut + 1:]) if part]
    if every["data"] is None:
        segments.insert(1 if cut else 0, F.concat(F.lit('"data":'), data))
    value = F.concat(F.lit("{"), F.concat_ws(",", *segments), F.lit("}"))
    order = [frame.SEQ] if frame.SEQ in df.columns else []
    return df.select(*order, value.alias("value"))


def utc_text(ts: Column, dtype: T.DataType) -> Column:
    """Timestamp as ``2024-01-31T23:59:59.000000Z``."""
    if not isinstance(dtype, T.TimestampNTZType):
        ts = F.convert_timezone(None, F.lit("UTC"), ts)
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def documents(df: DataFrame, ts_field: str | None = None, sep: str = ".") -> DataFrame:
    """One document per metric as JSON text in ``value``, optionally holding its timestamp."""
    extra = {ts_field: utc_text(F.col(frame.TS), df.schema[frame.TS].dataType)} if ts_field else {}
    order = [frame.SEQ] if frame.SEQ in df.columns else []
    return df.select(*order, record_text(df, extra, sep).alias("value"))
