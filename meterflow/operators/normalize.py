"""Records to metrics: one row per selected field, the other fields as attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import Path, column, leaves, quote, without
from meterflow.functions.values import NUMBERS, literal, widest


def select_fields(
    schema: T.StructType, patterns: Sequence[str] | None, sep: str = "."
) -> dict[str, tuple[Path, T.DataType]]:
    """Leaves matching the patterns, in pattern order then field order, each at most once.

    List elements are not addressable here; ``flatten_array`` turns them into rows.
    """
    names = {sep.join(path): (path, dtype) for path, dtype in leaves(schema)}
    chosen: dict[str, tuple[Path, T.DataType]] = {}
    for pattern in patterns or ():
        for name, (path, dtype) in names.items():
            if name in chosen or isinstance(dtype, (T.ArrayType, T.MapType)):
                continue
            if fnmatchcase(name, pattern):
                chosen[name] = (path, dtype)
    return chosen


def to_metrics(
    df: DataFrame,
    task: str | Column,
    metrics: str | Sequence[str] | None = ("metric",),
    attributes: Sequence[str] | None = None,
    static: Mapping[str, object] | None = None,
    ts: str | Column | None = None,
    input_name: str | Column = "input",
    seq: str | None = None,
    sep: str = ".",
    allow_none: bool = False,
    drop_absent: bool = False,
) -> DataFrame:
    """Turn records into the canonical metric frame.

    ``metrics`` are names or patterns over the flattened record. A selected field is removed from
    the attributes of every row of its record. ``attributes`` restricts the rest to exact
    top-level names and ``static`` values are merged over them. A table without any metric field is
    an error unless ``allow_none``. Null metrics are kept unless ``drop_absent`` says that null means
    "field not present", as in JSON sources; a record left without metrics then fails the job, or
    with ``allow_none`` gives one row without a metric.

    Everything is resolved against the schema while the plan is built. One metric is a plain
    projection, so a later filter on it still reaches the scan; several are one unpivot.
    """
    patterns = [metrics] if isinstance(metrics, str) else metrics
    chosen = select_fields(df.schema, patterns, sep)
    if not chosen and not allow_none:
        raise ValueError(f"no field matches {patterns!r}; metric-less rows need allow_none=True")
    for name, (_, dtype) in chosen.items():
        if not isinstance(dtype, (*NUMBERS, T.BooleanType, T.NullType)):
            raise ValueError(f"metric {name!r} must be a number or boolean, not {dtype.simpleString()}")

    removed = {path for path, _ in chosen.values()}
    kept = dict(zip(_remaining(df.schema, removed), without(df.schema, removed)))
    if attributes is not None:
        kept = {k: c for k, c in kept.items() if k in attributes}
    kept |= {k: literal(v) for k, v in (static or {}).items()}

    head = {
        frame.INPUT: _text(input_name),
        frame.TASK: _text(task),
        frame.TS: F.current_timestamp() if ts is None else F.col(ts) if isinstance(ts, str) else ts,
    }
    if seq is not None:
        head[frame.SEQ] = F.col(quote(seq)).cast("bigint")
    ids = [c.alias(n) for n, c in head.items()]
    ids.append(F.struct(*[c.alias(n) for n, c in kept.items()]).alias(frame.ATTRIBUTES))

    for found, dtype in _attribute_types(df.schema, removed, attributes):
        if isinstance(dtype, T.BinaryType):
            raise ValueError(f"attribute {found!r} is binary, which no record can hold")
    if drop_absent and not allow_none:
        some = F.coalesce(*[column(p) for p, _ in chosen.values()]) if len({t for _, t in chosen.values()}) == 1 else F.coalesce(
            *[column(p).cast("string") for p, _ in chosen.values()])
        lost = F.raise_error(F.lit(f"a record has none of the metrics {list(chosen)}")).cast("boolean")
        df = df.where(F.when(some.isNull(), lost).otherwise(True))

    mtype = widest(dtype for _, dtype in chosen.values())
    values = {n: _widen(column(p), t, mtype) for n, (p, t) in chosen.items()}
    if drop_absent and allow_none and chosen:
        present = F.array_compact(F.array(*[
            F.when(v.isNotNull(), F.struct(F.lit(n).alias(frame.FIELD), v.alias(frame.METRIC))) for n, v in values.items()
        ]))
        out = df.select(*ids, F.inline_outer(present))
    elif len(values) <= 1:
        value, name = F.lit(None).cast("double"), F.lit(None).cast("string")
        for found, v in values.items():
            value, name = v, F.lit(found)
        out = df.select(*ids, name.alias(frame.FIELD), value.alias(frame.METRIC))
    else:
        # metric fields may be named like frame columns, so these take other names meanwhile
        keys = {f"_frame_{n}": n for n in (*head, frame.ATTRIBUTES)}
        wide = df.select(*[i.alias(k) for i, k in zip(ids, keys)], *[v.alias(n) for n, v in values.items()])
        out = wide.unpivot(list(keys), [quote(n) for n in values], frame.FIELD, frame.METRIC).withColumnsRenamed(keys)
    if drop_absent and not allow_none:
        out = out.where(F.col(frame.METRIC).isNotNull())
    out = out.withMetadata(frame.FIELD, {"metric_fields": list(chosen)})
    return out.select([c for c in frame.COLUMNS if c in out.columns])


def _attribute_types(schema: T.StructType, removed: set[Path], attributes: Sequence[str] | None) -> list[tuple[str, T.DataType]]:
    kept = [(p, t) for p, t in leaves(schema) if p not in removed and (attributes is None or p[0] in attributes)]
    return [(".".join(p), t) for p, t in kept]


def _remaining(schema: T.StructType, removed: set[Path]) -> list[str]:
    gone = {
        f.name
        for f in schema.fields
        if (below := {(f.name, *p) for p, _ in leaves(f.dataType)} if isinstance(f.dataType, T.StructType)
            else {(f.name,)})
        and below <= removed
    }
    return [f.name for f in schema.fields if f.name not in gone]


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _widen(value: Column, dtype: T.DataType, target: T.DataType) -> Column:
    if dtype == target:
        return value
    if isinstance(dtype, T.BooleanType) and not isinstance(target, T.BooleanType):
        return value.cast("int").cast(target)
    return value.cast(target)
