"""Bucket aggregations as rows that can be stored and merged: sums, extremes and sketches per innermost bucket.

The state of two parts of the input, put together and merged, is the state of both, and outer buckets are merged from
inner ones, so one stored table answers every depth of the bucket tree. Distinct counts and percentiles are
sketches of a few kB, kept as binary columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from meterflow.functions.paths import quote
from meterflow.operators.buckets import DOC_COUNT, SKETCH_K, Filters, Level, Metric, _limited, _outer_limits, _top, _with_keys

#: Size of distinct count sketches as a power of two: a standard error of about 1.6 percent.
DISTINCT_LG = 12

# fixed values: parts of each metric's state, and the function that merges one
PARTS = {
    "sum": ("sum",), "avg": ("sum", "count"), "min": ("min",), "max": ("max",), "count": ("count",),
    "stats": ("count", "min", "max", "sum"), "cardinality": ("distinct",), "percentile": ("ranks",),
}


def _checked(levels: Sequence[Level], metrics: Mapping[str, Metric]) -> None:
    if not levels:
        raise ValueError("a bucket state needs at least one level")
    if any(isinstance(level, Filters) for level in levels):
        raise ValueError("named filters may overlap and cannot be merged upwards; keep a state for each")
    for name, spec in metrics.items():
        if spec[0] not in PARTS:
            raise ValueError(f"{name}: {spec[0]} has no state that can be merged")


def _part(name: str, value: Column, kind: T.DataType) -> Column:
    if name == "distinct":
        plain = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
        return F.hll_sketch_agg(value if plain else value.cast("string"), F.lit(DISTINCT_LG))
    if name == "ranks":
        return F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH_K))
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[name](value)


def _merged(name: str, column: Column) -> Column:
    if name == "distinct":
        return F.hll_union_agg(column)
    if name == "ranks":
        return F.kll_merge_agg_double(column, F.lit(SKETCH_K))
    return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[name](column)


def _columns(metrics: Mapping[str, Metric]) -> list[tuple[str, str]]:
    """State columns with the function that merges them."""
    return [(f"{m}:{p}", p) for m, spec in metrics.items() for p in PARTS[spec[0]]]


def bucket_state(df: DataFrame, levels: Sequence[Level], metrics: Mapping[str, Metric] | None = None) -> DataFrame:
    """Level keys, ``doc_count`` and the state columns ``metric:part`` of every innermost bucket.

    Levels and metrics are those of ``bucket_agg``. Rows without a deeper key stay, with null keys from there on: they count
    in the buckets above. One grouping with map-side combining.
    """
    metrics = dict(metrics or {})
    _checked(levels, metrics)
    keys = [f"_level_{i}" for i in range(len(levels))]
    keyed = _with_keys(df, levels, keys, False)[0].where(F.col(keys[0]).isNotNull())
    for above, key in zip(keys, keys[1:]):
        keyed = keyed.withColumn(key, F.when(F.col(above).isNotNull(), F.col(key)))
    columns = []
    for name, spec in metrics.items():
        value = F.expr(spec[1]) if isinstance(spec[1], str) else spec[1]
        kind = df.select(value.alias("v")).schema["v"].dataType
        columns += [_part(p, value, kind).alias(f"{name}:{p}") for p in PARTS[spec[0]]]
    out = keyed.groupBy(*keys).agg(F.count("*").alias(DOC_COUNT), *columns)
    return out.withColumnsRenamed({k: level.name for k, level in zip(keys, levels)})


def merge_state(state: DataFrame, levels: Sequence[Level], metrics: Mapping[str, Metric] | None = None) -> DataFrame:
    """Rows of equal keys as one; the same for keys of fewer levels, which merges the tree upwards."""
    metrics = dict(metrics or {})
    _checked(levels, metrics)
    names = [level.name for level in levels]
    parts = [_merged(p, F.col(quote(c))).alias(c) for c, p in _columns(metrics)]
    return state.groupBy(*[F.col(quote(n)) for n in names]).agg(F.sum(DOC_COUNT).alias(DOC_COUNT), *parts)


def read_state(
    state: DataFrame, levels: Sequence[Level], metrics: Mapping[str, Metric] | None = None, depth: int | None = None
) -> DataFrame:
    """The buckets of the first ``depth`` levels (all by default) as ``bucket_agg`` gives them over all rows of the state."""
    metrics = dict(metrics or {})
    levels = list(levels[: depth or len(levels)])
    merged = merge_state(state, levels, metrics)
    keys = [level.name for level in levels]
    limits = _outer_limits(levels)
    merged = _limited(merged, keys, limits, DOC_COUNT) if limits else merged
    for key in keys:
        merged = merged.where(F.col(quote(key)).isNotNull())
    if getattr(levels[-1], "top_n", None):
        merged = _top(merged, keys, levels[-1].top_n)
    values = [_value(name, spec).alias(name) for name, spec in metrics.items()]
    return merged.select(*[F.col(quote(k)) for k in keys], DOC_COUNT, *values)


def _value(name: str, spec: Metric) -> Column:
    def part(p: str) -> Column:
        return F.col(quote(f"{name}:{p}"))

    kind = spec[0]
    if kind == "avg":
        return F.when(part("count") > 0, part("sum") / part("count"))
    if kind == "stats":
        mean = F.when(part("count") > 0, part("sum") / part("count"))
        return F.struct(part("count").alias("count"), part("min").alias("min"), part("max").alias("max"), mean.alias("avg"), part("sum").alias("sum"))
    if kind == "cardinality":
        return F.hll_sketch_estimate(part("distinct"))
    if kind == "percentile":
        return F.kll_sketch_get_quantile_double(part("ranks"), F.lit(spec[2]))
    return part(PARTS[kind][0])
