"""Nested bucket aggregation and the flattening of bucket documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, types as T
from pyspark.sql import functions as F

from meterflow.functions.paths import column, quote
from meterflow.operators.filters import all_of
from meterflow.operators.timeops import floor_time
from meterflow.streaming.workspace import stored

DOC_COUNT = "doc_count"
# size parameter of quantile sketches; ranks are off by less than half a percent
SKETCH_K = 800
Metric = tuple  # (function, column) or (function, column, argument)


@dataclass(frozen=True)
class Terms:
    """One bucket per distinct value; rows without a value belong to no bucket."""

    name: str
    column: str
    top_n: int | None = None


@dataclass(frozen=True)
class Histogram:
    """Buckets of equal numeric width, keyed by their lower bound."""

    name: str
    column: str
    interval: float


@dataclass(frozen=True)
class DateHistogram:
    """Buckets of a fixed duration (``"6h"``) or a calendar unit (``"month"``)."""

    name: str
    column: str
    interval: str


@dataclass(frozen=True)
class Filters:
    """Named predicates; they may overlap, and every name yields a bucket."""

    name: str
    filters: Mapping[str, str | Column] = field(default_factory=dict)


Level = Terms | Histogram | DateHistogram | Filters


def measure(spec: Metric, hit: Column | None = None) -> Column:
    """Aggregate column of one metric, over the rows where ``hit`` holds."""
    name, source, *args = spec
    value = F.expr(source) if isinstance(source, str) else source
    if hit is not None:
        value = F.when(hit, value)
    if name == "stats":
        parts = {"count": F.count, "min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}
        return F.struct(*[f(value).alias(n) for n, f in parts.items()])
    if name == "percentile":
        # a few kB per task and group, so that merging the parts of a huge group stays cheap
        return F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value.cast("double"), SKETCH_K), F.lit(args[0]))
    functions = {
        "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
        "cardinality": F.approx_count_distinct, "exact_cardinality": F.count_distinct,
    }
    return functions[name](value)


def _measures(metrics: Mapping[str, Metric], hit: Column | None = None) -> list[Column]:
    return [measure(spec, hit).alias(name) for name, spec in metrics.items()]


def _key(df: DataFrame, level: Level) -> Column:
    value = F.expr(level.column)
    if isinstance(level, Histogram):
        step = F.lit(float(level.interval))
        return F.floor(value / step) * step
    if isinstance(level, DateHistogram):
        dtype = df.select(value.alias("v")).schema["v"].dataType
        if level.interval.isalpha():
            return F.date_trunc(level.interval, value).cast(dtype)
        return floor_time(value, dtype, level.interval)
    return value


def bucket_agg(
    df: DataFrame,
    levels: Sequence[Level],
    metrics: Mapping[str, Metric] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per innermost bucket: the keys of all levels, ``doc_count`` and the metrics.

    Level columns are SQL expressions over the table. ``metrics`` maps a result name to
    ``(function, column)``; functions are sum, avg, min, max, count, cardinality (approximate),
    exact_cardinality, percentile (approximate) and stats. With ``keep_empty`` a bucket without child
    buckets is still one row, its deeper keys null.

    Everything is one grouping with map-side combining, so a hot key costs one partial row per
    task. A last level of named filters is computed by conditional aggregates instead of
    multiplying rows. ``top_n`` and ``keep_empty`` work on the grouped rows, so the input is read once; only named
    filters above the last level, kept when empty, group by every prefix.
    """
    metrics = dict(metrics or {})
    if not levels:
        raise ValueError("bucket_agg needs at least one level; see root_agg")
    limits = _outer_limits(levels)
    keys = [f"_level_{i}" for i in range(len(levels))]
    if isinstance(levels[-1], Filters) and (not keep_empty or len(levels) == 1):
        out = _filters_last(df, levels, keys, metrics, limits)
    elif keep_empty and any(isinstance(level, Filters) for level in levels):
        keyed, hit = _with_keys(_limit_outer_levels(df, levels), levels, keys, keep_empty)
        out = _with_empty(keyed, levels, keys, metrics, hit)
    elif keep_empty:
        out = _kept_empty(_with_keys(df, levels, keys, False)[0], keys, metrics, limits)
    else:
        out = _grouped(_with_keys(df, levels, keys, False)[0], keys, metrics, limits)
    last = levels[-1]
    if isinstance(last, Terms) and last.top_n:
        out = _top(out, keys, last.top_n)
    named = [F.col(k).alias(level.name) for k, level in zip(keys, levels)]
    return out.select(*named, DOC_COUNT, *[F.col(quote(m)) for m in metrics])


def _with_keys(
    df: DataFrame, levels: Sequence[Level], keys: Sequence[str], keep_empty: bool
) -> tuple[DataFrame, Column | None]:
    """Rows with one key column per level, and the condition of the rows that count."""
    # all keys come from the table's own columns, before rows are multiplied
    plain = {k: _key(df, level) for k, level in zip(keys, levels) if not isinstance(level, Filters)}
    df, hit = df.withColumns(plain) if plain else df, None
    for depth, (key, level) in enumerate(zip(keys, levels)):
        if isinstance(level, Filters):
            if keep_empty and depth == 0:
                df, hit = _with_blank_filters(df, level, key)
            else:
                df, hit = _explode_filters(df, level, key, keep_empty, hit)
    return df, hit


def _grouped(keyed: DataFrame, keys: Sequence[str], metrics: Mapping[str, Metric], limits: Mapping[int, int]) -> DataFrame:
    # rows without a deeper key count for the buckets above them, which a limit ranks
    for key in keys[: max(limits) + 1] if limits else keys:
        keyed = keyed.where(F.col(key).isNotNull())
    out = _limited(keyed.groupBy(*keys).agg(F.count("*").alias(DOC_COUNT), *_measures(metrics)), keys, limits, DOC_COUNT)
    for key in keys if limits else ():
        out = out.where(F.col(key).isNotNull())
    return out


def _outer_limits(levels: Sequence[Level]) -> dict[int, int]:
    """``top_n`` by depth, of the levels above the last."""
    limits = {d: level.top_n for d, level in enumerate(levels[:-1]) if isinstance(level, Terms) and level.top_n}
    if any(isinstance(u, Filters) for d in limits for u in levels[:d]):
        raise ValueError("top_n below named filters is only supported on the last level")
    return limits


def _limited(grouped: DataFrame, keys: Sequence[str], limits: Mapping[int, int], count: str, keep_null: bool = False) -> DataFrame:
    """The grouped rows of the largest buckets at each limited depth; equal counts are ordered by key.

    Counts of outer buckets are sums of the groups below them. For the outermost level the grouped rows are written below
    the workspace when this is called, each outer bucket is ranked as one row, and the ``n`` keys become a condition: the
    input is read once, and no task ranks the groups of all buckets.
    """
    for depth, n in sorted(limits.items()):
        key = F.col(keys[depth])
        grouped = grouped if keep_null else grouped.where(key.isNotNull())
        if not depth:
            grouped = stored(grouped, "grouped")
            grouped = grouped.where(_largest(grouped, keys[0], n, count))
            continue
        total = F.sum(count).over(Window.partitionBy(*keys[: depth + 1]))
        grouped = grouped.withColumn("_total", F.when(key.isNotNull(), total))
        order = [F.col("_total").desc_nulls_last(), key.asc_nulls_last()]
        window = Window.partitionBy(*keys[:depth]).orderBy(*order)
        grouped = grouped.withColumn("_rank", F.dense_rank().over(window))
        inside = F.col("_rank") <= n
        grouped = grouped.where(inside | key.isNull() if keep_null else inside).drop("_total", "_rank")
    return grouped


def _largest(grouped: DataFrame, name: str, n: int, count: str) -> Column:
    """Whether a row belongs to one of the ``n`` largest values of a key, which come to the driver."""
    timed = isinstance(grouped.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))
    key = F.unix_micros(F.col(name).cast("timestamp")) if timed else F.col(name)
    sums = grouped.where(F.col(name).isNotNull()).groupBy(key.alias("_top")).agg(F.sum(count).alias("_total"))
    first = sums.orderBy(F.col("_total").desc(), F.col("_top").asc()).limit(n).select("_top").collect()
    return key.isin([r["_top"] for r in first]) if first else F.lit(False)


def _kept_empty(keyed: DataFrame, keys: Sequence[str], metrics: Mapping[str, Metric], limits: Mapping[int, int]) -> DataFrame:
    """Group once by the full key; a missing child stays where its bucket has no other."""
    keyed = keyed.where(F.col(keys[0]).isNotNull())
    for above, key in zip(keys, keys[1:]):
        keyed = keyed.withColumn(key, F.when(F.col(above).isNotNull(), F.col(key)))
    out = keyed.groupBy(*keys).agg(F.count("*").alias(DOC_COUNT), *_measures(metrics))
    out = _limited(out, keys, limits, DOC_COUNT, keep_null=True)
    for depth in range(1, len(keys)):
        children = F.count(keys[depth]).over(Window.partitionBy(*keys[:depth]))
        out = out.withColumn("_children", children)
        out = out.where(F.col(keys[depth]).isNotNull() | (F.col("_children") == 0)).drop("_children")
    return out


def _with_empty(
    keyed: DataFrame, levels: Sequence[Level], keys: Sequence[str], metrics: Mapping[str, Metric], hit: Column | None
) -> DataFrame:
    """Group by every prefix of the levels at once; a prefix stays where it has no child."""
    if hit is not None:
        # keys below a filter that did not match are no buckets
        first = next(i for i, level in enumerate(levels) if isinstance(level, Filters))
        for key, level in list(zip(keys, levels))[first + 1:]:
            if not isinstance(level, Filters):
                keyed = keyed.withColumn(key, F.when(hit, F.col(key)))
    keyed = keyed.where(F.col(keys[0]).isNotNull())
    # grouping sets null out their own keys, so children are counted on copies
    keyed = keyed.withColumns({f"_child_{i}": F.col(k) for i, k in enumerate(keys)})
    children = [F.count(f"_child_{i}").alias(f"_children_{i}") for i in range(len(keys))]
    count = F.count("*") if hit is None else F.count_if(hit)
    columns = [F.col(k) for k in keys]
    grouped = keyed.groupingSets([columns[: depth + 1] for depth in range(len(keys))], *columns).agg(
        count.alias(DOC_COUNT), F.grouping_id().alias("_set"), *children, *_measures(metrics, hit)
    )
    keep = F.lit(False)
    for depth in range(len(keys)):
        present = all_of([F.col(k).isNotNull() for k in keys[: depth + 1]])
        # bits of the keys that are not part of this prefix
        this = F.col("_set") == F.lit(2 ** (len(keys) - depth - 1) - 1)
        leaf = F.lit(True) if depth == len(keys) - 1 else F.col(f"_children_{depth + 1}") == 0
        keep = keep | (this & present & leaf)
    return grouped.where(keep)


def _tests(level: Filters) -> dict[str, Column]:
    return {n: F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)) for n, c in level.filters.items()}


def _with_blank_filters(df: DataFrame, level: Filters, key: str) -> tuple[DataFrame, Column]:
    """One row per matched filter, plus one blank row per declared name to keep names without hits.

    Without any row there is no bucket at all; the subquery for that stops at the first row.
    """
    matched, _ = _explode_filters(df, level, key, False, None)
    blank = df.sparkSession.createDataFrame([(n, False) for n in level.filters], T.StructType([
        T.StructField(key, T.StringType()), T.StructField("_hit", T.BooleanType()),
    ]))
    blank = blank.where(df.select(F.lit(1)).exists())
    return matched.withColumn("_hit", F.lit(True)).unionByName(blank, allowMissingColumns=True), F.col("_hit")


def _explode_filters(
    df: DataFrame, level: Filters, key: str, keep_empty: bool, hit: Column | None
) -> tuple[DataFrame, Column | None]:
    tests = _tests(level)
    if not keep_empty:
        names = F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()])
        return df.withColumn(key, F.explode(names)).where(F.col(key).isNotNull()), None
    flags = F.array(*[
        F.struct(F.lit(n).alias("n"), (t if hit is None else t & hit).alias("h")) for n, t in tests.items()
    ])
    out = df.withColumn("_flag", F.explode(flags))
    return out.withColumns({key: F.col("_flag.n"), "_hit": F.col("_flag.h")}).drop("_flag"), F.col("_hit")


def _filters_last(
    df: DataFrame, levels: Sequence[Level], keys: Sequence[str], metrics: Mapping[str, Metric], limits: Mapping[int, int]
) -> DataFrame:
    """Outer levels as grouping keys, and one conditional aggregate per named filter."""
    df, _ = _with_keys(df, levels[:-1], keys, False)
    for key in keys[: max(limits) + 1] if limits else keys[:-1]:
        df = df.where(F.col(key).isNotNull())
    tests = _tests(levels[-1])
    aggregates = [F.count("*").alias("_all")]
    for i, test in enumerate(tests.values()):
        aggregates.append(F.count_if(test).alias(f"_n_{i}"))
        aggregates += [measure(spec, test).alias(f"_m_{i}_{j}") for j, spec in enumerate(metrics.values())]
    grouped = _limited(df.groupBy(*keys[:-1]).agg(*aggregates), keys[:-1], limits, "_all")
    for key in keys[:-1] if limits else ():
        grouped = grouped.where(F.col(key).isNotNull())
    rows = F.array(*[
        F.struct(
            F.lit(n).alias(keys[-1]), F.col(f"_n_{i}").alias(DOC_COUNT),
            *[F.col(f"_m_{i}_{j}").alias(m) for j, m in enumerate(metrics)],
        )
        for i, n in enumerate(tests)
    ])
    return grouped.where(F.col("_all") > 0).select(*keys[:-1], F.inline(rows))


def _top(buckets: DataFrame, keys: Sequence[str], top_n: int) -> DataFrame:
    """The largest buckets below each parent; equal counts are ordered by key."""
    *parents, last = keys
    order = [F.col(DOC_COUNT).desc(), F.col(last).asc()]
    if not parents:
        return buckets.orderBy(*order).limit(top_n)
    window = Window.partitionBy(*parents).orderBy(*order)
    return buckets.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= top_n).drop("_rank")


def _limit_outer_levels(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Rows of the largest buckets of every outer level that has a ``top_n``, by reading the input again."""
    for depth, level in enumerate(levels[:-1]):
        if isinstance(level, Terms) and level.top_n:
            upper = list(levels[: depth + 1])
            # the levels above are limited already
            top = bucket_agg(df, [*[replace(u, top_n=None) if isinstance(u, Terms) else u for u in upper[:-1]], level]).select([F.col(quote(u.name)).alias(f"_top_{i}") for i, u in enumerate(upper)])
            own = {f"_own_{i}": _key(df, u) for i, u in enumerate(upper)}
            test = all_of([F.col(f"_own_{i}") == F.col(f"_top_{i}") for i in range(len(upper))])
            df = df.withColumns(own).join(top, test, "left_semi").drop(*own)
    return df


def root_agg(df: DataFrame, metrics: Mapping[str, Metric]) -> DataFrame:
    """Metrics over all rows as one record, each addressed as ``name.value``; no rows, no record."""
    values = [F.struct(measure(spec).alias("value")).alias(name) for name, spec in metrics.items()]
    return df.agg(F.count("*").alias("_all"), *values).where(F.col("_all") > 0).drop("_all")


@dataclass(frozen=True)
class BucketLevel:
    """One level of a bucket document: its name, key type, and whether buckets are named."""

    name: str
    key_type: str = "string"
    named: bool = False


def bucket_schema(
    levels: Sequence[BucketLevel], metrics: Mapping[str, str], fields: Mapping[str, str]
) -> T.StructType:
    """Schema of an aggregation document with these levels; metrics may occur at any depth."""
    def parsed(text: str) -> T.DataType:
        return T._parse_datatype_string(text)

    def below(rest: Sequence[BucketLevel]) -> list[T.StructField]:
        found = [T.StructField(m, T.StructType([T.StructField("value", parsed(t))])) for m, t in metrics.items()]
        if rest:
            inner = [T.StructField(n, parsed(t)) for n, t in fields.items()]
            inner += [T.StructField(DOC_COUNT, T.LongType()), *below(rest[1:])]
            if rest[0].named:
                buckets = T.MapType(T.StringType(), T.StructType(inner))
            else:
                buckets = T.ArrayType(T.StructType([T.StructField("key", parsed(rest[0].key_type)), *inner]))
            found.append(T.StructField(rest[0].name, T.StructType([T.StructField("buckets", buckets)])))
        return found

    return T.StructType(below(levels))


def flatten_buckets(
    df: DataFrame,
    json_col: str,
    levels: Sequence[BucketLevel],
    metrics: Mapping[str, str] | None = None,
    ids: Sequence[str] = (),
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Leaf records of aggregation documents held as JSON text, one document per row.

    ``metrics`` are single values given as ``{"value": ...}``, ``fields`` any other bucket fields, such
    as ``key_as_string`` or metrics with several values. A child's ``doc_count``, metrics and fields
    replace its parent's; an empty list of children leaves the parent as the record, with the deeper
    keys null.
    """
    metrics, fields = dict(metrics or {}), dict(fields or {})
    schema = bucket_schema(levels, metrics, fields)
    own = [column((i,)) for i in ids]
    out = df.select(*own, F.from_json(column((json_col,)), schema).alias("_node"))
    start = {DOC_COUNT: F.lit(None).cast("bigint")}
    start |= {m: column(("_node", m, "value")) for m in metrics}
    start |= {n: F.lit(None).cast(t) for n, t in fields.items()}
    out = out.select(*own, F.col("_node"), *[v.alias(n) for n, v in start.items()])
    paths = {n: ("_child", n, "value") if n in metrics else ("_child", n) for n in start}
    keys: list[str] = []
    for level in levels:
        buckets = column(("_node", level.name, "buckets"))
        kept = [column((c,)) for c in (*ids, *keys, *start)]
        if level.named:
            out = out.select(*kept, F.explode_outer(buckets).alias("_key", "_child"))
        else:
            out = out.select(*kept, F.explode_outer(buckets).alias("_child")).withColumn("_key", F.col("_child.key"))
        out = out.select(
            *[column((c,)) for c in (*ids, *keys)],
            F.col("_key").alias(level.name),
            *[F.coalesce(column(path), column((n,))).alias(n) for n, path in paths.items()],
            F.col("_child").alias("_node"),
        )
        keys.append(level.name)
    return out.drop("_node")
