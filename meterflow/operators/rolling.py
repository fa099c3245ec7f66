"""Values over a trailing frame of time, for every row of a series, and histograms without gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.durations import micros
from meterflow.functions.paths import column, quote
from meterflow.operators.buckets import DOC_COUNT
from meterflow.operators.versions import _micros

#: Functions over a frame.
ROLLING = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
#: Buckets of a piece of a gap, and of a stretch of a histogram.
PIECE = 1024


def rolling(
    df: DataFrame, series: Sequence[str], ts: str, frame: str, metrics: Mapping[str, tuple[str, str]], chunk: str | None = None,
) -> DataFrame:
    """Adds a column for each metric ``name: (function, column)`` over the rows of the series within ``[ts - frame, ts]``.

    Time is cut into blocks one frame wide. A row's frame is the part of its own block up to it and the part of the block
    before from ``ts - frame`` on; so each block is one task together with the block before it, and both parts are running
    values in a sorted block, linear in its rows however many rows a frame holds. A row is read twice at most. ``chunk`` is
    kept for callers; blocks are always one frame. Rows at the same time see each other. Rows without a time have null
    values; those without a series name are a series.
    """
    length = micros(frame)
    width = max(length, 1)
    rows = df.select(F.struct(*[column((c,)) for c in df.columns]).alias("_row"), _micros(df, ts).alias("_at"), *[column((s,)).alias(f"_series_{i}") for i, s in enumerate(series)])
    own = F.call_function("div", F.col("_at") - F.pmod("_at", F.lit(width)), F.lit(width))
    # each block also goes to the task of the next one, where it is the block before
    timed = rows.where("_at IS NOT NULL").withColumn("_own", own).withColumn("_chunk", F.explode(F.array(own, own + 1)))
    keys = [f"_series_{i}" for i in range(len(series))]
    before = F.col("_own") < F.col("_chunk")
    # rows of the block from the start to each row, peers included
    ahead = Window.partitionBy(*keys, "_chunk").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # rows of the block before from ``ts - frame`` on: its rows and the starts of frames by time, falling, its rows first
    start = F.when(before, F.col("_at")).otherwise(F.col("_at") - length)
    behind = Window.partitionBy(*keys, "_chunk").orderBy(start.desc(), F.when(before, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = {}
    for name, (f, c) in metrics.items():
        value = column(("_row", c))
        funcs = ("sum", "count") if f == "avg" else (f,)
        for g in funcs:
            parts[f"_{name}_{g}_own"] = ROLLING[g](F.when(~before, value)).over(ahead)
            parts[f"_{name}_{g}_before"] = ROLLING[g](F.when(before, value)).over(behind)
    found = timed.withColumns(parts).where(~before)
    sums = {f.name: f.dataType for f in found.schema.fields}
    out = found.withColumns({name: _joined(f, name, sums) for name, (f, _) in metrics.items()}).select("_row.*", *[F.col(quote(m)) for m in metrics])
    kinds = {f.name: f.dataType for f in out.schema.fields}
    untimed = rows.where("_at IS NULL").select("_row.*", *[F.lit(None).cast(kinds[m]).alias(m) for m in metrics])
    return out.unionByName(untimed)


def _joined(f: str, name: str, kinds) -> Column:
    """A metric over a frame from its values over the two parts."""
    def both(g):
        return F.col(f"_{name}_{g}_own"), F.col(f"_{name}_{g}_before")
    if f == "count":
        a, b = both("count")
        return a + b
    if f == "min":
        return F.least(*both("min"))
    if f == "max":
        return F.greatest(*both("max"))
    a, b = both("sum")
    total = F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    if f == "sum":
        return total.cast(kinds[f"_{name}_sum_own"])
    n, m = both("count")
    return total.cast("double") / (n + m)


def fill_gaps(buckets: DataFrame, parents: Sequence[str], key: str, interval: str) -> DataFrame:
    """The buckets of a date histogram of a fixed duration, and empty ones between the first and the last of each parent.

    Empty buckets have ``doc_count`` 0 and null metrics. A gap is cut into pieces of ``PIECE`` buckets, which are dealt to
    tasks and only then expanded, so a rare parent's gap of millions of buckets is no single row's work. Gaps are found
    within stretches of time and between the stretches, so no parent is sorted as a whole.
    """
    step = micros(interval)
    kind = buckets.schema[key].dataType
    at = _micros(buckets, key)
    rows = buckets.where(column((key,)).isNotNull()).select(*[column((p,)).alias(f"_p{i}") for i, p in enumerate(parents)], at.alias("_at"))
    names = [f"_p{i}" for i in range(len(parents))]
    stretch = F.call_function("div", F.col("_at") - F.pmod("_at", F.lit(step * PIECE)), F.lit(step * PIECE))
    rows = rows.withColumn("_stretch", stretch)
    within = Window.partitionBy(*names, "_stretch").orderBy("_at")
    gaps = rows.withColumn("_next", F.lead("_at").over(within)).select(*names, "_at", "_next")
    ends = rows.groupBy(*names, "_stretch").agg(F.min("_at").alias("_first"), F.max("_at").alias("_at"))
    across = ends.withColumn("_next", F.lead("_first").over(Window.partitionBy(*names).orderBy("_stretch"))).select(*names, "_at", "_next")
    gaps = gaps.unionByName(across).where(F.col("_next") > F.col("_at") + step)
    count = F.call_function("div", F.col("_next") - F.col("_at"), F.lit(step)) - 1
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1, F.lit(PIECE).cast("bigint")))
    pieces = gaps.withColumn("_count", count).withColumn("_start", starts).repartition(*names, "_at", "_start")
    numbers = F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + PIECE, F.col("_count")) - 1))
    empty = pieces.withColumn("_n", numbers).select(*names, (F.col("_at") + (F.col("_n") + 1) * step).alias("_at"))
    filled = empty.select(
        *[F.col(n).alias(p) for n, p in zip(names, parents)], _as_time(F.col("_at"), kind).alias(key), F.lit(0).cast("bigint").alias(DOC_COUNT))
    return buckets.unionByName(filled, allowMissingColumns=True)


def _as_time(at: Column, kind) -> Column:
    return F.timestamp_micros(at).cast(kind) if kind.typeName().startswith(("timestamp", "date")) else at.cast(kind)
