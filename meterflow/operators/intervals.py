"""Metrics matched with the intervals, such as runs or maintenance times, that hold their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.durations import micros
from meterflow.functions.paths import column
from meterflow.operators.versions import _micros

#: Widths of bins grow by this factor.
GROWTH = 8
#: Widths there are: with bins from a microsecond on, the widest exceeds any length of time.
WIDTHS = 22


def _width(level: Column, base: int) -> Column:
    return F.element_at(F.array(*[F.lit(min(base * GROWTH**k, (1 << 63) - 1)) for k in range(WIDTHS)]), level + 1)


def _level(length: Column, base: int) -> Column:
    """The first width that is not below the length."""
    steps = [F.when(length > min(base * GROWTH**k, (1 << 63) - 1), 1).otherwise(0) for k in range(WIDTHS - 1)]
    return sum(steps[1:], steps[0])


def match_intervals(
    df: DataFrame, intervals: DataFrame, ts: str, start: str, end: str, keys: Sequence[tuple[str, str]] = (), base: str = "1m",
) -> DataFrame:
    """Pairs of a row of ``df`` and an interval with ``start <= ts < end`` (and equal ``keys``): the columns of both.

    Each interval is put in the bins of the first width that is not below its length, so it is in one or two bins however
    long it is; each row is in one bin of every width that occurs. Rows and intervals of a bin meet in a join on keys, width
    and bin, whose ends are then compared. An interval without an end lasts for ever; one without a start, or that is empty,
    holds nothing. ``base`` is the narrowest width. Columns of both tables must have different names.
    """
    both = set(df.columns) & set(intervals.columns)
    if both:
        raise ValueError(f"columns of both tables: {sorted(both)}")
    narrow = micros(base)
    forever = (1 << 62)
    first = _micros(intervals, start)
    last = F.coalesce(_micros(intervals, end), F.lit(forever))
    right = intervals.withColumns({"_from": first, "_to": last}).where("_from IS NOT NULL AND _to > _from")
    right = right.withColumn("_level", _level(F.col("_to") - F.col("_from"), narrow))
    width = _width(F.col("_level"), narrow)
    # the last bin is that of the last instant inside
    bins = F.array_distinct(F.array(_bin(F.col("_from"), width), _bin(F.col("_to") - 1, width)))
    right = right.withColumn("_bin", F.explode(bins))
    # at most as many as there are widths
    levels = sorted(r[0] for r in right.select("_level").distinct().collect())
    left = df.withColumn("_at", _micros(df, ts)).where("_at IS NOT NULL")
    places = F.array(*[F.struct(F.lit(n).alias("l"), _bin(F.col("_at"), F.lit(min(narrow * GROWTH**n, (1 << 63) - 1))).alias("b")) for n in levels])
    left = left.withColumn("_place", F.explode(places if levels else F.expr("CAST(array() AS ARRAY<STRUCT<l: INT, b: BIGINT>>)")))
    on = (F.col("_place.l") == F.col("_level")) & (F.col("_place.b") == F.col("_bin"))
    for a, b in keys:
        on = on & (left[a] == right[b])
    inside = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    found = left.join(right, on & inside)
    return found.select(*[column((c,)) for c in (*df.columns, *intervals.columns)])


def _bin(at: Column, width: Column) -> Column:
    return F.call_function("div", at - F.pmod(at, width), width)


#: Functions of ``interval_totals``: over a time, and over the running parts.
TOTALS = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def interval_totals(
    df: DataFrame, intervals: DataFrame, ts: str, start: str, end: str, metrics: dict[str, tuple[str, str | None]],
) -> DataFrame:
    """Each interval that holds rows of ``df`` (``start <= ts < end``), with a column per metric ``name: (function, column)``.

    The same as ``match_intervals`` then grouped by interval, without the pairs: a function is ``count`` (column ``None``:
    all rows), ``sum``, ``min`` or ``max``. Rows are first totalled by time. An interval is cut at the highest boundary of
    a bin of a power of two microseconds inside it, which makes it the end of one bin of that width and the start of the
    next; both are running values over the totals of a sorted bin. So the work grows with rows times widths that occur,
    not with rows times the intervals that hold them. Intervals have the same ends as in ``match_intervals``.
    """
    shift = 1 << 62
    forever = (1 << 62)
    at = _micros(df, ts)
    values = {f"_m{i}": (F.lit(1) if c is None else column((c,))) for i, (_, c) in enumerate(metrics.values())}
    rows = df.select((at + shift).alias("_at"), *[v.alias(k) for k, v in values.items()]).where("_at IS NOT NULL")
    funcs = [TOTALS[f] for f, _ in metrics.values()]
    totals = rows.groupBy("_at").agg(F.count("*").alias("_rows"), *[f(F.col(f"_m{i}")).alias(f"_m{i}") for i, (f, _) in enumerate(funcs)])
    first = _micros(intervals, start)
    # times are moved by 2**62 so that bins are of non-negative numbers; ends stop at 2**62 after it
    last = F.coalesce(_micros(intervals, end), F.lit(forever))
    right = intervals.select(F.struct(*[column((c,)) for c in intervals.columns]).alias("_interval"), (first + shift).alias("_from"), (F.least(last, F.lit(forever)) + (shift - 1)).alias("_last"))
    right = right.where("_from IS NOT NULL AND _last >= _from").withColumn("_id", F.monotonically_increasing_id())
    # the highest bit where the first and the last instant differ: the bins of that width that hold them meet inside
    level = F.length(F.bin(F.col("_from").bitwiseXOR(F.col("_last")))) - 1
    right = right.withColumn("_level", level.cast("int")).withColumn("_cut", F.expr("shiftleft(shiftright(_last, _level), _level)"))
    levels = sorted(r[0] for r in right.select("_level").distinct().collect())
    if not levels:
        return intervals.select(*[column((c,)) for c in intervals.columns], *[F.lit(None).alias(n) for n in metrics]).limit(0)
    widths = F.explode(F.array(*[F.lit(n) for n in levels]))
    bins = totals.withColumn("_level", widths).withColumn("_bin", F.expr("shiftright(_at, _level)"))
    # the end of the bin before the cut from the first instant on, the start of the bin at the cut up to the last one
    ends = right.select("_id", "_interval", "_level", (F.expr("shiftright(_cut, _level)") - 1).alias("_bin"), F.col("_from").alias("_at"), F.lit(1).alias("_tail"))
    starts = right.select("_id", "_interval", "_level", F.expr("shiftright(_cut, _level)").alias("_bin"), F.col("_last").alias("_at"), F.lit(0).alias("_tail"))
    asks = ends.unionByName(starts)
    both = bins.unionByName(asks, allowMissingColumns=True)
    ask = F.col("_id").isNotNull()
    # rows before asks at the same time
    rising = Window.partitionBy("_level", "_bin").orderBy("_at", ask).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    falling = Window.partitionBy("_level", "_bin").orderBy(F.col("_at").desc(), ask).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = ["_rows", *[f"_m{i}" for i in range(len(funcs))]]
    outer = [F.sum, *[g for _, g in funcs]]
    parts = {n: F.when(F.col("_tail") == 1, g(n).over(falling)).otherwise(g(n).over(rising)) for n, g in zip(names, outer)}
    found = both.withColumns(parts).where(ask)
    grouped = found.groupBy("_id").agg(F.first("_interval").alias("_interval"), *[g(n).alias(n) for n, g in zip(names, outer)])
    return grouped.where("_rows > 0").select("_interval.*", *[F.col(f"_m{i}").alias(n) for i, n in enumerate(metrics)])
