"""Splitting a frame into bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.durations import micros
from meterflow.functions.keys import row_hash
from meterflow.functions.paths import column, quote
from meterflow.streaming.workspace import stored


# Fixed value: rows and period of a batch where no rate is given.
DEFAULT_RATE = "2000/500ms"


def parse_rate(rate: str) -> tuple[int, int]:
    """``"2000/500ms"`` as (rows per batch, microseconds per batch)."""
    size, _, period = rate.partition("/")
    if not size.strip().isdigit() or int(size) < 1 or not period:
        raise ValueError(f"rate must look like 2000/500ms, got {rate!r}")
    return int(size), micros(period)


def rows_per_batch(size: int | str) -> int:
    """Batch size given as a number or as the first part of a rate."""
    rows = parse_rate(size)[0] if isinstance(size, str) else size
    if rows < 1:
        raise ValueError("a batch holds at least one row")
    return rows


def local_batches(df: DataFrame, size: int | str = DEFAULT_RATE, name: str = "batch_id") -> DataFrame:
    """Batches of at most ``size`` consecutive rows within each partition, without a shuffle.

    Ids are unique but depend on how the data is split; the last batch of a partition may be short.
    """
    row = F.monotonically_increasing_id()
    partition = F.shiftright(row, 33)
    within = row.bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn(name, F.shiftleft(partition, 33) + _whole(within, rows_per_batch(size)))


def number_rows(df: DataFrame, seq: str, name: str = "row_no") -> DataFrame:
    """Consecutive row numbers from 0 in the order of an integer column, nulls first.

    Rows are sorted by ranges of (key, hash of the row) and written below the workspace; each range is numbered by itself
    and moved by the rows of the ranges before. Keys that repeat, or are all null, are cut by the hash, and numbered in an
    order that is the same in every run. ``df`` is read once, and once more (Spark's sample) to find the ranges.
    """
    key = F.col(quote(seq)).cast("bigint")
    order = [F.asc_nulls_first("_key"), F.asc("_hash")]
    ranged = df.withColumns({"_key": key, "_hash": row_hash(df)}).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.drop("_key", "_hash").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    # one row for each range: bounded by the number of partitions
    sizes = sorted(tuple(r) for r in rows.groupBy(part).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    before = F.broadcast(df.sparkSession.createDataFrame(starts, "_part bigint, _before bigint"))
    numbered = rows.withColumn("_own", part).join(before, F.col("_own") == F.col("_part"))
    return numbered.withColumn(name, F.col("_before") + within).select(*[column((c,)) for c in df.columns], name)


def batch_ids(
    df: DataFrame, size: int | str = DEFAULT_RATE, seq: str = frame.SEQ, name: str = "batch_id"
) -> DataFrame:
    """Batches of exactly ``size`` rows (the last may be short) in the order of ``seq``."""
    rows = rows_per_batch(size)
    numbered = number_rows(df, seq, "_number")
    return numbered.withColumn(name, _whole(F.col("_number"), rows)).drop("_number")


def _whole(number: Column, size: int) -> Column:
    """Integer division, exact for any row number."""
    return F.call_function("div", number, F.lit(size).cast("bigint"))
