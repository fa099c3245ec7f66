"""Lookups in versioned documents: the version that is valid at a metric's time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow import frame
from meterflow.functions.paths import column
from meterflow.operators.lookup import merged_documents
from meterflow.streaming.workspace import stored

#: Ranges of an average partition's rows that a hot key is cut into.
FINENESS = 16


def hot_keys(rows: DataFrame, parts: int) -> DataFrame:
    """``_hot, _cuts``: keys with more rows than a range should hold, and the times that cut them into ranges.

    ``rows`` are ``_key, _at``. A key counts as hot above ``total / (FINENESS * parts)`` rows, so there are fewer than
    ``FINENESS * parts`` of them, with so many cuts in all.
    """
    counts = rows.groupBy("_key").agg(F.count("*").alias("_n"))
    total = rows.count()
    size = max(1, total // (FINENESS * parts))
    hot = stored(counts.where(F.col("_n") > size).withColumn("_ranges", F.ceil(F.col("_n") / F.lit(size)).cast("int")), "hot-keys")
    # a grid of quantiles, of which a key takes as many as it has ranges
    grid = FINENESS * parts
    steps = F.split(F.lit(",".join(str(i / grid) for i in range(1, grid))), ",").cast("array<double>")
    own = rows.join(F.broadcast(hot), "_key")
    cuts = own.groupBy("_key", "_ranges").agg(F.percentile_approx("_at", steps, F.lit(max(10_000, 10 * grid))).alias("_all"))
    picked = F.filter("_all", lambda c, i: F.floor((i + 1) * F.col("_ranges") / F.lit(grid)) > F.floor(i * F.col("_ranges") / F.lit(grid)))
    return stored(cuts.select(F.col("_key").alias("_hot"), F.array_distinct(picked).alias("_cuts")), "cuts")


def enrich_as_of(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    valid_from: str,
    ts: str | None = None,
    valid_to: str | None = None,
    include: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
    falsy_as_missing: bool = True,
    parts: int | None = None,
    sep: str = ".",
) -> DataFrame:
    """Merge the version of the document under ``key`` that is valid at each row's time over its attributes.

    Valid is the version with the latest ``valid_from`` not after the time (``ts``, the metric's time by default); with
    ``valid_to`` it also has to end after the time, else the row has no document. Fields and defaults are those of
    ``enrich``. Rows without a key or a time have no document. Of several versions of one key and time the one whose
    fields compare highest counts. Versions without a key or a start are left out.

    Versions and rows are merged in the order of time within each key and every row takes the last version before it: no
    pair of a row and another version is formed. Keys with very many rows are cut into ranges of time, each of which begins
    with the version carried over from the ranges before, so that a key holding most rows is many tasks.
    """
    spark = df.sparkSession
    value, _ = frame.field(df, key, sep)
    at = F.col(frame.TS) if ts is None else frame.field(df, ts, sep)[0]
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [column((c,)).alias(c) for c in dim.columns if c not in (dim_key, valid_from)]
    versions = dim.select(
        column((dim_key,)).alias("_key"), _micros(dim, valid_from).alias("_at"), F.struct(*fields).alias("_doc")
    ).where("_key IS NOT NULL AND _at IS NOT NULL")
    schema = versions.schema["_doc"].dataType
    plain = df.select(value.alias("_key"), _time(at, df).alias("_at"), F.struct(*[column((c,)) for c in df.columns]).alias("_row"))
    usable = F.col("_key").isNotNull() & F.col("_at").isNotNull()

    both = plain.where(usable).select("_key", "_at").unionByName(versions.select("_key", "_at"))
    cuts = hot_keys(both, parts)
    rows, versions = _ranged(plain.where(usable), cuts), _ranged(versions, cuts)
    merged = rows.withColumn("_doc", F.lit(None).cast(schema)).unionByName(
        _with_carried(versions, cuts).withColumn("_row", F.lit(None).cast(plain.schema["_row"].dataType)))
    # versions come before rows of the same time, a carried one before all
    order = [F.col("_at").asc_nulls_first(), F.col("_row").isNotNull(), F.to_json("_doc")]
    before = Window.partitionBy("_key", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col("_row").isNull(), F.struct(F.col("_doc").alias("d")))
    joined = merged.withColumn("_found", F.last(found, ignorenulls=True).over(before)).where("_row IS NOT NULL")
    joined = joined.select("_row", F.col("_found.d").alias("_doc"), F.col("_found").isNotNull().alias("_hit"), "_at")
    without = plain.where(~usable).select("_row", F.lit(None).cast(schema).alias("_doc"), F.lit(False).alias("_hit"), "_at")
    joined = joined.unionByName(without)
    if valid_to is not None:
        ends = _micros(dim.select(column((valid_to,))), valid_to, ("_doc", valid_to))
        hit = F.col("_hit") & F.coalesce(ends > F.col("_at"), ends.isNull())
        joined = joined.withColumn("_hit", hit).withColumn("_doc", F.when(F.col("_hit"), F.col("_doc")))
    joined = joined.select("_row.*", "_doc", "_hit")
    joined = joined.withMetadata(frame.FIELD, df.schema[frame.FIELD].metadata) if frame.is_frame(df) else joined
    return merged_documents(df, joined, schema, F.col("_hit"), include, defaults, falsy_as_missing, None)


def _micros(df: DataFrame, name: str, path: tuple[str, ...] | None = None) -> Column:
    """A time column in microseconds; other orders must be whole numbers."""
    kind = df.schema[name].dataType.typeName()
    value = column(path or (name,))
    return F.unix_micros(value.cast("timestamp")) if kind.startswith(("timestamp", "date")) else value.cast("bigint")


def _time(at: Column, df: DataFrame) -> Column:
    kind = df.select(at.alias("t")).schema["t"].dataType.typeName()
    return F.unix_micros(at.cast("timestamp")) if kind.startswith(("timestamp", "date")) else at.cast("bigint")


def _ranged(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds ``_range``: how many of the key's cuts are not after the time."""
    # fewer rows than a multiple of the partitions
    found = rows.join(F.broadcast(cuts), F.col("_key") == F.col("_hot"), "left")
    range_ = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_at"))), F.lit(0))
    return found.withColumn("_range", range_).drop("_hot", "_cuts")


def _with_carried(versions: DataFrame, cuts: DataFrame) -> DataFrame:
    """The versions, and for each later range of a hot key the last version of the ranges before it."""
    own = versions.join(F.broadcast(cuts), F.col("_key") == F.col("_hot"))
    ranges = F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_range")
    last = own.groupBy("_key", "_range").agg(F.max_by(F.struct("_doc"), F.struct("_at", F.to_json("_doc"))).alias("_last"))
    all_ranges = cuts.select(F.col("_hot").alias("_key"), ranges)
    # one row for each range of a hot key: bounded as the cuts are
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = all_ranges.join(last, ["_key", "_range"], "left").withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
    carried = carried.where("_carried IS NOT NULL").select("_key", F.lit(None).cast("bigint").alias("_at"), "_carried._doc", "_range")
    return versions.unionByName(carried)
