"""The largest term buckets of a column with very many distinct values, without shuffling all of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.operators.buckets import DOC_COUNT, Metric, Terms, _measures
from meterflow.streaming.workspace import stored


def _tallies(rows: DataFrame, tracked: int, cells: int) -> DataFrame:
    """``item, cell, n``: exact counts of the items a frequent-items sketch finds, and per cell the sum of all others.

    At most ``tracked`` plus ``cells`` rows; so many also is the most a task passes on.
    """
    sketch = F.call_function("approx_top_k", F.col("_item"), F.lit(tracked), F.lit(tracked))
    found = rows.agg(sketch.alias("s")).select(F.explode("s.item").alias("_found"))
    # one row per tracked item: bounded by the sketch
    known = rows.join(F.broadcast(found), F.col("_item") == F.col("_found"), "left")
    cell = F.when(F.col("_found").isNull(), F.pmod(F.xxhash64("_item"), F.lit(cells)))
    return known.groupBy(F.col("_found").alias("item"), cell.alias("cell")).agg(F.count("*").alias("n"))


def frequent_terms(df: DataFrame, term: str | Column, n: int, tracked: int = 4096, cells: int = 1 << 16) -> DataFrame:
    """``item, doc_count`` of the ``n`` most frequent values, exactly; of equal counts the smaller value comes first.

    A sketch names candidates. One pass counts them exactly and adds up all other values in ``cells`` by their hash: the sum
    of a cell bounds the count of each value in it. Where every cell is below the n-th candidate the answer is proven.
    Values of the other, open cells are counted in one more pass, so the result is exact for every distribution; only
    how many rows are shuffled depends on it. Null belongs to no bucket. The column is read three times; the
    tallies are written below the workspace when this is called.
    """
    if n < 1 or tracked < n:
        raise ValueError("the sketch must track at least as many values as are asked for")
    rows = df.select((F.expr(term) if isinstance(term, str) else term).alias("_item")).where("_item IS NOT NULL")
    tallies = stored(_tallies(rows, tracked, cells), "tallies")
    counted = tallies.where("item IS NOT NULL").select("item", F.col("n").alias(DOC_COUNT))
    # the n-th candidate, as a value of the plan; with fewer candidates every cell is open
    edge = counted.orderBy(F.col(DOC_COUNT).desc()).limit(n).agg(
        F.when(F.count("*") == n, F.min(DOC_COUNT)).otherwise(F.lit(0)).alias("edge"))
    open_cells = tallies.where("item IS NULL").where(F.col("n") >= edge.scalar()).select(F.col("cell").alias("_open"))
    candidates = tallies.where("item IS NOT NULL").select(F.col("item").alias("_found"))
    rest = rows.withColumn("_cell", F.pmod(F.xxhash64("_item"), F.lit(cells)))
    rest = rest.join(F.broadcast(open_cells), F.col("_cell") == F.col("_open"), "left_semi")
    rest = rest.join(F.broadcast(candidates), F.col("_item") == F.col("_found"), "left_anti")
    others = rest.groupBy(F.col("_item").alias("item")).agg(F.count("*").alias(DOC_COUNT))
    return counted.unionByName(others).orderBy(F.col(DOC_COUNT).desc(), F.col("item").asc()).limit(n)


def frequent_buckets(
    df: DataFrame, level: Terms, metrics: Mapping[str, Metric] | None = None, tracked: int = 4096, cells: int = 1 << 16
) -> DataFrame:
    """``bucket_agg`` of one terms level with ``top_n``, by ``frequent_terms``; metrics only see the rows of these buckets."""
    if not level.top_n:
        raise ValueError("give the level a top_n")
    metrics = dict(metrics or {})
    top = frequent_terms(df, level.column, level.top_n, tracked, cells)
    if not metrics:
        return top.withColumnRenamed("item", level.name)
    rows = df.withColumn("_term", F.expr(level.column)).join(top.withColumnRenamed("item", "_item").drop(DOC_COUNT), F.col("_term") == F.col("_item"), "left_semi")
    return rows.groupBy(F.col("_term").alias(level.name)).agg(F.count("*").alias(DOC_COUNT), *_measures(metrics))
