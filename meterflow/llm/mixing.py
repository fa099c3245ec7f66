"""Mixing sources to target weights, in DataFrame operations only.

Sources get their share of a total by weight, capped at a multiple of their size; rates are target by size, and a
document appears ``floor(rate)`` times plus once more with the rate's fraction as probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import SPACE, known, shared_dir, sized, stored

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words between white space; null and empty texts have none."""
    t = known(text)
    edges = t.rlike(f"^{SPACE}").cast("int") + F.substring(t, -1, 1).rlike(SPACE).cast("int")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE)) - edges).cast("long")


def ranked(sources: DataFrame, source: str) -> DataFrame:
    """Sources with their position in code point order, null last, without a one-task window.

    Range partitions are numbered locally and shifted by the rows of the partitions before.
    """
    rows = stored(
        sources.repartitionByRange(F.col(source).isNull(), F.col(source))
        .sortWithinPartitions(F.col(source).isNull(), F.col(source))
        .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    # one row for each partition: bounded by the number of partitions
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(part.alias("p")).count().collect())
    shift, before = F.lit(0), 0
    offsets = {}
    for p, n in sizes:
        offsets[p] = before
        before += n
    if offsets:
        table = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
        shift = F.element_at(table, part)
    return rows.select(*sources.columns, (shift + local).cast("long").alias("position"))


def targets(sources: DataFrame, total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to rows of ``source_size`` and ``weight``: shares by weight, excess over the cap reshared.

    A level t gives each source min(weight * t, cap). Each round fixes the sources above their cap and recomputes t
    from one aggregated row; the set of fixed sources only grows, so the rounds end.
    """
    s = sources.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        free = F.lit(True) if level is None else (F.col("weight") * F.lit(level) < F.col("_cap"))
        row = s.agg(
            F.sum(F.when(free, 0.0).otherwise(F.col("_cap"))).alias("fixed"),
            F.sum(F.when(free, F.col("weight")).otherwise(0)).alias("weights"),
        ).first()
        if not row["weights"]:
            break
        new = (total * total_share - row["fixed"]) / row["weights"]
        if level is not None and new <= level * (1 + 1e-15):
            break
        level = new
    target = F.lit(0.0) if level is None else F.least(F.col("weight") * F.lit(float(level)), F.col("_cap"))
    return s.withColumn("target", target.cast("double")).drop("_cap")


def source_table(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``_key, source_size, target`` for each source of rows ``_source, size``: one stored row per source."""
    per_source = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    order = ranked(per_source, "_source")
    picked = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("position", F.lit(len(weights))) + 1).cast("int"))
    table = targets(stored(order.withColumn("weight", picked), "weights"), total_share, most)
    return stored(table.select(F.col("_source").alias("_key"), "source_size", "target"), "targets")


def _copies() -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 53 bits of the hash as a number in [0, 1)
    draw = F.shiftrightunsigned("_draw", 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _drawn(id_column: str, source: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.col(f"`{source}`"), F.col(f"`{text}`"))


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most: float = 2.0, seed: int = 42,
) -> DataFrame:
    """One row per document: ``id, size, source_size, target, copies, taken``.

    ``size`` is the number of words; sources in code point order (null is one, the last) get the weights in turn and
    share ``total_share`` of all words, at most ``most`` times their own. ``copies`` is the floor of the source's rate
    plus one with the fraction's probability, drawn from a hash of seed, id, source and text, so reruns agree and
    repeated rows are drawn alike. ``taken`` is copies times size. Documents without words take nothing; a source
    without words has target 0. An empty table gives no rows. Ids may be null.
    """
    shared_dir(docs.sparkSession)
    rows = stored(docs.select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{source}`").alias("_source"),
        word_count(F.col(f"`{text}`")).alias("size"), _drawn(id_column, source, text, seed).alias("_draw")), "sizes")
    table = source_table(rows, weights, total_share, most)
    joined = rows.join(sized(table), F.col("_source").eqNullSafe(F.col("_key")))
    return joined.withColumn("copies", _copies()).select(
        F.col("_id").alias(id_column), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most: float = 2.0, seed: int = 42, copy: str = "copy",
) -> DataFrame:
    """The mix itself: every column of ``docs``, each document as often as its copies, numbered from 0 in ``copy``.

    Documents without a copy are absent. Rows keep their own columns whatever these are called, except for ``copy``,
    which must not exist.
    """
    if copy in docs.columns:
        raise ValueError(f"the column {copy} is added and must not exist")
    shared_dir(docs.sparkSession)
    sizes = docs.select(F.col(f"`{source}`").alias("_source"), word_count(F.col(f"`{text}`")).alias("size"))
    table = source_table(sizes, weights, total_share, most)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{source}`").alias("_source"), _drawn(id_column, source, text, seed).alias("_draw"))
    joined = rows.join(sized(table), F.col("_source").eqNullSafe(F.col("_key"))).withColumn("copies", _copies())
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias(copy)
    return joined.where("copies > 0").select("_row", numbers).select("_row.*", copy)
