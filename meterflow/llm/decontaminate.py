"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A mask names the token positions that a seed hashes; the positions between are ignored, so a substituted word there
does not lose the seed. Seeds of benchmark items and of documents are joined; a hit fixes an item and the offset at
which it lies in the document, and the words of that alignment are compared one by one.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import SPACE, known, shared_dir, sized, stored

#: Masks as token positions. Of any 13 aligned words with at most two substituted, one of them finds six that agree.
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 6, 8, 9))
#: Words of a window that must agree by ``RATE``; an item of fewer words is one window.
WINDOW = 13
RATE = 0.8
#: Items of fewer words are not looked for: so few words agree by chance.
LEAST = 5
#: Words that a mask of a short item sees at least, as far as the item has that many besides its substitutions.
SEEN = 6


def words(text: Column) -> Column:
    """Hashes of the lower-case words between white space; null and empty texts have none."""
    bare = F.lower(F.btrim(known(text), F.lit(" \t\n\x0b\f\r")))
    hashes = F.transform(F.split(bare, SPACE), lambda w: F.xxhash64(w))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(hashes)


def _seeds(rows: DataFrame, keep: list[str], masks: list[tuple[int, ...]], used: list[tuple[int, ...]] | None = None) -> DataFrame:
    """``keep, seed, at``: the hash of every mask at every position where it fits, of rows with ``h`` (word hashes).

    ``used`` are the masks that count, all by default; a seed depends on the place of its mask in ``masks``.
    """
    used = masks if used is None else used
    reach = sorted({p for m in used for p in m})
    # the array shifted by each position of a mask: row i holds the words a mask at i sees
    shifted = [F.slice("h", p + 1, F.greatest(F.size("h") - p, F.lit(0))).alias(f"w{p}") for p in reach]
    index = F.when(F.size("h") > 0, F.sequence(F.lit(0), F.size("h") - 1)).otherwise(F.array().cast("array<int>"))
    spread = rows.select(*keep, *shifted, index.alias("at"))
    spread = spread.select(*keep, F.inline(F.arrays_zip("at", *[f"w{p}" for p in reach])))
    each = [F.when(F.col(f"w{m[-1]}").isNotNull(), F.xxhash64(F.lit(k), *[F.col(f"w{p}") for p in m])) for k, m in enumerate(masks) if m in used]
    return spread.select(*keep, F.explode(F.array(*each)).alias("seed"), "at").where("seed is not null")


def short_masks(n: int, rate: float = RATE) -> list[tuple[int, ...]]:
    """Masks of an item of ``n`` words, one of which sees none of the substitutions that ``rate`` allows, wherever they are.

    The words are cut into blocks and each mask leaves out as many of them as words may be substituted.
    """
    wrong = n - math.ceil(n * rate - 1e-9)
    for k in range(wrong + 1, n + 1):
        blocks = [range(n * j // k, n * (j + 1) // k) for j in range(k)]
        masks = [tuple(p for j in kept for p in blocks[j]) for kept in combinations(range(k), k - wrong)]
        if min(map(len, masks)) >= min(SEEN, n - wrong):
            break
    return masks


def item_masks(items: DataFrame, window: int = WINDOW, rate: float = RATE) -> dict[int, list[tuple[int, ...]]]:
    """The masks of each length of items below ``window`` words; lengths below ``LEAST`` have none."""
    # at most window - LEAST numbers
    short = items.select(F.size("h").alias("n")).where((F.col("n") >= LEAST) & (F.col("n") < window)).distinct().collect()
    return {n: short_masks(n, rate) for n in sorted(r["n"] for r in short)}


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
    item_text: str = "text", masks: tuple[tuple[int, ...], ...] = MASKS, window: int = WINDOW, rate: float = RATE,
) -> DataFrame:
    """One row per document and item found in it: ``id, item, n_matched, n_aligned``.

    An item is found where ``window`` consecutive aligned words (all of a shorter item) agree at a rate of at least
    ``rate``, whichever words are substituted; ``masks`` are those of whole windows and must suit both. The counts are
    those of its best alignment: equal words and words compared. Null and empty texts hold nothing, items of fewer than
    five words and null texts are not looked for. Null ids are an id like others. Repeated rows of an id are one
    document, repeated item rows one item. Without items or documents there are no rows.
    """
    shared_dir(docs.sparkSession)
    items = benchmark.select(F.col(f"`{item_column}`").alias("item"), words(F.col(f"`{item_text}`")).alias("h"))
    items = stored(items.where(F.size("h") >= LEAST).distinct(), "items")
    short = item_masks(items, window, rate)
    all_masks = list(dict.fromkeys([*masks, *[m for n in short for m in short[n]]]))
    wanted = _seeds(items.where(F.size("h") >= window), ["item"], all_masks, list(masks))
    for n in short:
        wanted = wanted.unionByName(_seeds(items.where(F.size("h") == n), ["item"], all_masks, short[n]))
    wanted = wanted.select(F.col("seed").alias("_seed"), "item", F.col("at").alias("item_at"))
    wanted = sized(stored(wanted.distinct(), "item-seeds"))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), words(F.col(f"`{text}`")).alias("h"))
    hits = _seeds(rows, ["id"], all_masks).join(wanted, F.col("seed") == F.col("_seed"))
    hits = hits.select("id", "item", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    hits = stored(hits, "hits").withColumnsRenamed({"id": "_id", "item": "_item"})
    # words again for the documents with a hit only
    near = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("t")).join(sized(hits), F.col("id").eqNullSafe(F.col("_id")))
    near = near.select("id", "_item", "offset", words(F.col("t")).alias("d")).join(
        sized(items.select(F.col("item").alias("_key"), "h")), F.col("_item").eqNullSafe(F.col("_key")))
    low = F.greatest(-F.col("offset"), F.lit(0))
    n = F.least(F.size("h") - F.col("low"), F.size("d") - F.col("offset") - F.col("low"))
    near = near.withColumn("low", low).withColumn("n_aligned", F.greatest(n, F.lit(0)))
    same = F.zip_with(F.expr("slice(d, offset + low + 1, n_aligned)"), F.expr("slice(h, low + 1, n_aligned)"),
                      lambda a, b: F.when(a.eqNullSafe(b), 1).otherwise(0))
    near = near.withColumn("same", same).withColumn("size", F.least(F.size("h"), F.lit(window)))
    best = F.when(F.col("n_aligned") >= F.col("size"), F.array_max(F.transform(
        F.expr("sequence(1, n_aligned - size + 1)"),
        lambda k: F.aggregate(F.slice("same", k, F.col("size")), F.lit(0), lambda a, x: a + x))))
    near = near.withColumn("best", best).where(F.col("best") >= F.ceil(F.col("size") * F.lit(rate) - F.lit(1e-9)))
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x).cast("long")
    out = near.select("id", "_item", F.struct(total.alias("n_matched"), F.col("n_aligned").cast("long").alias("n_aligned")).alias("m"))
    return out.groupBy("id", "_item").agg(F.max("m").alias("m")).select(
        F.col("id").alias(id_column), F.col("_item").alias(item_column), "m.n_matched", "m.n_aligned")
