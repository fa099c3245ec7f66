"""Helpers of several operators: intermediate tables, components, blocks of large groups, token arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest row count of a side that is broadcast; beyond it the plan is a shuffle join.
BROADCAST_ROWS = 1_000_000

#: Bounds of the batches in which rows cross to Python.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2_000

#: White space of words: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, set here only for local sessions without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    # texts cross to Python in small batches: a task holds a few of them, on both sides
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: int) -> DataFrame:
    """The frame written to the shared folder, with the writer's ``options``, and read again: cuts lineage and survives lost executors."""
    path = fresh_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The stored frame, with a broadcast hint if it has at most ``limit`` rows; else the caller's join shuffles."""
    return F.broadcast(df) if df.count() <= limit else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every id in the edges; the component is its smallest id.

    Alternates two star steps until the edges are the stars of their smallest ids. Every step is an aggregation
    with map-side combine and an equi-join, so a hub with many neighbours is no single group.
    """
    shared_dir(edges.sparkSession)
    e = edges.select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    ).where("u <> v").distinct().checkpoint()
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours move to the smallest neighbour of their hub
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        # the others of a node move to its smallest one
        e = e.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")
        ).select("s.*").where("u <> v").distinct().checkpoint()
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    stars = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def block_rows(df: DataFrame, group: str, item: str, size: int) -> DataFrame:
    """Rows of each group dealt to pairs of blocks, so that every pair of rows of a group meets exactly once.

    A group of n rows has ``ceil(n / size)`` blocks by the hash of ``item``; a row goes to each pair its block is in.
    Adds ``left``/``right`` (blocks of the pair) and ``block`` (the row's own); groups up to ``size`` stay one row each.
    """
    counts = df.groupBy(group).agg(F.ceil(F.count("*") / F.lit(size)).alias("_blocks")).where("_blocks is not null")
    own = F.pmod(F.xxhash64(item), "_blocks")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), lambda j: F.struct(
        F.least(F.col("block"), j).alias("left"), F.greatest(F.col("block"), j).alias("right")))
    return df.join(counts, group).withColumn("block", own).withColumn("_pair", F.explode(pairs)).select(
        *df.columns, "block", "_pair.left", "_pair.right")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches sorted by them; a run may cross batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*rest, batch]).combine_chunks()
        cols = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change) + 1
        start = 0
        for cut in cuts:
            yield table.slice(start, cut - start)
            start = int(cut)
        rest = table.slice(start).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def dealt(df: DataFrame, keys: list[str], fn: Callable, schema: str, parts: int | None = None) -> DataFrame:
    """``fn`` over partitions in which the rows of equal ``keys`` are together and sorted."""
    n = [parts] if parts else []
    return df.repartition(*n, *keys).sortWithinPartitions(*keys).mapInArrow(fn, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n items by the links ``a``-``b``."""
    low = np.arange(n)
    while len(a):
        # hook the larger root of each link to the smaller one, then point every item at its root
        ra, rb = low[a], low[b]
        np.minimum.at(low, np.maximum(ra, rb), np.minimum(ra, rb))
        nxt = low[low]
        while (nxt != low).any():
            low, nxt = nxt, nxt[nxt]
        keep = low[a] != low[b]
        a, b = a[keep], b[keep]
    return low


def known(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


# ---------------------------------------------------------------------------------------------------------------
# token arrays: whole batches of texts as numpy arrays

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACES] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, 1 << 21)
        for name, base in (("p", _P), ("q", pow(_P, -1, 1 << 64))):
            base_array = np.full(size, base, dtype=np.uint64)
            base_array[0] = 1
            _powers[name] = np.multiply.accumulate(base_array)
    return _powers["p"], _powers["q"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text; a longer text is a slice of its own."""
    text = batch.column(batch.schema.get_field_index(column))
    sizes = np.diff(_offsets(text))
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def _offsets(text: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], kind)[text.offset: text.offset + len(text) + 1].astype(np.int64)


class Tokens:
    """Words of a slice of texts: ``doc`` (row of each word), ``start``/``end`` (byte range), ``count`` per row."""

    def __init__(self, text: pa.Array, lower: bool = True):
        offsets = _offsets(text)
        raw = text.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        word = ~_SPACES[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        edge = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[edge] = word[edge]
        self.start = np.flatnonzero(first)
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(text)).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        p, q = _power(len(self.data) + 1)
        terms = _BYTE[self.data] * p[: len(self.data)]
        return mixed(np.add.reduceat(terms, self.start) * q[self.start])

    def first_of(self) -> np.ndarray:
        """Index of each row's first word, and the total at the end."""
        return np.concatenate([[0], np.cumsum(self.count)])
