"""Embedding near duplicates: int8 tile products with an error bound for each vector.

A unit vector x is stored as int8 codes q with a scale s; ``|x - s q|`` is its quantisation error. By the triangle
and Cauchy-Schwarz inequalities ``<x, y>`` differs from ``s_x s_y <q_x, q_y>`` by at most
``|e_x| |y| + |s_x q_x| |e_y|``. Tile products of the codes are exact integers; only pairs whose upper bound reaches the
threshold and whose lower bound does not are recomputed in double precision.

Vectors are kept in the width they come in (floats as floats), as units and codes follow from them. Tiles are written
once and pairs of groups of tiles read them from there, so no tile is shuffled once per tile it meets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from meterflow.llm.shared import components, roots, shared_dir, stored

#: Most vectors and bytes of a tile, and rows of it multiplied at once, so that a product (2 MB) stays in a core's cache.
TILE = 4096
TILE_BYTES = 8 << 20
STRIP = 128
#: Tiles of a file, and bytes of a group of tiles; a task pairs two groups.
FILE_TILES = 4
GROUP_BYTES = 32 << 20
#: Links that a task collects before it reduces them to a forest.
EDGES = 1 << 20
#: Room for rounding in the double precision sums themselves.
SLACK = 1e-9


def units(x: np.ndarray) -> np.ndarray:
    """Rows of finite vectors, not all zero, as unit vectors in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1)[:, None]  # first by the largest component: squares neither overflow nor vanish
    return x / np.sqrt((x ** 2).sum(1))[:, None]


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and error norms of unit vectors."""
    scale = np.abs(x).max(1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * q) ** 2).sum(1))
    return q, scale, error


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer product of codes: float32 holds sums up to 2**24, that is 1040 components at a time."""
    out = None
    for k in range(0, a.shape[1], 1040):
        part = a[:, k:k + 1040].astype(np.float32, copy=False) @ b[:, k:k + 1040].astype(np.float32, copy=False).T
        out = part if out is None else out.astype(np.float64) + part
    return out


class Tile:
    """Unit vectors with codes (as floats, for products), scales, error norms, and norms of the vectors and of their codes."""

    def __init__(self, x: np.ndarray):
        q, self.scale, self.error = quantised(x)
        self.x, self.codes = x, q.astype(np.float32)
        self.norm = np.sqrt((x ** 2).sum(1)) + SLACK
        self.coded = np.sqrt(((self.scale[:, None] * q) ** 2).sum(1)) + SLACK


def tile_links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked rows of two tiles, strip by strip; of one tile each pair once."""
    return links(Tile(x), Tile(y), same, threshold)


def links(x: Tile, y: Tile, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``tile_links`` of prepared tiles."""
    # an integer product below this cannot reach the threshold with any row of y: one comparison leaves few pairs to bound
    least = threshold - 2 * SLACK - x.error * y.norm.max() - x.coded * y.error.max()
    low = np.floor(least / (x.scale * np.where(least > 0, y.scale.max(), y.scale.min()))) - 1
    for start in range(0, len(x.x), STRIP):
        product = _product(x.codes[start:start + STRIP], y.codes)
        limit = np.clip(low[start:start + STRIP], -2.0 ** 62, 2.0 ** 62).astype(product.dtype)
        flat = np.flatnonzero(product >= limit[:, None])
        i, j = flat // len(y.x), flat % len(y.x)
        if same:
            keep = j > i + start
            i, j = i[keep], j[keep]
        approx = product[i, j] * x.scale[start + i] * y.scale[j]
        i = start + i
        bound = x.error[i] * y.norm[j] + x.coded[i] * y.error[j] + SLACK
        keep = approx + bound >= threshold
        i, j, linked = i[keep], j[keep], (approx - bound >= threshold)[keep]
        open_ = np.flatnonzero(~linked)
        for k in range(0, len(open_), 1 << 16):
            part = open_[k:k + (1 << 16)]
            exact = (x.x[i[part]] * y.x[j[part]]).sum(1)
            linked[part] = exact >= threshold
        yield i[linked], j[linked]


def _classed(kind: str) -> Callable:
    """Rows with a hash of 128 bits of their unit vector in doubles, the vector and its dimension; null for rows that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=kind)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            classes: list[bytes | None] = [None] * len(lengths)
            data: list[bytes | None] = [None] * len(lengths)
            for n in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero((lengths == n) & known)
                x = flat[(ends[rows] - n)[:, None] + np.arange(n)]
                ok = np.isfinite(x).all(1) & (x != 0).any(1)
                rows, x = rows[ok], x[ok]
                for row, unit, v in zip(rows, units(x), x, strict=True):
                    classes[row] = hashlib.blake2b(unit.tobytes(), digest_size=16).digest()
                    data[row] = v.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(classes, pa.binary()), pa.array(lengths.astype(np.int32)), pa.array(data, pa.binary())],
                ["_id", "_class", "_dim", "_data"])

    return run


_TILES = "dim int, no bigint, ids binary, sizes binary, classes binary, data binary"


def _packed(tile: int) -> Callable:
    """The classes of a partition as tiles, a row each: ids, class sizes, hashes and the matrix. Numbers are unique over the partitions."""

    def packed(no: int, rows: pa.Table) -> pa.RecordBatch:
        data = [rows.column("rep").to_numpy().tobytes(), rows.column("size").to_numpy().tobytes(),
                b"".join(rows.column("_class").to_pylist()), b"".join(rows.column("_data").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [rows.column("_dim").slice(0, 1).combine_chunks(), pa.array([no], pa.int64()), *[pa.array([d], pa.binary()) for d in data]],
            ["dim", "no", "ids", "sizes", "classes", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, waiting = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            if no is None:
                part = batch.column("_part")[0].as_py()
                no = (part << 32) + part  # so that numbers of neighbouring partitions differ in parity, too
            dims = batch.column("_dim").to_numpy()
            for n in np.unique(dims).tolist():
                rows = pa.Table.from_batches([batch.filter(pa.array(dims == n))])
                rows = pa.concat_tables([waiting.pop(n), rows]) if n in waiting else rows
                most = max(1, min(tile, TILE_BYTES // len(rows.column("_data")[0].as_py())))
                while rows.num_rows >= most:
                    yield packed(no, rows.slice(0, most))
                    no, rows = no + 1, rows.slice(most)
                if rows.num_rows:
                    waiting[n] = rows
            if sum(rows.nbytes for rows in waiting.values()) > 4 * TILE_BYTES:  # vectors of many dimensions
                for n in list(waiting):
                    yield packed(no, waiting.pop(n))
                    no += 1
        for rows in waiting.values():
            yield packed(no, rows)
            no += 1

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_key, rep, size`` of the classes of each tile."""
    for batch in batches:
        for ids, sizes, classes in zip(*[batch.column(k).to_pylist() for k in ("ids", "sizes", "classes")], strict=True):
            keys = [classes[k:k + 16] for k in range(0, len(classes), 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(np.frombuffer(ids, np.int64)), pa.array(np.frombuffer(sizes, np.int64))],
                ["_key", "rep", "size"])


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """``id, n_links, component_id, kept`` for each row, by cosine in double precision.

    Equal directions are one class first, so copies are counted and never paired. The classes are packed into tiles;
    each pair of tiles meets once, in a task that reads two groups of tiles and returns counts and a spanning forest, never
    the pairs. Null, zero, empty or non-finite vectors link with nothing, vectors of different dimensions not with each
    other; a row with a null id has no links and a null component. Rows that repeat an id are vectors of one vertex. An
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    shared_dir(spark)
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.col(f"`{vector}`").alias("_v"))
    given = rows.schema["_v"].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    numpy_kind = "float32" if kind == "float" else "float64"
    rows = rows.withColumn("_v", F.col("_v").cast(f"array<{kind}>"))
    rows = stored(rows.mapInArrow(_classed(numpy_kind), "_id bigint, _class binary, _dim int, _data binary"), "units")
    # vectors of one class have the same unit vector, so any of them stands for it
    classes = rows.where("_class is not null").groupBy("_class").agg(
        F.min("_id").alias("rep"), F.count("*").alias("size"), F.first("_dim").alias("_dim"), F.first("_data").alias("_data"))
    tiles = classes.withColumn("_part", F.spark_partition_id().cast("long")).mapInArrow(_packed(TILE), _TILES)
    tiles = stored(tiles, "tiles", maxRecordsPerFile=FILE_TILES)
    found = stored(_pairs(tiles, threshold, numpy_kind), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("found"))
    comp = components(found.where("b is not null"))
    by_class = tiles.select("ids", "sizes", "classes").mapInArrow(_unpacked, "_key binary, rep bigint, size bigint")
    by_class = by_class.join(counts, F.col("rep") == counts.a, "left").join(comp, F.col("rep") == comp.id, "left").select(
        "_key", F.coalesce("component", "rep").alias("component"), (F.coalesce("found", F.lit(0)) + F.col("size") - 1).alias("links"))
    component = F.coalesce("component", "_id")
    return rows.select("_id", "_class").join(by_class, F.col("_class") == F.col("_key"), "left").select(
        F.col("_id").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))


def _pairs(tiles: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``a, b, n``: links ``n`` of the id ``a``, or a link ``a``-``b`` of a spanning forest, from every pair of stored tiles.

    Groups of tiles meet in a product of their partitions, which reads the stored tiles again for each pair and shuffles
    nothing. There are as many groups as memory asks for, or as keep all cores busy.
    """
    n, size = tiles.agg(F.count("*"), F.sum(F.octet_length("ids").cast("long") * F.col("dim"))).first()
    size = (size or 0) // 8 * np.dtype(kind).itemsize
    cores = tiles.sparkSession.sparkContext.defaultParallelism
    groups = max(1, math.ceil(size / GROUP_BYTES), min(n, math.ceil(math.sqrt(8 * cores))))
    left, right = (tiles.select(*[F.col(c).alias(f"{side}{c}") for c in ("dim", "no", "ids", "sizes", "data")]).coalesce(groups) for side in "lr")
    # of the two orders in which two tiles meet one is taken, each as often in every pair of groups
    once = F.expr("lno = rno OR ((lno < rno) = (pmod(lno + rno, 2) = 0))")
    return left.hint("shuffle_replicate_nl").join(right, (F.col("ldim") == F.col("rdim")) & once).mapInArrow(
        _pair_runner(threshold, kind), "a bigint, b bigint, n bigint")


def _pair_runner(threshold: float, kind: str) -> Callable:
    def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        low = roots(len(ids), at[:len(a)], at[len(a):])
        e = np.flatnonzero(low != np.arange(len(ids)))
        return ids[e], ids[low[e]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the tiles of two groups
        edges, kept, last = [], 0, (None, None)

        def tile(batch: pa.RecordBatch, side: str, row: int) -> Tile:
            data = np.frombuffer(batch.column(f"{side}data")[row].as_buffer(), kind)
            return Tile(units(data.reshape(-1, batch.column(f"{side}dim")[row].as_py())))

        for batch in batches:
            for row in range(batch.num_rows):
                lno, rno = batch.column("lno")[row].as_py(), batch.column("rno")[row].as_py()
                lid, rid, lsize, rsize = (
                    np.frombuffer(batch.column(k)[row].as_buffer(), np.int64) for k in ("lids", "rids", "lsizes", "rsizes"))
                if last[0] != lno:
                    last = lno, tile(batch, "l", row)
                same = lno == rno
                x, y = last[1], last[1] if same else tile(batch, "r", row)
                for i, j in links(x, y, same, threshold):
                    if not len(i):
                        continue
                    for no, ids, at, more in ((lno, lid, i, rsize[j]), (rno, rid, j, lsize[i])):
                        if no not in counts:
                            counts[no] = ids.copy(), np.zeros(len(ids), np.int64)
                        np.add.at(counts[no][1], at, more)
                    edges.append(forest(lid[i], rid[j]))
                    kept += len(edges[-1][0])
                    if kept > EDGES:  # what stays has fewer links than the two groups have vectors
                        edges, kept = [forest(*(np.concatenate(e) for e in zip(*edges, strict=True)))], 0
        for ids, n in counts.values():
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(n[some])], ["a", "b", "n"])
        if edges:
            a, b = forest(*(np.concatenate(e) for e in zip(*edges, strict=True)))
            for k in range(0, len(a), EDGES):
                part = slice(k, k + EDGES)
                yield pa.RecordBatch.from_arrays([pa.array(a[part]), pa.array(b[part]), pa.array(np.zeros(len(a[part]), np.int64))], ["a", "b", "n"])

    return run
