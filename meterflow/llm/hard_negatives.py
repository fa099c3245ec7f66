"""Hard negatives by Kronecker-packed products.

Components become integers ``floor(scale * x)``. The components of several candidates, biased to be at least zero, are fields of
one wide integer; an anchor's biased component multiplies it once for all of them, and as no field can overflow into the
next, the summed products hold every candidate's exact inner product, which shifts and masks unpack. Wide integers of up
to 53 bits are kept in doubles, so that one matrix product does the multiplications exactly; values that leave no room
for two fields there are packed in integers of any width.

Candidates are tiles of vectors, dealt once to groups of tiles; the tiles that have anchors are sent to each group without
the others. Two passes over these pairs find an anchor's best rows of its label, then per positive the best rows of other labels
in the window its score sets. A group returns only its best rows, which a ranking over the anchors merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import shared_dir, stored

#: Bits of integers that doubles hold exactly.
EXACT = 53
#: Bytes of a tile's components, and of a group's.
TILE_BYTES, GROUP_BYTES = 128 << 10, 32 << 20
#: Scores held at once.
STRIP = 1 << 21
#: Positions of a tile's rows in keys, and anchors of a tile.
ROWS, ANCHORS = 1 << 20, 512

TILE = "dim int, width int, ids binary, labels binary, data binary"


class Packed:
    """Candidates' components, several to a wide integer, for anchors whose components are within ``low`` and ``high``."""

    def __init__(self, x: np.ndarray, low: int, high: int, bits: int = EXACT):
        n, d = x.shape
        self.n, self.d, self.low = n, d, low
        self.bias = int(x.min()) if x.size else 0
        spread = (int(x.max()) if x.size else 0) - self.bias
        #: no sum of products of biased components reaches the next field
        self.field = max(1, int(d * spread * (high - low)).bit_length())
        self.per = max(1, bits // self.field)
        self.doubles = self.per * self.field <= bits
        kind = np.float64 if self.doubles else object
        if not self.doubles:
            self.per = 4
        # field k holds the rows of the k-th part
        each = -(-n // self.per)
        wide = np.zeros((each, d), kind)
        for k in range(self.per):
            part = x[k * each:(k + 1) * each].astype(kind) - self.bias
            wide[:len(part)] += part * (2.0 ** (k * self.field) if self.doubles else 1 << (k * self.field))
        self.wide = np.ascontiguousarray(wide.T)
        self.sums = x.astype(object if not self.doubles else np.int64).sum(1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of the anchors with every candidate."""
        biased = anchors.astype(np.float64 if self.doubles else object) - self.low
        product = biased @ self.wide
        if self.doubles:
            product = product.astype(np.int64)
        mask = (1 << self.field) - 1
        fields = [product >> k * self.field & mask for k in range(self.per)]
        # <v + b, x + c> = <v, x> + c sum(v) + b sum(x) + d b c, for v = anchor - low and x = candidate - bias
        found = np.concatenate(fields, axis=1)[:, :self.n]
        totals = biased.astype(found.dtype).sum(1)
        found = found + self.bias * totals[:, None] + self.low * self.sums[None, :]
        if not self.doubles and found.size and max(int(found.max()), -int(found.min())) >= 1 << 62:
            raise ValueError("scores of over 62 bits")
        return found.astype(np.int64)


def _encode(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles of the rows that take part: equally long vectors, in the narrowest integers that hold them."""
        pending: dict[int, list] = {}
        for batch in batches:
            ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            ids = ids.to_numpy(zero_copy_only=False)
            labels = labels.to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                x = flat[(ends[rows] - d)[:, None] + np.arange(d)]
                ok = np.isfinite(x).all(1)
                x = np.floor(x[ok] * scale)
                if x.size and np.abs(x).max() >= 2.0 ** 62:
                    raise ValueError("components of over 62 bits")
                held = pending.setdefault(int(d), [])
                held.append((ids[rows[ok]].astype(np.int64), labels[rows[ok]].astype(np.int64), x.astype(np.int64)))
                most = max(1, min(ROWS, TILE_BYTES // max(2 * int(d), 1)))
                if sum(len(h[0]) for h in held) >= most:
                    yield from _tiles(pending.pop(int(d)), most)
        for d, held in pending.items():
            yield from _tiles(held, max(1, min(ROWS, TILE_BYTES // max(2 * d, 1))))

    return run


def _tiles(held: list, most: int) -> Iterator[pa.RecordBatch]:
    ids, labels, x = (np.concatenate(c) for c in zip(*held, strict=True))
    for k in range(0, len(ids), most):
        part = slice(k, k + most)
        width = next(w for w in (2, 4, 8) if not x[part].size or -(1 << 8 * w - 1) <= x[part].min() and x[part].max() < 1 << 8 * w - 1)
        yield pa.RecordBatch.from_arrays([
            pa.array([x.shape[1]], pa.int32()), pa.array([width], pa.int32()), pa.array([ids[part].tobytes()], pa.binary()),
            pa.array([labels[part].tobytes()], pa.binary()), pa.array([x[part].astype(f"<i{width}").tobytes()], pa.binary()),
        ], ["dim", "width", "ids", "labels", "data"])


def _only_anchors(every: int):
    """The anchors of a partition's tiles in tiles of their own, with the keys that tell rows apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[tuple[int, int], list] = {}

        def flush(held: list, dim: int, width: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([width], pa.int32()),
                *(pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in zip(*held, strict=True)),
            ], ["dim", "width", "ids", "labels", "data", "keys"])

        for batch in batches:
            for row in batch.to_pylist():
                tile = Tile(row)
                chosen = np.flatnonzero(tile.ids % every == 0)
                if len(chosen):
                    kind = row["dim"], row["width"]
                    held = pending.setdefault(kind, [])
                    held.append((tile.ids[chosen], tile.labels[chosen], tile.x[chosen], tile.keys[chosen]))
                    if sum(len(h[0]) for h in held) >= ANCHORS:
                        yield flush(pending.pop(kind), *kind)
        for kind, held in pending.items():
            yield flush(held, *kind)

    return run


class Tile:
    """A tile's rows; ``keys`` tell rows of all tiles apart."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.x = np.frombuffer(row["data"], f"<i{row['width']}").reshape(len(self.ids), row["dim"])
        known = row.get("keys")
        self.keys = np.frombuffer(known, np.int64) if known else row["no"] * ROWS + np.arange(len(self.ids))
        self.low, self.high = int(self.x.min(initial=0)), int(self.x.max(initial=0))


class Group:
    """A group's candidates of one dimension, in the order of ids, and their packed forms by label."""

    def __init__(self, tiles: list[Tile]):
        ids, labels, keys = (np.concatenate([getattr(t, c) for t in tiles]) for c in ("ids", "labels", "keys"))
        width = max(t.x.dtype.itemsize for t in tiles)
        x = np.concatenate([t.x.astype(f"<i{width}") for t in tiles])
        order = np.lexsort((keys, ids))
        self.ids, self.labels, self.keys, self.x = ids[order], labels[order], keys[order], x[order]
        self.packed: dict = {}

    def of(self, label: int | None, low: int, high: int) -> tuple[np.ndarray, Packed | None]:
        """Rows of a label (of all for none) and their packed form, which is made anew only for a wider range of anchors."""
        rows, packed, least, most = self.packed.get(label, (None, None, 0, 0))
        if rows is None or low < least or high > most:
            if rows is None:
                rows = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            least, most = min(low, least), max(high, most)
            packed = Packed(self.x[rows], least, most) if len(rows) else None
            self.packed[label] = rows, packed, least, most
        return rows, packed


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` highest scores, highest first, of equal ones the first."""
    chosen = np.arange(len(scores))
    if len(scores) > n:
        edge = np.partition(scores, len(scores) - n)[len(scores) - n]
        over = np.flatnonzero(scores > edge)
        chosen = np.concatenate([over, np.flatnonzero(scores == edge)[:n - len(over)]])
    return chosen[np.lexsort((chosen, -scores[chosen]))]


def _positives(n: int):
    def work(group: Group, tile: Tile, row: dict) -> Iterator[tuple]:
        """The group's best rows of each anchor's label."""
        for label in np.unique(tile.labels):
            mine = np.flatnonzero(tile.labels == label)
            rows, packed = group.of(int(label), tile.low, tile.high)
            if packed is None:
                continue
            strip = max(1, STRIP // len(rows))
            for k in range(0, len(mine), strip):
                part = mine[k:k + strip]
                for a, scores in zip(part, packed.scores(tile.x[part]), strict=True):
                    other = np.flatnonzero(group.keys[rows] != tile.keys[a])
                    for j in other[_best(scores[other], n)]:
                        yield row["home"], int(tile.keys[a]), int(tile.ids[a]), int(group.ids[rows[j]]), int(scores[j])

    return work


def _negatives(n: int, low_share: int, high_share: int):
    def work(group: Group, tile: Tile, row: dict) -> Iterator[tuple]:
        """The group's best rows of other labels within the window of each positive."""
        at = {int(k): i for i, k in enumerate(tile.keys)}
        wanted = [(at[a["key"]], a["found"]) for a in row["positives"]]
        _, packed = group.of(None, tile.low, tile.high)
        strip = max(1, STRIP // len(group.ids))
        for k in range(0, len(wanted), strip):
            part = wanted[k:k + strip]
            for (a, positives), scores in zip(part, packed.scores(tile.x[[w[0] for w in part]]), strict=True):
                # low_share p <= 100 s <= high_share p, in whole numbers
                windows = [(-(-low_share * p["score"] // 100), high_share * p["score"] // 100) for p in positives]
                first, last = min(w[0] for w in windows), max(w[1] for w in windows)
                near = np.flatnonzero((scores >= first) & (scores <= last) & (group.labels != tile.labels[a]))
                near = near[np.argsort(-scores[near], kind="stable")]
                falling = -scores[near]
                for p, (lowest, highest) in zip(positives, windows, strict=True):
                    start = int(np.searchsorted(falling, -highest, side="left"))
                    end = min(int(np.searchsorted(falling, -lowest, side="right")), start + n)
                    for j in near[start:end]:
                        yield int(tile.keys[a]), int(tile.ids[a]), p["number"], p["id"], p["score"], int(group.ids[j]), int(scores[j])

    return work


def _meet(work, names: list[str]):
    """Runs ``work`` on a group's candidates, which come first in it, and each anchor tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tiles, groups, out = None, {}, {}, []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != current:
                    current, tiles, groups = row["group"], {}, {}
                dim = row["dim"]
                if not row["anchor"]:
                    tiles.setdefault(dim, []).append(Tile(row))
                    continue
                if dim in tiles:
                    groups[dim] = Group(tiles.pop(dim))
                if dim in groups:
                    for found in work(groups[dim], Tile(row), row):
                        out.append(found)
                        if len(out) >= 1 << 16:
                            yield flush()
                            out.clear()
        if out:
            yield flush()

    return run


def _paired(candidates: DataFrame, anchors: DataFrame, n_groups: int, work, names: list[str]) -> DataFrame:
    """Candidates once, in their group; anchor tiles in every group."""
    groups = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    sent = anchors.select(groups.alias("group"), F.lit(True).alias("anchor"), *anchors.columns)
    rows = candidates.unionByName(sent, allowMissingColumns=True)
    dealt = rows.repartitionById(n_groups, F.col("group")).sortWithinPartitions("group", "anchor")
    return dealt.mapInArrow(_meet(work, names), ", ".join(f"{n} bigint" for n in names))


def hard_negatives(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100, positives: int = 5,
    negatives: int = 10, low_share: int = 30, high_share: int = 90, scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows whose id is divisible by ``every``.

    Scores are exact inner products of ``floor(scale * x)``, higher first, ties by the smaller id. An anchor's positives are
    its first ``positives`` other rows of the same label; for each, the first ``negatives`` rows of other labels with
    ``low_share <= 100 * score / positive's score <= high_share`` are returned, none if there are none. Rows with a null id,
    label or vector, or a null, infinite or NaN component, take no part; only vectors of equal length are compared. Rows that
    repeat an id are rows of their own: as anchors they repeat the result, as candidates each is ranked. Components or
    scores of over 62 bits are an error. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    shared_dir(spark)
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("_id"), F.col(f"`{label}`").cast("long").alias("_label"),
        F.col(f"`{vector}`").cast("array<double>").alias("_v")).dropna()
    tiles = stored(rows.mapInArrow(_encode(scale), TILE).withColumn("_at", F.monotonically_increasing_id()), "tiles")
    size = tiles.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    # as many groups as tasks run at once, more where a group would hold too much
    n_groups = max(1, -(-size["bytes"] // GROUP_BYTES), min(size["n"], 2 * spark.sparkContext.defaultParallelism))
    task, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    tiles = tiles.select((task * F.lit(1 << 22) + place).alias("no"), F.pmod(task + place, F.lit(n_groups)).cast("int").alias("group"), "*").drop("_at")
    candidates = tiles.select("group", F.lit(False).alias("anchor"), "no", "dim", "width", "ids", "labels", "data")
    anchors = tiles.drop("group").mapInArrow(_only_anchors(every), f"{TILE}, keys binary")
    anchors = stored(anchors.withColumn("home", F.monotonically_increasing_id()), "anchors")

    found = _paired(candidates, anchors, n_groups, _positives(positives), ["home", "key", "anchor_id", "id", "score"])
    order = [F.desc("score"), F.asc("id")]
    number = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    best = found.withColumn("number", number).where(F.col("number") <= positives)
    best = best.groupBy("home", "key").agg(F.sort_array(F.collect_list(F.struct("number", "id", "score"))).alias("found"))
    # at most the anchors of a tile
    best = stored(best.groupBy("home").agg(F.collect_list(F.struct("key", "found")).alias("positives")), "positives")
    anchors = anchors.join(best, "home").drop("home")

    names = ["key", "anchor_id", "number", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _paired(candidates, anchors, n_groups, _negatives(negatives, low_share, high_share), names)
    rank = F.row_number().over(Window.partitionBy("key", "number").orderBy(F.desc("negative_score"), F.asc("negative_id")))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
