"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Words are runs between white space, A-Z lower-cased; an n-gram is a 64-bit hash of five words (all words of a shorter
text). Texts with equal n-gram sets are one class, so copies never meet as pairs.

1. Bands: ``rows`` hash values a band and as many bands as the target recall asks for at the threshold; class
   representatives are shuffled on the band hashes.
2. Buckets with several classes compare whole signatures and link those whose estimate is at most ``margin`` below the
   threshold. What they link is a family: a superset, up to the target recall, of all connected documents.
3. Families verify pairs on full n-gram sets, counting links and keeping a spanning forest.

Buckets and families are compared by pairs of blocks of bounded size. No step returns pairs, only counts and forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import (
    Tokens,
    block_rows,
    components,
    dealt,
    grouped,
    mixed,
    pieces,
    roots,
    shared_dir,
    sized,
    stored,
)

#: Documents of a block: two blocks of full n-gram sets are what one task holds.
BLOCK = 256
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def choose_bands(threshold: float = 0.8, recall: float = 0.9999, most: int = 192) -> tuple[int, int]:
    """Bands and rows a band: the most rows for which a pair at the threshold is still found with the target recall.

    A pair of similarity t agrees in a band of r rows with probability t**r, in one of b bands with
    ``1 - (1 - t**r)**b``; ``most`` bounds b * r.
    """
    best = None
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))) if threshold < 1 else 1
        if rows * bands > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach this recall with so few hash values")
    return best


def margin(threshold: float, hashes: int, deviations: float = 5.0) -> float:
    """How far an estimate from so many hash values may fall below the truth at the threshold."""
    return deviations * math.sqrt(threshold * (1 - threshold) / hashes)


def gram_sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted n-gram hashes of each text; empty for texts without words."""
    t = Tokens(text)
    h, first = t.hashes(), t.first_of()
    if len(h) >= n:
        g = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            g = mixed(g * _ODD[0] + h[k: len(h) - n + 1 + k] + _ODD[1])
    else:
        g = np.zeros(0, np.uint64)
    out = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= n:
            out.append(np.unique(g[lo: hi - n + 1]))
        elif hi > lo:
            one = np.zeros(1, np.uint64)
            for x in h[lo:hi]:
                one = mixed(one * _ODD[2] + x + _ODD[3])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signer(bands: int, rows: int, n: int):
    rng = np.random.default_rng(8)
    a = (rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    b = rng.integers(0, 2**32, bands * rows, dtype=np.uint64).astype(np.uint32)[:, None]

    def sign(grams: np.ndarray) -> np.ndarray:
        low = None
        x = (grams >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(x), 2048):
            part = (x[k:k + 2048][None, :] * a + b).min(1)
            low = part if low is None else np.minimum(low, part)
        return low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in batches:
            for piece in pieces(batch, "_text"):
                sets = gram_sets(piece.column(1), n)
                low, high, sizes, hashes, signs = [], [], [], [], []
                for grams in sets:
                    if not len(grams):
                        low.append(None), high.append(None), sizes.append(0), hashes.append(None), signs.append(None)
                        continue
                    # two independent sums over the set are its 128-bit name
                    low.append(int(mixed(grams).sum(dtype=np.uint64).view(np.int64)))
                    high.append(int(mixed(grams ^ _ODD[3]).sum(dtype=np.uint64).view(np.int64)))
                    sizes.append(len(grams))
                    s = sign(grams)
                    h = number * _ODD[1]
                    for r in range(rows):
                        h = mixed(h ^ (s[r::rows].astype(np.uint64) + _ODD[2]))
                    hashes.append(h.view(np.int64))
                    signs.append((s & np.uint32(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                    ["_id", "set_low", "set_high", "grams", "bands", "signature"])

    return run


SIGNED = "_id bigint, set_low bigint, set_high bigint, grams bigint, bands array<bigint>, signature binary"


def signatures(docs: DataFrame, bands: int, rows: int, n: int = 5) -> DataFrame:
    """``_id, set_low, set_high, grams, bands, signature`` of documents ``_id, _text``."""
    return docs.select("_id", F.coalesce("_text", F.lit("")).alias("_text")).mapInArrow(_signer(bands, rows, n), SIGNED)


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the left and right block of a pair of blocks."""
    block, left, right = (rows.column(c).to_numpy() for c in ("block", "left", "right"))
    return np.flatnonzero(block == left), np.flatnonzero(block == right), bool(left[0] == right[0])


def _once(rows: pa.Table) -> pa.Table:
    """The first row of each id: repeated rows of a document are in the same block."""
    _, first = np.unique(rows.column("_id").to_numpy(), return_index=True)
    return rows if len(first) == rows.num_rows else rows.take(pa.array(np.sort(first)))


def _forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row to the smallest row reachable, for rows sorted by id."""
    low = roots(len(ids), a, b)
    e = np.flatnonzero(low != np.arange(len(ids)))
    return ids[e], ids[low[e]]


def _bucket_links(cutoff: float):
    """Edges between rows of a bucket whose signatures estimate a similarity of at least ``cutoff``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for rows in map(_once, grouped(batches, ["band", "left", "right"])):
            if rows.num_rows < 2:
                continue
            ids = rows.column("_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
            sizes = rows.column("grams").to_numpy()
            left, right, same = _sides(rows)
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            la, lb = [], []
            for i in left:
                js = right[ids[right] > ids[i]] if same else right
                if not len(js):
                    continue
                # one byte of a value agrees by chance once in 256
                est = ((signs[js] == signs[i]).mean(1) - 1 / 256) / (1 - 1 / 256)
                # the sizes alone bound the similarity
                top = np.minimum(sizes[js], sizes[i]) / np.maximum(sizes[js], sizes[i])
                hit = js[np.minimum(est, top + 1e-12) >= cutoff]
                la.append(np.full(len(hit), place[i]))
                lb.append(place[hit])
            if la:
                a, b = _forest(ids[order], np.concatenate(la), np.concatenate(lb))
                out_a.append(a)
                out_b.append(b)
            if sum(map(len, out_a)) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
                out_a, out_b = [], []
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return run


def _set_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                grams = pa.array([g.tobytes() for g in gram_sets(piece.column(piece.schema.get_field_index("_text")), n)], pa.binary())
                names = [c for c in piece.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays([*[piece.column(piece.schema.get_field_index(c)) for c in names], grams], [*names, "grams"])

    return run


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 8192) -> np.ndarray:
    """Common n-grams of each left and right set, as products of 0/1 matrices of ``width`` n-grams at a time."""
    names = np.concatenate([sets[i] for i in (left if left is right else np.concatenate([left, right]))])
    values, counts = np.unique(names, return_counts=True)
    shared = values[counts > 1]  # an n-gram of one set is in no overlap
    out = np.zeros((len(left), len(right)), np.float32)
    where = {}
    for i in np.unique(np.concatenate([left, right])):
        at = np.searchsorted(shared, sets[i])
        fits = at < len(shared)
        at, own = at[fits], sets[i][fits]
        where[i] = at[shared[at] == own]
    for start in range(0, len(shared), width):
        m = min(width, len(shared) - start)

        def matrix(side: np.ndarray) -> np.ndarray:
            x = np.zeros((len(side), m), np.float32)
            for k, i in enumerate(side):
                at = where[i]
                x[k, at[np.searchsorted(at, start): np.searchsorted(at, start + m)] - start] = 1
            return x

        x = matrix(left)
        out += x @ (x if left is right else matrix(right)).T
    return out


def _family_links(threshold: float):
    """Counts ``(a, null, n)`` and forest edges ``(a, b, 0)`` of the pairs of a family that reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in map(_once, grouped(batches, ["family", "left", "right"])):
            if rows.num_rows < 2:
                continue
            ids, weight = rows.column("_id").to_numpy(), rows.column("copies").to_numpy()
            sets = [np.frombuffer(g, np.uint64) for g in rows.column("grams").to_pylist()]
            size = np.array([len(s) for s in sets], np.float64)
            left, right, same = _sides(rows)
            if not len(left) or not len(right):
                continue
            common = overlaps(sets, left, left if same else right).astype(np.float64)
            right = left if same else right
            # whole numbers: common >= threshold * union, with room for the threshold's own rounding
            linked = common * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) * (1 - 1e-12)
            if same:
                np.fill_diagonal(linked, False)
            n = np.zeros(len(ids), np.int64)
            n[left] += linked @ weight[right]
            if not same:
                n[right] += linked.T @ weight[left]
            i, j = np.nonzero(linked)
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            a, b = _forest(ids[order], place[left[i]], place[right[j]])
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[k], a])),
                pa.array(np.concatenate([np.zeros(len(k), np.int64), b]), mask=np.arange(len(k) + len(a)) < len(k)),
                pa.array(np.concatenate([n[k], np.zeros(len(a), np.int64)]))], ["a", "b", "n"])

    return run


def ngram_join(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
    recall: float = 0.9999, hashes: int = 192,
) -> DataFrame:
    """``id, n_links, component_id, kept`` for each row.

    ``n_links`` counts the other rows whose n-gram set has a Jaccard similarity of at least ``threshold``, copies
    included; ``component_id`` is the smallest id reachable by links, ``kept`` whether it is the row's own. Texts
    without words (null, empty, white space) link with nothing. A row with a null id counts nowhere and comes back
    without links and with a null component. Repeated rows are copies of each other. An empty table gives no rows.
    """
    bands, rows = choose_bands(threshold, recall, hashes)
    shared_dir(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    signed = stored(signatures(plain, bands, rows, n), "signatures")
    names = ["set_low", "set_high"]
    usable = signed.where("_id is not null and grams > 0")
    classes = stored(usable.groupBy(*names).agg(F.min("_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # one signature for each class: its smallest id's (repeated rows are equal in everything)
    reps = usable.join(classes.select(F.col("rep").alias("_id"), *names), ["_id", *names], "left_semi")
    buckets = reps.select("_id", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1").select("band")
    members = stored(buckets.join(shared, "band").distinct(), "members")
    signs = reps.join(members.select("_id").distinct(), "_id", "left_semi").select("_id", "grams", "signature")
    rows_ = block_rows(members, "band", "_id", BLOCK).join(signs, "_id")
    cutoff = threshold - margin(threshold, bands * rows)
    edges = dealt(rows_.select("band", "left", "right", "block", "_id", "grams", "signature"), ["band", "left", "right"],
                  _bucket_links(cutoff), "a bigint, b bigint")
    families = stored(components(stored(edges, "candidates")), "families")
    wanted = families.join(classes.select("rep", "copies"), families.id == F.col("rep")).select("id", F.col("component").alias("family"), "copies")
    wanted = stored(wanted, "wanted")
    texts = plain.join(sized(wanted), plain._id == wanted.id)
    sets = texts.select("_id", "family", "copies", F.coalesce("_text", F.lit("")).alias("_text")) \
        .mapInArrow(_set_rows(n), "_id bigint, family bigint, copies bigint, grams binary")
    placed = block_rows(stored(sets, "sets"), "family", "_id", BLOCK)
    found = dealt(placed.select("family", "left", "right", "block", "_id", "copies", "grams"), ["family", "left", "right"],
                  _family_links(threshold), "a bigint, b bigint, n bigint")
    found = stored(found, "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("found"))
    comp = components(found.where("b is not null"))
    by_class = classes.join(counts, classes.rep == counts.a, "left").join(comp, F.col("rep") == comp.id, "left").select(
        F.col("set_low").alias("_l"), F.col("set_high").alias("_h"), F.coalesce("component", "rep").alias("component"),
        (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("links"))
    mine = [F.when(F.col("_id").isNotNull(), F.col(c)) for c in names]
    out = signed.select("_id", mine[0].alias("set_low"), mine[1].alias("set_high")).join(
        by_class, (F.col("set_low") == F.col("_l")) & (F.col("set_high") == F.col("_h")), "left")
    component = F.coalesce("component", "_id")
    return out.select(
        F.col("_id").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))
