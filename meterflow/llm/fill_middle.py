"""Fill-in-the-middle transformation: texts cut at unit boundaries that a Fenwick tree over blocks finds.

A text's UTF-8 bytes are blocks of fixed size. Two Fenwick trees over the blocks hold how many units and how many code
points begin in each: binary-lifting descent in the first finds the block where unit k begins, the boundary is then
looked up among that block's bytes alone, and the prefix sum of the second gives its position in code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import shared_dir

#: Bytes of a block.
BLOCK = 1024
MARKERS = ("<P>", "<S>", "<M>")

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def code_points(data: np.ndarray) -> np.ndarray:
    """Where code points begin: at every byte that continues none."""
    return (data & 0xC0) != 0x80


def words(data: np.ndarray) -> np.ndarray:
    """Where words begin; a word takes the white space after it, and the first one what stands before it."""
    begin = ~_SPACE[data]
    begin[1:] &= _SPACE[data[:-1]]
    if len(begin):
        first = int(begin.argmax())
        begin[first] = False
        begin[0] = True
    return begin


def lines(data: np.ndarray) -> np.ndarray:
    """Where lines begin; a line ends with its line feed."""
    begin = np.zeros(len(data), bool)
    begin[1:] = data[:-1] == 10
    begin[:1] = True
    return begin


UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"code_point": code_points, "word": words, "line": lines}


class Fenwick:
    """Sums over a prefix of blocks, and the block in which a sum is passed, both in as many steps as the size has bits."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        sums = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(1, n + 1)
        # entry i covers the blocks after i less its lowest bit
        self.tree = np.concatenate([[0], sums[at] - sums[at - (at & -at)]]).tolist()
        self.top = 1 << n.bit_length() >> 1 if n else 0

    def before(self, block: int) -> int:
        """Sum of the blocks before this one."""
        total = 0
        while block:
            total += self.tree[block]
            block &= block - 1
        return total

    def descend(self, k: int) -> tuple[int, int]:
        """The block with the k-th unit (from 0), and the units that are left within it."""
        block, step = 0, self.top
        while step:
            if block + step < len(self.tree) and self.tree[block + step] <= k:
                block += step
                k -= self.tree[block]
            step >>= 1
        return block, k


class Cuts:
    """Unit boundaries of one text as byte offsets and code points."""

    def __init__(self, data: bytes, unit: str = "code_point", block: int = BLOCK):
        raw = np.frombuffer(data, np.uint8)
        self.size, self.block = len(raw), block
        self.units, self.points = UNITS[unit](raw), code_points(raw)
        starts = np.arange(0, len(raw), block)
        self.by_unit, self.by_point = (
            Fenwick(np.add.reduceat(m, starts, dtype=np.int64) if len(raw) else np.zeros(0, np.int64)) for m in (self.units, self.points))
        self.n_units, self.n_points = (t.before(len(starts)) for t in (self.by_unit, self.by_point))

    def after(self, k: int) -> tuple[int, int]:
        """Byte offset and code points of the boundary after k units, that is where unit k begins."""
        if k >= self.n_units:
            return self.size, self.n_points
        block, rest = self.by_unit.descend(k)
        start = block * self.block
        byte = start + int(np.flatnonzero(self.units[start:start + self.block])[rest])
        return byte, self.by_point.before(block) + int(np.count_nonzero(self.points[start:byte]))


def checked_markers(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """Markers that stay unique where they are joined to texts without them: no start of one is an end of another."""
    for i, a in enumerate(markers):
        for j, b in enumerate(markers):
            if not a or any(a.endswith(b[:k]) for k in range(1, len(b) + (i != j))):
                raise ValueError(f"the markers {a} and {b} overlap")
    return markers


def transform(
    text: str, seed: int, doc_id: int | None, unit: str = "code_point", fim_rate: int = 90, spm_rate: int = 20,
    markers: tuple[str, str, str] = MARKERS, block: int = BLOCK,
) -> dict:
    """Form, cuts and output of one text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    data = text.encode()
    cuts = Cuts(data, unit, block)
    n = cuts.n_units
    if not text or h3 % 100 >= fim_rate or any(m in text for m in markers):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, prefix), (b, upto) = cuts.after(low), cuts.after(high)
    p, s, m = (x.encode() for x in markers)
    head, middle, tail = data[:a], data[a:b], data[b:]
    spm = h4 % 100 < spm_rate
    out = s + tail + p + head + m + middle if spm else p + head + s + tail + m + middle
    return {"n": n, "form": "spm" if spm else "psm", "prefix_chars": prefix, "middle_chars": upto - prefix, "output": out.decode()}


def restore(output: str, form: str, markers: tuple[str, str, str] = MARKERS) -> str:
    """The text from its output and form alone."""
    if form == "plain":
        return output
    p, s, m = markers
    first, second = (p, s) if form == "psm" else (s, p)
    if not output.startswith(first):
        raise ValueError(f"no {first} at the start")
    one, found, rest = output[len(first):].partition(second)
    two, last, middle = rest.partition(m)
    if not found or not last:
        raise ValueError("a marker is missing")
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def fill_middle(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 1, unit: str = "code_point", fim_rate: int = 90,
    spm_rate: int = 20, markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of every row; nothing is shuffled.

    Two cuts are drawn from the SHA-256 of seed and id among the ``n`` units of the text (``code_point``, ``word`` or
    ``line``). ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle, each after its marker; a text that is empty,
    holds a marker or is not drawn (``fim_rate`` of 100) stays plain, with null cuts. A null text is empty, a null id draws
    as an empty one, rows that repeat an id draw alike. Whole texts of any length are read, one at a time.
    """
    checked_markers(markers)
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit}")
    shared_dir(docs.sparkSession)
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                transform(t, seed, i, unit, fim_rate, spm_rate, markers)
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array([r[c] for r in rows], kind) for c, kind in (
                    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()))),
            ], ["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    found = source.mapInArrow(run, "_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return found.withColumnRenamed("_id", id_column)


def restored(
    outputs: DataFrame, output: str = "output", form: str = "form", name: str = "restored", markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """Adds the text rebuilt from output and form, in DataFrame functions; null where either is null."""
    checked_markers(markers)
    p, s, m = (F.lit(x) for x in markers)
    column, kind = F.col(f"`{output}`"), F.col(f"`{form}`")

    def parts(first, second, size):
        at = F.locate(second, column)
        last = F.locate(markers[2], column, 1)
        one = F.substring(column, F.lit(size + 1), at - F.lit(size + 1))
        two = F.substring(column, at + F.length(F.lit(second)), last - at - F.length(F.lit(second)))
        return one, two, F.substring(column, last + F.length(m), F.length(column))

    one, two, middle = parts(p, markers[1], len(markers[0]))
    psm = F.concat(one, middle, two)
    one, two, middle = parts(s, markers[0], len(markers[1]))
    spm = F.concat(two, middle, one)
    broken = F.raise_error(F.concat(F.lit("unknown form "), kind)).cast("string")
    return outputs.withColumn(name, F.when(kind == "plain", column).when(kind == "psm", psm).when(kind == "spm", spm).when(
        kind.isNull(), F.lit(None)).otherwise(broken))
