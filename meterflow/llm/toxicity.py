"""Toxicity by noisy-channel deobfuscation: restore disguised words, then score the restored text.

The channel turns letters into look-alikes (``1`` for i or l), repeats them and sets marks or spaces between them.
The lattice of a disguised word holds, for every character, the letters it may stand for, and for repeated or
separating characters that they are noise. Viterbi decoding picks the path that a character language model, counted
over all documents, and the channel's costs make likeliest. Words without disguise have a single path and pass through.

The score is a logistic model over the words and word beginnings of the restored text, fitted on a bounded sample of
labelled rows. A feature of many toxic texts and no clean one is enough by itself, so one insult is.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import known, shared_dir, sized, stored

#: Labelled rows the classifier is fitted on, for each label: the bound of the sample.
SAMPLE = 6_000
#: Features kept, hash buckets they are chosen from, and least toxic documents a feature is in.
FEATURES, BUCKETS, SUPPORT = 3_000, 1 << 20, 3
#: How many times as common in toxic texts, and in no clean text of the sample, a feature is that is enough by itself.
ENOUGH = 500
#: Lengths of word beginnings that are features, besides the whole word.
BEGINNINGS = (3, 4, 5, 6, 7)

# fixed values: what a character may stand for
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "*": "aeiou",
}
SEPARATORS = ".-_*~'·"
#: Costs of the channel, as natural logarithms of probabilities.
SUBSTITUTED, DROPPED, REPEATED, DOUBLED = -1.5, -1.0, -0.7, -3.0

#: Character classes of the language model: 0 the word's edge, 1-26 letters, 27 any other character.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES = 28
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_RUN = re.compile(r"(.)\1\1")
_EDGES = " .,;:!?\"'()[]{}<>#%&$*/\\|=+-_~`^"
_LEFT = _EDGES.replace("$", "").replace("!", "")


def _class_of(c: str) -> int:
    bare = unicodedata.normalize("NFD", c.lower())[0]
    return LETTERS.find(bare) + 1 if bare in LETTERS else (0 if c.isspace() or not (c.isalnum()) else 27)


_TABLE = np.array([_class_of(chr(i)) for i in range(0x250)] + [27], np.uint8)


class CharModel:
    """Interpolated log probabilities of a character class after the three before it."""

    def __init__(self, counts: np.ndarray):
        c4 = counts.reshape((CLASSES,) * 4).astype(np.float64)
        total = None
        for c, weight in ((c4.sum((0, 1, 2)), 1.0), (c4.sum((0, 1)), 20.0), (c4.sum(0), 20.0), (c4, 20.0)):
            if total is None:
                total = (c + 1) / (c.sum() + CLASSES)
            else:
                total = (c + weight * total) / (c.sum(-1, keepdims=True) + weight)
        self.log = np.log(total).astype(np.float32)
        self.table = self.log.tolist()


def char_counts(docs: DataFrame) -> np.ndarray:
    """Counts of four consecutive character classes over all texts, edges of words being a class."""
    n = CLASSES ** 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)

        def add(texts: list[str]) -> None:
            raw = np.frombuffer("\n\n\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
            c = _TABLE[np.minimum(raw, 0x250)].astype(np.int32)
            if len(c) > 3:
                total[:] += np.bincount(((c[:-3] * CLASSES + c[1:-2]) * CLASSES + c[2:-1]) * CLASSES + c[3:], minlength=n)

        for batch in batches:
            held, size = [], 0
            for t in batch.column(0).to_pylist():
                held.append(t)
                size += len(t)
                if size > 500_000:
                    add(held)
                    held, size = [], 0
            add(held)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 50_000):
            part = at[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["gram", "n"])

    grams = docs.select(known("_text")).mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    # at most CLASSES ** 4 rows whatever the input
    out = np.zeros(n, np.int64)
    pdf = grams.toPandas()
    out[pdf["gram"].to_numpy(np.int64)] = pdf["n"].to_numpy(np.int64)
    return out


def decode(token: str, model: CharModel) -> str:
    """The likeliest word behind a disguised one.

    States are the last three classes with the letters so far; each character extends them by a letter it may stand
    for, or leaves them as they are where it repeats the letter before or separates letters.
    """
    table = model.table
    # words are linked from their last letter back, so a long token costs no more for each character
    beams: dict[tuple[int, int, int], tuple[float, tuple]] = {(0, 0, 0): (0.0, ())}
    previous = ""
    runs = {i for m in re.finditer(r"(.)\1\1+", token) for i in range(*m.span())}
    for at, c in enumerate(token):
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options.append((c, 0.0))
        options += [(x, SUBSTITUTED) for x in LOOKALIKES.get(c, "")]
        if not options and c not in SEPARATORS:
            options.append((c, 0.0))
        nxt: dict[tuple[int, int, int], tuple[float, tuple]] = {}
        for (a, b, d), (p, word) in beams.items():
            for letter, cost in options:
                k = _TABLE[min(ord(letter), 0x250)] if letter else 0
                q = p + cost + table[a][b][d][k]
                key = (b, d, int(k))
                if key not in nxt or q > nxt[key][0]:
                    nxt[key] = (q, (word, letter))
            drop = (REPEATED if at in runs else DOUBLED) if c == previous else DROPPED if c in SEPARATORS else None
            if drop is not None and word:
                q = p + drop
                if (a, b, d) not in nxt or q > nxt[a, b, d][0]:
                    nxt[a, b, d] = (q, word)
        beams = nxt or beams
        previous = c
    best = max(((p + table[a][b][d][0], word) for (a, b, d), (p, word) in beams.items()), key=lambda x: x[0])
    letters, word = [], best[1]
    while word:
        word, letter = word
        letters.append(letter)
    return "".join(reversed(letters))


def disguised(token: str) -> bool:
    """Whether a bare lower-case token has letters next to look-alikes, inner separators or a letter thrice."""
    if token.isalpha():
        return _RUN.search(token) is not None
    return any(c.isalpha() for c in token)


def restore(token: str, model: CharModel) -> str:
    """A white-space token as the scorer sees it: lower case, bare of marks at its ends, decoded if disguised."""
    bare = token.lower().rstrip(_EDGES).lstrip(_LEFT)
    return decode(bare, model) if disguised(bare) else bare.strip(_EDGES)


def restored_text(text: str | None, model: CharModel) -> str:
    """The whole text with spaced-out words joined and every word restored."""
    text = _SPACED.sub(lambda m: re.sub(r"\s", "", m.group()), text or "")
    return " ".join(w for w in (restore(t, model) for t in text.split()) if w)


def features(word: str) -> set[int]:
    """Hash buckets of a word and its beginnings; odd ones for words and beginnings of five letters and more."""
    if len(word) < 2:
        return set()
    mask = BUCKETS - 1
    raw = {zlib.crc32(b"=" + word.encode()) & mask | 1}
    raw.update((zlib.crc32(word[:k].encode()) & mask & ~1) | (k >= 5) for k in BEGINNINGS if len(word) >= k)
    return raw


class Reader:
    """Chosen features of a text; remembers words, within a bound, for the texts to come."""

    def __init__(self, model: CharModel, chosen: dict[int, int] | None = None, bound: int = 100_000):
        self.model, self.chosen, self.bound = model, chosen, bound
        self.seen: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> set[int]:
        tokens = set(text.split())
        for m in _SPACED.finditer(text):
            tokens.add(re.sub(r"\s", "", m.group()))
        out: set[int] = set()
        seen = self.seen
        for t in tokens:
            f = seen.get(t)
            if f is None:
                raw = features(restore(t, self.model))
                f = tuple(raw) if self.chosen is None else tuple(self.chosen[x] for x in raw if x in self.chosen)
                if len(seen) >= self.bound:
                    seen.clear()
                seen[t] = f
            if f:
                out.update(f)
        return out


def is_training(id_column: str, rest: int = 1, divisor: int = 3) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % divisor != rest


def training_sample(labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    """``_id, _label`` of at most ``per_label`` training rows of each label, the first by a hash of the id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_label"))
    rows = rows.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & is_training("_id")).distinct()
    parts = [rows.where(F.col("_label") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_label) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> dict:
    """Character model, chosen features and weights.

    ``docs`` are ``_id, _text``; the sample's texts are read in tasks, which return feature counts, then the chosen
    features of each sampled document. What reaches the driver is bounded by ``BUCKETS`` and ``SAMPLE``.
    """
    counts = char_counts(docs)
    sc = docs.sparkSession.sparkContext
    shared_counts = sc.broadcast(counts.astype(np.int64))
    sample = stored(training_sample(labels, per_label), "sample")
    texts = stored(docs.join(sized(sample), "_id").select("_label", known("_text").alias("_text")), "sample-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharModel(shared_counts.value))
        toxic, clean = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = reader.of(t)
                (toxic if y else clean)[np.fromiter(f, np.int64, len(f))] += 1
        at = np.flatnonzero(toxic + clean)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(toxic[at]), pa.array(clean[at])], ["f", "t", "c"])

    sums = texts.mapInArrow(count, "f int, t int, c int").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    sizes = {r["_label"]: r["n"] for r in texts.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    nt, nc = sizes.get(1, 0), sizes.get(0, 0)
    if not nt or not nc:
        # without both labels every text scores alike
        return {"counts": counts, "chosen": {}, "weights": np.zeros(0), "alone": np.zeros(0), "bias": 0.0 if nt == nc else math.copysign(2.0, nt - nc)}
    # log-likelihood ratio of presence by label, for features commoner in toxic texts
    pt, pc = (F.col("t") + 0.5) / (nt + 1.0), (F.col("c") + 0.5) / (nc + 1.0)
    pool = (F.col("t") + F.col("c") + 1.0) / (nt + nc + 2.0)
    gain = nt * (pt * F.log(pt / pool) + (1 - pt) * F.log((1 - pt) / (1 - pool))) + \
        nc * (pc * F.log(pc / pool) + (1 - pc) * F.log((1 - pc) / (1 - pool)))
    best = sums.where((F.col("t") >= SUPPORT) & (pt > 2 * pc)).orderBy(gain.desc(), "f").limit(FEATURES).collect()
    chosen = {r["f"]: k for k, r in enumerate(best)}
    shared_chosen = sc.broadcast(chosen)
    t, c = (np.array([r[k] for r in best], float) for k in ("t", "c"))
    # log odds of a longer feature that is enough by itself, three standard errors below its estimate
    ratio = np.log((t + 0.5) / (nt + 1)) - np.log((c + 0.5) / (nc + 1))
    alone = np.where((c == 0) & (np.array([r["f"] for r in best], np.int64) % 2 == 1) & (ratio >= math.log(ENOUGH)), ratio - 3 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)), -np.inf)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharModel(shared_counts.value), shared_chosen.value)
        for batch in batches:
            found = [sorted(reader.of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["y", "f"])

    rows = texts.mapInArrow(read, "y int, f array<int>").groupBy("y", "f").agg(F.count("*").alias("n")).orderBy("y", "f").collect()
    weights, bias = logistic([r["f"] for r in rows], np.array([r["y"] for r in rows]), np.array([r["n"] for r in rows], float), len(chosen))
    return {"counts": counts, "chosen": chosen, "weights": weights, "alone": alone, "bias": bias}


def logistic(rows: list[list[int]], y: np.ndarray, n: np.ndarray, size: int, penalty: float = 0.1, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps with momentum; labels weigh alike, weights are kept small."""
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.array([f for r in rows for f in r], np.int64)
    share = np.where(y == 1, n / max(1.0, n[y == 1].sum()), n / max(1.0, n[y == 0].sum())) / 2
    total = n.sum()
    w, b = np.zeros(size), 0.0
    vw, vb = np.zeros(size), 0.0
    # steps by feature: a bound of the curvature from how much of the sample holds it
    width = np.bincount(which, minlength=len(rows)).max(initial=1) if len(at) else 1
    rate = 1.0 / (0.25 * np.sqrt(width) + penalty / total)
    for _ in range(steps):
        z = b + np.bincount(which, w[at], minlength=len(rows))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = share * (p - y)
        gw = np.bincount(at, g[which], minlength=size) + penalty * w / total
        vw, vb = 0.9 * vw - rate * gw, 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return w, float(b)


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", per_label: int = SAMPLE) -> DataFrame:
    """``id, held_out, score`` of each row: the probability that its restored text is toxic.

    ``labels`` has ``doc_id, toxic``; rows whose crc32(id as text) mod 3 is 1 are held out from learning. Null and empty
    texts score as a text without any feature. Null ids are neither held out nor learned from. Labels other than 0 and
    1, null labels and ids without a document teach nothing; without both labels all texts score alike, 0.5 where
    there are no labels. An empty table gives no rows. Whole texts are read.
    """
    scored = with_score(docs.select(F.col(f"`{id_column}`"), F.col(f"`{text}`")), labels, id_column, text, "_score", per_label)
    held = F.coalesce(~is_training(f"`{id_column}`"), F.lit(False))
    return scored.select(F.col(f"`{id_column}`"), held.alias("held_out"), F.col("_score").alias("score"))


def with_score(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", name: str = "score", per_label: int = SAMPLE
) -> DataFrame:
    """Every row and column of ``docs`` with its score in ``name``, which must not exist."""
    if name in docs.columns:
        raise ValueError(f"the column {name} is added and must not exist")
    shared_dir(docs.sparkSession)
    model = fit(docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text")), labels, per_label)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        reader = Reader(CharModel(m["counts"]), m["chosen"])
        for batch in batches:
            out = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                found = sorted(reader.of(t))
                z = m["bias"] + sum(m["weights"][k] for k in found)
                z = max([z, *(m["alone"][k] for k in found)])
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], name])

    kept = [F.col(f"`{c}`") for c in docs.columns]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.select(*kept, known(f"`{text}`").alias("_scored_text")).mapInArrow(run, f"{fields}, `{name}` double")
