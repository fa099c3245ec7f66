"""Gated recurrent language model in numpy: log-likelihood of complete documents.

Symbols are the most frequent training words, an end, and buckets for all other words by their last letters. A gated
recurrent unit reads the symbols; the output is factored into classes, ``P(class | h) P(symbol | class, h)``, and a
word of a bucket has in addition its smoothed share of the bucket's words, so the model gives every word a probability.

Word counts cover all training documents. The weights are fitted by truncated backpropagation in rounds: trainers
read disjoint shares of a fixed fraction of the training documents, and their weights are averaged. Scoring carries the
state through a document from window to window, however long it is.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import known, shared_dir, stored

#: Words that are symbols; buckets of other words; size of the state; output classes.
WORDS, BUCKETS, STATE, CLASSES = 4096, 64, 24, 65
#: Words whose counts are sent to every task; the counts of all others are joined. Bounds the broadcast.
FREQUENT = 200_000
#: Rounds of training; each reads its share of the training documents, and together they read every one once.
ROUNDS = 2
#: Weights of trainers that one task averages, until as few are left.
AVERAGED = 16
#: Streams read side by side and steps of a window, in training and in scoring.
TRAIN_LANES, TRAIN_STEPS, LANES, STEPS = 192, 20, 512, 32
#: Tokens scored together, and distinct words counted before they are handed on.
CHUNK, HELD = 3_000_000, 400_000


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: exactly what bytes methods do."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def bucket(word: str) -> int:
    return zlib.crc32(word[-2:].encode()) % BUCKETS


def held_out(id_column: str, rest: int = 2, divisor: int = 7):
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % divisor == rest, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n, bucket`` over a column ``_text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(words(t))
                if len(seen) > HELD:
                    yield out()
        yield out()

    counts = texts.select("_text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    tail = F.encode(F.substring("word", -2, 2), "utf-8")
    return counts.withColumn("bucket", (F.crc32(tail) % BUCKETS).cast("int"))


def _floor(counts: DataFrame, most: int) -> int:
    """Least count such that at most ``most`` words have it; counts above 1000 are told apart by eighths of an octave."""
    step = F.when(F.col("n") <= 1000, F.col("n")).otherwise(1000 + F.floor(F.log2(F.col("n")) * 8).cast("long"))
    rows = counts.groupBy(step.alias("s")).agg(F.count("*").alias("words"), F.min("n").alias("low")).orderBy(F.desc("s")).collect()
    total, floor = 0, None
    for r in rows:
        total += r["words"]
        if total > most:
            break
        floor = r["low"]
    return floor if floor is not None else (1 << 62)


class Symbols:
    """Symbol numbers of words, and the classes of the symbols."""

    def __init__(self, frequent: list[tuple[str, int]], bucket_words: np.ndarray, ends: int):
        top = sorted(frequent, key=lambda x: (-x[1], x[0]))[:WORDS]
        self.number = {w.encode(): k for k, (w, _) in enumerate(top)}
        self.size = len(top) + BUCKETS + 1
        self.first_bucket, self.end = len(top), self.size - 1
        inside = np.zeros(BUCKETS)
        for w, n in top:
            inside[bucket(w)] += n
        self.mass = np.concatenate([[n for _, n in top], np.maximum(bucket_words - inside, 0), [ends]]) + 1.0
        # classes of about equal shares of the square root of frequency, by frequency
        order = np.argsort(-self.mass, kind="stable")
        share = np.cumsum(np.sqrt(self.mass[order]))
        self.cls = np.empty(self.size, np.int64)
        self.cls[order] = np.minimum((share / share[-1] * CLASSES).astype(np.int64), CLASSES - 1)
        _, self.cls = np.unique(self.cls, return_inverse=True)
        self.members = [np.flatnonzero(self.cls == c) for c in range(self.cls.max() + 1)]
        # symbols by class: the members of class k are ``by_class[bounds[k]: bounds[k + 1]]``
        self.by_class = np.concatenate(self.members)
        self.bounds = np.concatenate([[0], np.cumsum([len(m) for m in self.members])])
        self.place = np.empty(self.size, np.int64)
        for m in self.members:
            self.place[m] = np.arange(len(m))


def new_weights(s: Symbols, seed: int = 4) -> dict[str, np.ndarray]:
    """Small random weights; output biases make the model start as the unigram model."""
    rng = np.random.default_rng(seed)
    h = STATE
    w = {
        "x": rng.normal(0, 0.1, (s.size + 1, 3 * h)), "u": rng.normal(0, 1 / math.sqrt(h), (h, 3 * h)), "b": np.zeros(3 * h),
        "c": rng.normal(0, 0.1, (len(s.members), h)), "o": rng.normal(0, 0.1, (s.size, h)),
    }
    w["b"][:h] = 1.0  # gates start by keeping the state
    by_class = np.array([s.mass[m].sum() for m in s.members])
    w["cb"] = np.log(by_class / by_class.sum())
    w["ob"] = np.log(s.mass / by_class[s.cls])
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(w: dict, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the unit for symbols ``x``: new state, and what backpropagation needs."""
    return _unit(w["x"][x] + w["b"], w["u"], state)


def _unit(a: np.ndarray, u: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """A step from the input part ``a`` of the symbols read, taken for all steps of a window at once."""
    h = STATE
    r = state @ u
    gates = _sigmoid(a[:, : 2 * h] + r[:, : 2 * h])
    z, reset = gates[:, :h], gates[:, h:]
    cand = np.tanh(a[:, 2 * h:] + reset * r[:, 2 * h:])
    return z * state + (1 - z) * cand, z, reset, cand, r[:, 2 * h:]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _log_picked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of one column of each row; overwrites ``x``."""
    x -= x.max(1, keepdims=True)
    picked = x[np.arange(len(at)), at]
    np.exp(x, out=x)
    return picked - np.log(x.sum(1))


def log_probabilities(w: dict, s: Symbols, states: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log probability of symbol ``y`` after each state."""
    c = s.cls[y]
    out = _log_picked(states @ w["c"].T + w["cb"], c).astype(np.float64)
    order = np.argsort(c, kind="stable")
    bounds = np.searchsorted(c[order], np.arange(len(s.members) + 1))
    for k, m in enumerate(s.members):
        rows = order[bounds[k]: bounds[k + 1]]
        if len(rows) and len(m) > 1:
            out[rows] += _log_picked(states[rows] @ w["o"][m].T + w["ob"][m], s.place[y[rows]])
    return out


def _softmax_loss(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the summed negative log softmax of one column of each row, and that sum; overwrites ``x``."""
    picked = np.arange(len(at))
    x -= x.max(1, keepdims=True)
    chosen = x[picked, at]
    np.exp(x, out=x)
    total = x.sum(1)
    x /= total[:, None]
    x[picked, at] -= 1
    return x, float((np.log(total) - chosen).sum())


def window_gradients(w: dict, s: Symbols, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, state: np.ndarray, live: np.ndarray):
    """Gradients of the summed negative log-likelihood of a window, its loss and its last state.

    ``x``, ``y``, ``fresh`` and ``live`` are steps by lanes: the symbol read, the one to predict, whether a document
    begins, and whether the lane has one. The state enters as a constant: backpropagation ends at the window. The
    gradient of ``x`` comes as the symbols read and their rows; all other rows are zero.
    """
    h, (steps, lanes) = STATE, x.shape
    kept, hs = [], np.empty((steps, lanes, h), np.float32)
    befores = np.empty((steps, lanes, h), np.float32)
    a, u = w["x"][x] + w["b"], w["u"]
    for t in range(steps):
        befores[t] = np.where(fresh[t][:, None], 0, state)
        state, z, r, c, rc = _unit(a[t], u, befores[t])
        kept.append((z, r, c, rc))
        hs[t] = state
    g = {k: np.zeros_like(v) for k, v in w.items() if k not in ("x", "o", "ob")}
    rows = np.flatnonzero(live.ravel())
    flat, want = hs.reshape(-1, h)[rows], y.ravel()[rows]
    cls = s.cls[want]
    d, loss = _softmax_loss(flat @ w["c"].T + w["cb"], cls)
    g["c"], g["cb"] = d.T @ flat, d.sum(0)
    dflat = d @ w["c"]
    # the output weights of each class are one range of these, and so are their gradients
    o, ob = w["o"][s.by_class], w["ob"][s.by_class]
    go, gob = np.zeros_like(o), np.zeros_like(ob)
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(len(s.members) + 1))
    for k in range(len(s.members)):
        part, lo, hi = order[bounds[k]: bounds[k + 1]], s.bounds[k], s.bounds[k + 1]
        if not len(part) or hi - lo == 1:
            continue
        mine = flat[part]
        d, more = _softmax_loss(mine @ o[lo:hi].T + ob[lo:hi], s.place[want[part]])
        loss += more
        go[lo:hi], gob[lo:hi] = d.T @ mine, d.sum(0)
        dflat[part] += d @ o[lo:hi]
    g["o"], g["ob"] = np.empty_like(o), np.empty_like(ob)
    g["o"][s.by_class], g["ob"][s.by_class] = go, gob
    dh_out = np.zeros((steps * lanes, h), np.float32)
    dh_out[rows] = dflat
    dh_out = dh_out.reshape(steps, lanes, h)
    dh = np.zeros((lanes, h), np.float32)
    dx = np.empty((steps, lanes, 3 * h), np.float32)
    du = np.empty((steps, lanes, 3 * h), u.dtype)
    ut = np.ascontiguousarray(u.T)
    for t in range(steps - 1, -1, -1):
        z, r, c, rc = kept[t]
        dh = dh + dh_out[t]
        da_c = dh * (1 - z) * (1 - c * c)
        dx[t, :, :h] = du[t, :, :h] = dh * (befores[t] - c) * z * (1 - z)
        dx[t, :, h: 2 * h] = du[t, :, h: 2 * h] = da_c * rc * r * (1 - r)
        dx[t, :, 2 * h:] = da_c
        du[t, :, 2 * h:] = da_c * r
        dh = np.where(fresh[t][:, None], 0, dh * z + du[t] @ ut).astype(np.float32)
    g["u"] = befores.reshape(-1, h).T @ du.reshape(-1, 3 * h)
    g["b"] = dx.sum((0, 1))
    order = np.argsort(x.ravel(), kind="stable")
    seen, first = np.unique(x.ravel()[order], return_index=True)
    g["x"] = (seen, np.add.reduceat(dx.reshape(-1, 3 * h)[order], first))
    return g, float(loss), state


class Trainer:
    """Lanes of documents read side by side, with steps scaled by the sum of squared gradients."""

    def __init__(self, w: dict, s: Symbols, rate: float = 0.2):
        self.w, self.s, self.rate = {k: v.copy() for k, v in w.items()}, s, rate
        self.squares = {k: np.full_like(v, 0.01) for k, v in w.items()}
        self.waiting: list[np.ndarray] = []
        self.now: list[np.ndarray] = [np.zeros(0, np.int32)] * TRAIN_LANES
        self.at = [0] * TRAIN_LANES
        self.state = np.zeros((TRAIN_LANES, STATE), np.float32)
        self.tokens = 0

    def feed(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        while len(self.waiting) > TRAIN_LANES:
            self.window()

    def window(self) -> bool:
        shape = (TRAIN_STEPS, TRAIN_LANES)
        x, y = np.full(shape, self.s.size, np.int64), np.zeros(shape, np.int64)
        fresh, live = np.zeros(shape, bool), np.zeros(shape, bool)
        for k in range(TRAIN_LANES):
            t = 0
            while t < TRAIN_STEPS:
                if self.at[k] >= len(self.now[k]):
                    if not self.waiting:
                        break
                    self.now[k], self.at[k] = self.waiting.pop(), 0
                doc, at = self.now[k], self.at[k]
                n = min(TRAIN_STEPS - t, len(doc) - at)
                y[t: t + n, k] = doc[at: at + n]
                if at == 0:
                    fresh[t, k] = True
                    x[t + 1: t + n, k] = doc[: n - 1]
                else:
                    x[t: t + n, k] = doc[at - 1: at + n - 1]
                live[t: t + n, k] = True
                t, self.at[k] = t + n, at + n
        count = int(live.sum())
        if not count:
            return False
        # a lane without a document in this window adds nothing, and its next document starts afresh
        busy = live.any(0)
        if busy.all():
            g, _, self.state = window_gradients(self.w, self.s, x, y, fresh, self.state, live)
        else:
            g, _, self.state[busy] = window_gradients(self.w, self.s, x[:, busy], y[:, busy], fresh[:, busy], self.state[busy], live[:, busy])
        self.tokens += count
        seen, rows = g.pop("x")
        d = np.clip(rows / TRAIN_LANES, -1, 1)
        self.squares["x"][seen] += d * d
        self.w["x"][seen] -= self.rate * d / np.sqrt(self.squares["x"][seen])
        for k in g:
            v, d = self.w[k], np.clip(g[k] / TRAIN_LANES, -1, 1)
            self.squares[k] += d * d
            v -= self.rate * d / np.sqrt(self.squares[k])
        return True

    def finish(self) -> None:
        while self.window():
            pass


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first to the emptiest lane."""
    import heapq
    heap = [(0, k) for k in range(min(lanes, max(1, len(lengths))))]
    out: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable"):
        load, k = heap[0]
        out[k].append(int(i))
        heapq.heapreplace(heap, (load + int(lengths[i]), k))
    return out


def score_documents(w: dict, s: Symbols, docs: list[np.ndarray], lanes: int = LANES, steps: int = STEPS) -> np.ndarray:
    """Natural log-likelihood of each document's symbols, ends included; the state runs through whole documents."""
    lengths = np.array([len(d) for d in docs], np.int64)
    dealt = lanes_of(lengths, lanes)
    dealt.sort(key=lambda own: -sum(lengths[i] for i in own))
    loads = np.array([int(lengths[own].sum()) for own in dealt])
    longest = int(loads.max(initial=0))
    y = [np.concatenate([docs[i] for i in own]) if own else np.zeros(0, np.int32) for own in dealt]
    owner = [np.repeat(own, lengths[own]) for own in dealt]
    first = [np.concatenate([[0], np.cumsum(lengths[own])[:-1]]).astype(np.int64) for own in dealt]
    total = np.zeros(len(docs))
    state = np.zeros((len(dealt), STATE), np.float32)
    for start in range(0, longest, steps):
        active = int((loads > start).sum())  # lanes are sorted by their load
        n = min(steps, longest - start)
        x, want = np.full((n, active), s.size, np.int64), np.full((n, active), -1, np.int64)
        who, fresh = np.zeros((n, active), np.int64), np.zeros((n, active), bool)
        for k in range(active):
            part = y[k][start: start + n]
            m = len(part)
            want[:m, k], who[:m, k] = part, owner[k][start: start + m]
            lo, hi = np.searchsorted(first[k], [start, start + m])
            fresh[first[k][lo:hi] - start, k] = True
            if start:
                x[:m, k] = y[k][start - 1: start + m - 1]
            else:
                x[1:m, k] = part[: m - 1]
        x[fresh] = s.size  # a document begins with the start symbol
        now, hs = state[:active], np.empty((n, active, STATE), np.float32)
        for t in range(n):
            now = _step(w, x[t], np.where(fresh[t][:, None], np.float32(0), now))[0]
            hs[t] = now
        state[:active] = now
        live = want.ravel() >= 0
        logs = log_probabilities(w, s, hs.reshape(-1, STATE)[live], want.ravel()[live])
        total += np.bincount(who.ravel()[live], logs, minlength=len(docs))
    return total


class Reader(dict):
    """Symbols of words; remembers the buckets of other words within a bound."""

    def __init__(self, s: Symbols):
        super().__init__(s.number)
        self.s = s

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
            self.update(self.s.number)
        i = self[word] = self.s.first_bucket + bucket(word.decode("utf-8", "surrogatepass"))
        return i

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
        return np.append(out, np.int32(self.s.end))


def _packed(w: dict) -> bytes:
    return b"".join(w[k].astype(np.float32).tobytes() for k in sorted(w))


def _unpacked(raw: bytes, like: dict) -> dict:
    flat, out, at = np.frombuffer(raw, np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at: at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _averaged(found: DataFrame) -> DataFrame:
    """``w, n`` of trainers as means weighted by their tokens, ``AVERAGED`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = 0, None
        for batch in batches:
            for raw, n in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw.as_buffer(), np.float32) * np.float64(n)
                mean, total = own if mean is None else mean + own, total + n
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([(mean / total).astype(np.float32).tobytes()], pa.binary()), pa.array([total], pa.int64())], ["w", "n"])

    left = found.count()
    while left > AVERAGED:
        groups = -(-left // AVERAGED)
        found = stored(found.repartition(groups).mapInArrow(run, "w binary, n bigint"), "averaged")
        left = found.count()
    return found.coalesce(1).mapInArrow(run, "w binary, n bigint")


def train(docs: DataFrame, s: Symbols, rounds: int = ROUNDS, tokens: list[int] | None = None) -> dict:
    """Weights after every training document was read once, in ``rounds`` shares by the hash of id and text.

    A round's trainers are the tasks that read the documents, so they grow with the input; each starts from the weights
    before, and their mean, weighted by tokens, are the next ones. Means of many trainers are taken by tasks, the driver
    sees one. ``tokens`` takes the number of tokens of each round.
    """
    sc = docs.sparkSession.sparkContext
    w = new_weights(s)
    for r in range(rounds):
        sent = sc.broadcast((s, w))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            symbols, start = sent.value
            trainer, reader = Trainer(start, symbols), Reader(symbols)
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    trainer.feed(reader.ids(words(t)))
            trainer.finish()
            if trainer.tokens:
                yield pa.RecordBatch.from_arrays([pa.array([_packed(trainer.w)], pa.binary()), pa.array([trainer.tokens], pa.int64())], ["w", "n"])

        part = docs.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(rounds)) == r).select("_text")
        mean = _averaged(stored(part.mapInArrow(run, "w binary, n bigint"), "trained")).first()
        if mean is not None:
            w = _unpacked(bytes(mean["w"]), w)
        if tokens is not None:
            tokens.append(mean["n"] if mean is not None else 0)
        sent.unpersist()
    return w


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row, scores as log10.

    Null and empty texts are one token, the end. Null ids are neither held out nor learned from. Repeated rows are
    learned from and scored each. Without training documents all words are unknown and both scores follow from the
    smoothing alone. An empty table gives no rows. Extra columns are ignored.
    """
    shared_dir(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_column}`").alias("_id"), known(F.col(f"`{text}`")).alias("_text"), held_out(f"`{id_column}`").alias("_held"))
    training = plain.where(F.col("_id").isNotNull() & ~F.col("_held"))
    counts = stored(word_counts(training), "counts")
    ends = training.count()
    per_bucket = {r["bucket"]: r for r in counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    tokens = sum(r["n"] for r in per_bucket.values()) + ends
    kinds = sum(r["v"] for r in per_bucket.values()) + (1 if ends else 0)
    floor = _floor(counts, FREQUENT)
    frequent = [(r["word"], r["n"]) for r in counts.where(F.col("n") >= floor).select("word", "n").collect()]
    bucket_words = np.array([float(per_bucket[b]["n"]) if b in per_bucket else 0.0 for b in range(BUCKETS)])
    s = Symbols(frequent, bucket_words, ends)
    # of a bucket: its words that are no symbols, their number, and one more for all unknown ones
    room = bucket_words + np.array([float(per_bucket[b]["v"]) if b in per_bucket else 0.0 for b in range(BUCKETS)]) + 1
    known_counts = dict(frequent)
    for word in s.number:
        w_ = word.decode("utf-8", "surrogatepass")
        room[bucket(w_)] -= known_counts[w_] + 1
    w = train(training, s)
    sent = docs.sparkSession.sparkContext.broadcast((s, w, {k.encode(): v for k, v in frequent}, np.log10(room)))
    base_room, log_end = math.log10(tokens + kinds + 1), math.log10(ends + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, weights, count, log_room = sent.value
        reader, row = Reader(symbols), TaskContext.get().partitionId() << 40
        # log10 of the count and one, and the part of it that a bucket's share takes
        logs = {t: (math.log10(n + 1), 0.0 if t in symbols.number else math.log10(n + 1)) for t, n in count.items()}
        docs_: list[np.ndarray] = []
        rows: list[list] = []
        rare: list[tuple[int, bytes, int]] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            total = score_documents(weights, symbols, docs_) / math.log(10) if docs_ else []
            names = ["row", "_id", "held", "tokens", "known", "base", "score", "word", "n"]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            scores = [a + float(b) for a, b in zip(cols[6], total, strict=True)]
            empty = pa.nulls(len(rows))
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], kind), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.int64()),
                pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.float64()), pa.array(scores, pa.float64()),
                empty.cast(pa.string()), empty.cast(pa.int64())], names)
            n = len(rare)
            if n:
                none = pa.nulls(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rare], pa.int64()), none.cast(kind), none.cast(pa.bool_()), none.cast(pa.int64()),
                    none.cast(pa.int64()), none.cast(pa.float64()), none.cast(pa.float64()),
                    pa.array([r[1] for r in rare], pa.binary()).cast(pa.string()), pa.array([r[2] for r in rare], pa.int64())], names)
            docs_.clear(), rows.clear(), rare.clear()

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words(t)
                ids = reader.ids(ws)
                base, part, n_known = log_end, 0.0, 1 if ends else 0
                for word, n in Counter(ws).items():
                    found = logs.get(word)
                    if found is None:
                        rare.append((row, word, n))
                    else:
                        base += n * found[0]
                        part += n * found[1]
                        n_known += n
                spread = np.bincount(ids, minlength=symbols.size)[symbols.first_bucket: symbols.end]
                rows.append([row, i, h, len(ids), n_known, base - len(ids) * base_room, part - float(spread @ log_room)])
                docs_.append(ids)
                row, held = row + 1, held + len(ids)
                if held > CHUNK:
                    yield from out()
                    held = 0
        if kind is not None:
            yield from out()

    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"row bigint, _id {id_type}, held boolean, tokens bigint, known bigint, base double, score double, word string, n bigint"
    rows = stored(plain.select("_id", "_text", "_held").mapInArrow(run, schema), "scored")
    other = counts.where(F.col("n") < floor).select(F.col("word").alias("_word"), F.col("n").alias("c"))
    rare = rows.where("word is not null").select("row", "word", "n").join(other, F.col("word") == F.col("_word"))
    rare = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"), F.sum("n").alias("seen"))
    done = rows.where("word is null").join(rare.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return done.select(
        F.col("_id").alias(id_column), F.col("held").alias("held_out"), F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
