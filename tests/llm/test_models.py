"""The recurrent model and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from meterflow.llm import decontaminate, ngram_join, pii, toxicity
from meterflow.llm import recurrent_lm as lm
from meterflow.llm.shared import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lm, "STATE", 6)
    monkeypatch.setattr(lm, "CLASSES", 4)
    monkeypatch.setattr(lm, "BUCKETS", 3)
    words = [(f"w{k}", 50 - k) for k in range(20)]
    inside = np.zeros(3)
    for w, n in words:
        inside[lm.bucket(w)] += n
    s = lm.Symbols(words, inside + 10, 30)
    w = {k: v.astype(np.float64) for k, v in lm.new_weights(s).items()}
    rng = np.random.default_rng(0)
    for v in w.values():
        v += rng.normal(0, 0.2, v.shape)
    return s, w


def test_probabilities_sum_to_one(small):
    s, w = small
    states = np.random.default_rng(1).normal(size=(5, 6))
    total = sum(np.exp(lm.log_probabilities(w, s, states, np.full(5, y))) for y in range(s.size))
    assert np.allclose(total, 1)


def test_gradients_by_differences(small):
    s, w = small
    rng = np.random.default_rng(2)
    shape = (5, 3)
    x, y = rng.integers(0, s.size + 1, shape), rng.integers(0, s.size, shape)
    fresh, live = rng.random(shape) < 0.3, rng.random(shape) < 0.9
    state = rng.normal(size=(3, 6))
    g, _, _ = lm.window_gradients(w, s, x, y, fresh, state, live)
    seen, rows = g["x"]
    g["x"] = np.zeros_like(w["x"])
    g["x"][seen] = rows

    def loss():
        h, out = state, 0.0
        for t in range(shape[0]):
            h = lm._step(w, x[t], np.where(fresh[t][:, None], 0, h))[0]
            out -= lm.log_probabilities(w, s, h[live[t]], y[t][live[t]]).sum()
        return out

    for name, v in w.items():
        for at in rng.integers(0, v.size, 12):
            old, step = v.flat[at], 1e-5
            v.flat[at] = old + step
            up = loss()
            v.flat[at] = old - step
            down = loss()
            v.flat[at] = old
            assert abs((up - down) / (2 * step) - g[name].flat[at]) < 1e-3 * max(1, abs(g[name].flat[at])), name


@pytest.mark.parametrize("lanes,steps", [(1, 1), (3, 4), (8, 100)])
def test_state_is_carried_through_documents(small, lanes, steps):
    s, w = small
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, s.size, n).astype(np.int32) for n in (1, 37, 5, 80, 2, 19)]
    got = lm.score_documents(w, s, docs, lanes, steps)
    for d, value in zip(docs, got, strict=True):
        h, want = np.zeros((1, 6)), 0.0
        for before, y in zip([s.size, *d[:-1]], d, strict=True):
            h = lm._step(w, np.array([before]), h)[0]
            want += lm.log_probabilities(w, s, h, np.array([y]))[0]
        assert abs(want - value) < 1e-3
    assert len(lm.score_documents(w, s, [])) == 0


def test_base_score_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 300)
    monkeypatch.setattr(lm, "WORDS", 100)
    monkeypatch.setattr(lm, "HELD", 500)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (902, "\n\x0b"), (903, "ÀB the THE"), (904, "unseen " * 9000), (904, "unseen " * 9000), (None, "null id")]
    counts, ends = Counter(), 0
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update((t or "").encode().lower().split())
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS row")
    got = lm.score(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        w = (texts[r.doc_id] or "").encode().lower().split()
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((ends + 1) / (total + kinds + 1))
        assert abs(base - r.base_score) < 1e-6 * abs(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(w) + 1, sum(x in counts for x in w) + 1)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.score < 0 and math.isfinite(r.score)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score(docs.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    card = "4111 1111 1111 1111"
    more = [
        (9000, " ".join(f"tok{k}" for k in range(60)), "en", "src1", 1), (9001, " ".join(f"tok{k}" for k in range(61)), "en", "src1", 1),
        (9002, "before it " + bench[0].text, "en", "src2", 1), (9003, f"number {card} of a card", "en", None, 1), (9004, None, None, None, None),
        (None, "a row without an id", "en", "src3", 5), (9005, "this row is here twice", "en", "src3", 5), (9005, "this row is here twice", "en", "src3", 5),
    ]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs, docs.columns
        docs = stored(stage(spark, before, SF), "test-stage")
        ids = Counter(r.doc_id for r in docs.collect())
        if name != "mixing":
            assert docs.columns == columns
        if name == "toxicity":
            scored = toxicity.with_score(before, spark.read.parquet(f"{SF}/labels.parquet"), name="_s")
            assert ids == Counter(r.doc_id for r in scored.where("_s < 0.7").collect()) and 9000 in ids and None in ids
        elif name == "near copies":
            kept = {r.doc_id for r in ngram_join.ngram_join(before).where("kept").collect()}
            assert set(ids) == kept and ids[9005] == 1 and 9000 in ids and 9001 not in ids and None in ids and 9004 in ids
        elif name == "benchmark":
            leaked = {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert 9002 in leaked and set(ids) == {r.doc_id for r in before.collect()} - leaked
        elif name == "personal data":
            texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
            assert texts[9003] == ("number [CARD] of a card", 23) and texts[9004] == (None, None)
            assert all(texts[r.doc_id][0] == pii.redact(r.text, pii.find(r.text)) for r in before.where("text IS NOT NULL").collect())
        else:
            assert set(docs.columns) == {*columns, "copy"} and set(ids) <= {r.doc_id for r in before.collect()}
            assert max(ids.values()) <= 2
    assert rows


def test_stages_decide_for_each_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    one, two = " ".join(f"tok{k}" for k in range(60)), " ".join(f"other{k}" for k in range(60))
    rows = [
        (1, one, "en", "s", 1), (2, one + " end", "en", "s", 1), (3, one, "en", "s", 1),
        (2, two, "en", "s", 1), (7, two + " end", "en", "s", 1), (8, "first of eight", "en", "s", 1), (8, "second of eight", "en", "s", 1),
        (8, "second of eight", "en", "s", 1), (None, "clean", "en", "s", 1), (None, "clean too", "en", "s", 1), (None, "x " + leak, "en", "s", 1), (9, leak, "en", "s", 1), (9, "nine", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        {(i, t): 1 for i, t in [(1, one), (2, two), (8, "first of eight"), (8, "second of eight"), (9, "nine"), (None, "clean"), (None, "clean too"), (None, "x " + leak)]}
        | ({(9, leak): 1}))
    left = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((r[0], r[1]) for r in rows if leak not in r[1])
