"""Similarity operators against brute force on small tables."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import near_vectors, ngram_join, shared

SF = "/root/testdata/sf0.001"


def linked(ids, pairs):
    links, low = {i: 0 for i in ids}, {i: i for i in ids}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return links, low


def result(df, key):
    return {r[key]: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def vectors_of(rows):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    ids = sorted(good)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
        if len(good[a]) == len(good[b]) and good[a] @ good[b] / math.sqrt(good[a] @ good[a]) / math.sqrt(good[b] @ good[b]) >= 0.95]
    return linked([i for i, _ in rows if i is not None], pairs)


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 40)
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(150).collect()]
    rng = np.random.default_rng(0)
    for k in range(60):
        base = np.array(rows[k % 5][1])
        rows.append((1000 + k, [float(x) for x in (base if k % 3 == 0 else base * 3 + rng.normal(0, 0.02 + 0.01 * (k % 5), 64))]))
    rows += [(2000, None), (2001, [0.0] * 64), (2002, [float("nan")] * 64), (2003, [None, *[1.0] * 63]), (2004, [1e200, 1e200]), (2005, [2e-200, 2e-200]), (2006, [])]
    links, low = vectors_of([r for r in rows if r[0] not in (2004, 2005)])
    links |= {2004: 1, 2005: 1}
    low |= {2004: 2004, 2005: 2004}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rep", "'x' AS size")
    got = result(near_vectors.near_vectors(df), "vec_id")
    assert got == {i: (links[i], low[i], low[i] == i) for i in links}


def test_vectors_edges(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (7, [2.0, 0.0])], "vec_id long, embedding array<double>")
    rows = sorted(tuple(r) for r in near_vectors.near_vectors(df).collect() if r.vec_id is not None)
    assert rows == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False)]
    assert [tuple(r) for r in near_vectors.near_vectors(df).where("vec_id is null").collect()] == [(None, 0, None, True)]
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_are_stored_and_shuffled_once_however_many_tiles(spark, monkeypatch):
    frames, rng = {}, np.random.default_rng(3)

    def kept(df, name, plain=near_vectors.stored, **options):
        plan = df._jdf.queryExecution().executedPlan().toString()
        frames[name] = plain(df, name, **options), plan
        return frames[name][0]

    for name, value in (("TILE", 16), ("EDGES", 20), ("stored", kept)):
        monkeypatch.setattr(near_vectors, name, value)
    n = 2000
    base = rng.normal(size=(n, 64))
    base[600:900] = base[0] + rng.normal(0, 0.12, (300, 64))
    base[900:1000] = base[:100] + rng.normal(0, 0.3, (100, 64))
    x = base.astype(np.float32)
    u = x / np.sqrt((x.astype(float) ** 2).sum(1))[:, None]
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(u @ u.T >= 0.95), strict=True) if a < b]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    # the same directions in fewer dimensions link among themselves only
    short = x[:40, :3].astype(float) / np.sqrt((x[:40, :3].astype(float) ** 2).sum(1))[:, None]
    pairs += [(5000 + int(a), 5000 + int(b)) for a, b in zip(*np.nonzero(short @ short.T >= 0.95), strict=True) if a < b]
    rows += [(5000 + k, [float(c) for c in v[:3]]) for k, v in enumerate(x[:40])]
    links, low = linked([i for i, _ in rows], pairs)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(near_vectors.near_vectors(df), "vec_id") == {i: (links[i], low[i], low[i] == i) for i in links}
    # pairs of tiles read the stored tiles, no tile is sent once per tile it meets; units and tiles hold floats
    assert "Exchange" not in frames["links"][1] and frames["tiles"][0].count() >= n / 16
    size = sum(len(r[k]) for name, k in (("units", "_data"), ("tiles", "data")) for r in frames[name][0].select(k).collect())
    assert size <= 2 * (n * 64 + 40 * 3) * 4 and len(frames) == 3


def test_tiles_are_bounded_in_bytes_and_numbered_once(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE_BYTES", 64)
    tables = [pa.table({"_dim": pa.array([d] * 5, pa.int32()), "rep": pa.array(range(5), pa.int64()), "size": pa.array([1] * 5, pa.int64()),
                        "_class": pa.array([bytes(16)] * 5), "_data": pa.array([bytes(4 * d)] * 5), "_part": pa.array([3] * 5, pa.int64())})
              for d in (2, 4, 8, 40)]
    tiles = [b.to_pylist()[0] for b in near_vectors._packed(3)(b for t in tables for b in t.to_batches())]
    assert len({t["no"] for t in tiles}) == len(tiles) and all(t["no"] >> 32 == 3 for t in tiles)
    assert all(len(t["ids"]) // 8 <= 3 and (len(t["data"]) <= 64 or len(t["ids"]) == 8) for t in tiles)
    assert sorted((t["dim"], len(t["data"]) // t["dim"] // 4) for t in tiles) == sorted(
        [(2, 3), (2, 2), (4, 3), (4, 2), (8, 2), (8, 2), (8, 1), *[(40, 1)] * 5])


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 70), st.floats(0.01, 0.99))
def test_links_of_tiles_of_uneven_vectors(seed, d, threshold):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(30, d)), rng.normal(size=(20, d))
    x[:10] = y[:10] * rng.uniform(0.1, 5, (10, 1)) + rng.normal(0, 0.2, (10, d))
    x[10:15], y[10:15] = np.eye(d)[np.arange(5) % d], -np.eye(d)[np.arange(5) % d]
    x, y = near_vectors.units(x), near_vectors.units(y)
    found = {(int(a), int(b)) for i, j in near_vectors.tile_links(x, y, False, threshold) for a, b in zip(i, j, strict=True)}
    assert found == {(a, b) for a in range(30) for b in range(20) if (x[a] * y[b]).sum() >= threshold}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 70))
def test_quantisation_bound_holds(seed, d):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(20, d))
    x[:5] = x[5:10] + rng.normal(0, 0.05, (5, d))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    q, s, e = near_vectors.quantised(x)
    approx = near_vectors._product(q, q) * s[:, None] * s[None, :]
    hat = np.sqrt(((s[:, None] * q) ** 2).sum(1))
    assert (np.abs(approx - x @ x.T) <= e[:, None] + hat[:, None] * e[None, :] + 1e-9).all()
    found = {(int(a), int(b)) for i, j in near_vectors.tile_links(x, x, True, 0.95) for a, b in zip(i, j, strict=True)}
    assert found == {(a, b) for a in range(20) for b in range(a + 1, 20) if x[a] @ x[b] >= 0.95}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard_links(rows):
    sets = {i: grams(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    return linked(ids, pairs)


@pytest.mark.parametrize("block", [256, 5])
def test_ngram_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    base = [f"w{k % 97}x{k % 89}" for k in range(300)]
    for k in range(40):
        words = list(base)
        for j in range(k % 7):
            words[(k * 31 + j * 17) % 300] = f"new{k}"
        rows.append((5000 + k, " ".join(words)))
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "one two"), (6004, "ONE  two\n"), (6005, "two one"), (6006, "long " * 30_000)]
    links, low = jaccard_links(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rep", "2 AS family")
    got = result(ngram_join.ngram_join(df), "doc_id")
    assert got == {i: (links[i], low[i], low[i] == i) for i in links}


def test_ngram_join_edges(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (9, t + " ")], "doc_id long, text string")
    rows = sorted(tuple(r) for r in ngram_join.ngram_join(df).collect() if r.doc_id is not None)
    assert rows == [(3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False)]
    assert [tuple(r) for r in ngram_join.ngram_join(df).where("doc_id is null").collect()] == [(None, 0, None, True)]
    assert ngram_join.ngram_join(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999, 192)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 192
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 4)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_roots(pairs):
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    _, low = linked(range(31), pairs)
    assert shared.roots(31, a, b).tolist() == [low[i] for i in range(31)]


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100 + k, 100) for k in range(1, 80)] + [(7, 7)]
    got = {r.id: r.component for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{100 + k: 100 for k in range(80)}}
