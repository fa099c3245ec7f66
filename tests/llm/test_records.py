"""Binary token records, fill-in-middle cuts and hard negatives against brute force and exact round trips."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterflow.llm import fill_middle, hard_negatives, token_records

SF = "/root/testdata/sf0.001"
TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


# ---- token records


def slow_crc(data):
    r = 0xFFFFFFFF
    for x in data:
        r ^= x
        for _ in range(8):
            r = (r >> 1) ^ (0x82F63B78 if r & 1 else 0)
    return r ^ 0xFFFFFFFF


def test_checksum_against_bits():
    crc = token_records.Crc32c()
    assert crc(b"123456789") == 0xE3069283
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 7, 8, 9, 100, 1023, 1024, 1025, 1028, 5000):
        data = rng.randbytes(n)
        assert crc(data) == slow_crc(data), n


def test_frames_notice_every_damage():
    crc = token_records.Crc32c()
    records = [token_records.packed(i, np.arange(i, dtype="<u4") + 7 * i) for i in (0, 3, 90)] + [token_records.packed(None, np.array([1, 70_000]))]
    data = b"".join(token_records.frame(r, crc) for r in records) + token_records.frame(b"", crc)
    assert [bytes(p) for _, p in token_records.frames(data, crc)] == records
    assert [(i, ids.tolist()) for i, ids in map(token_records.unpacked, records)][2:] == [(90, [630 + k for k in range(90)]), (None, [1, 70_000])]
    # every byte counts, and so does the end
    for at in range(len(data)):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1:]
        with pytest.raises(ValueError):
            list(token_records.frames(broken, crc))
    for cut in (0, 5, len(data) - 1, len(data) - 16):
        with pytest.raises(ValueError):
            list(token_records.frames(data[:cut], crc))
    with pytest.raises(ValueError):
        list(token_records.frames(data + b"x", crc))


ALPHABET = ["a", "b", "é", "1", "²", "'s", "'", "!", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "​", " ", "　", "᠎", "中", "😀", "_", "́", "<|endoftext|>", "|>", "."]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = token_records._encoder(file.read())
    found = encoder.ids(pa.array(texts, pa.string()))
    assert [f.tolist() for f in found] == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_records_round_trip(spark, tmp_path):
    rng = random.Random(2)
    texts = ["", None, "a", "word " * 3000, "x" * 5000, "<|endoftext|> b", "é中 　 z"] + ["".join(rng.choices("ab c.é\n", k=rng.randrange(300))) for _ in range(120)]
    rows = [(rng.choice([None, *range(-40, 40)]), t, "en") for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    folder = f"{tmp_path}/records"
    token_records.write_records(docs, folder, TOKENIZER, file_bytes=2000)
    library = Tokenizer.from_file(TOKENIZER)
    own = defaultdict(list)
    for i, t, _ in rows:
        own[i].append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    got = sorted(token_records.read_records(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        own[r["doc_id"]].remove(r["ids"])
        at += r["n_tokens"]
    assert not any(own.values())
    index = token_records.read_index(spark, folder)
    assert sorted((r["start"], r["n_tokens"]) for r in index.collect()) == [(r["start"], r["n_tokens"]) for r in got]
    assert index.select("file").distinct().count() > 5
    # an epoch is an order of the seed, whatever the number of tasks
    first = [tuple(r) for r in token_records.shuffled(spark, folder, 1).collect()]
    assert sorted(map(str, first)) == sorted(str((r["doc_id"], r["ids"])) for r in got)
    assert first == [tuple(r) for r in token_records.shuffled(spark, folder, 1).collect()] != [tuple(r) for r in token_records.shuffled(spark, folder, 2).collect()]
    some = token_records.shuffled(spark, folder, 1, index.where("doc_id < 0"))
    assert some.count() == sum(1 for r in rows if r[0] is not None and r[0] < 0)


def test_damaged_and_empty_records(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some text") for i in range(9)], "doc_id long, text string").coalesce(1)
    folder = str(tmp_path / "r")
    token_records.write_records(docs, folder, TOKENIZER)
    file = next(f for f in (tmp_path / "r" / "records").iterdir() if f.name.startswith("part-") and f.stat().st_size)
    raw = bytearray(file.read_bytes())
    n, _ = struct.unpack_from("<QI", raw, 0)
    raw[12 + n - 1] ^= 1
    file.write_bytes(raw)
    (tmp_path / "r" / "records" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="broken record"):
        token_records.read_records(spark, folder).count()
    empty = str(tmp_path / "empty")
    token_records.write_records(docs.limit(0), empty, TOKENIZER)
    assert token_records.read_records(spark, empty).count() == 0 == token_records.read_index(spark, empty).count()
    with pytest.raises(ValueError):
        token_records.write_records(docs, folder + "2", str(public_tokenizers.path("word_bpe_49k.json")))


# ---- fill in the middle


def boundaries(text, unit):
    if unit == "code_point":
        return list(range(len(text) + 1))
    if unit == "line":
        starts = [i + 1 for i, x in enumerate(text) if x == "\n" and i + 1 < len(text)]
    else:
        starts = [i for i, x in enumerate(text) if not x.isspace() and i and text[i - 1].isspace()]
        if text[:1].isspace() and starts:
            # what stands before the first word belongs to it
            starts = starts[1:]
    return [0, *starts, len(text)] if text else [0]


@settings(max_examples=300, deadline=None)
@given(st.text("ab é中😀\n\t<PSM>", max_size=60), st.sampled_from(sorted(fill_middle.UNITS)), st.sampled_from([1, 2, 3, 7, 16, 1024]))
def test_cuts_against_scanning(text, unit, block):
    cuts, expected = fill_middle.Cuts(text.encode(), unit, block), boundaries(text, unit)
    assert cuts.n_units == len(expected) - 1 and cuts.n_points == len(text)
    assert [cuts.after(k) for k in range(len(expected))] == [(len(text[:b].encode()), b) for b in expected]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40))
def test_fenwick_descent(counts):
    tree = fill_middle.Fenwick(np.array(counts))
    assert [tree.before(k) for k in range(len(counts) + 1)] == [sum(counts[:k]) for k in range(len(counts) + 1)]
    units = [(b, k) for b, n in enumerate(counts) for k in range(n)]
    assert [tree.descend(k) for k in range(len(units))] == units


@settings(max_examples=300, deadline=None)
@given(st.text("a<PSM>é\n", max_size=40), st.integers(0, 10**6), st.sampled_from(sorted(fill_middle.UNITS)))
def test_restored_text_is_exact(text, seed, unit):
    made = fill_middle.transform(text, seed, 5, unit, fim_rate=100, spm_rate=50)
    assert fill_middle.restore(made["output"], made["form"]) == text
    if made["form"] != "plain":
        assert made["prefix_chars"] + made["middle_chars"] <= len(text) and len(made["output"]) == len(text) + 9


def test_fill_middle_rows(spark):
    rows = [(1, "hello world"), (2, None), (None, "x"), (None, "x"), (3, "has <S> inside"), (4, "é" * 200_000), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'f' AS form", "'r' AS restored").repartition(3)
    found = fill_middle.restored(fill_middle.fill_middle(df, fim_rate=100))
    got = sorted(found.collect(), key=str)
    assert sorted(r["restored"] for r in got) == sorted(t or "" for _, t in rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in rows:
        h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[k:k + 8], 16) for k in range(0, 32, 8)]
        r, n = by_id[i], len(t or "")
        assert r["n"] == n
        if not t or "<S>" in t:
            assert (r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == ("plain", None, None, t or "")
        else:
            low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            assert (r["prefix_chars"], r["middle_chars"], r["form"]) == (low, high - low, "spm" if h[3] % 100 < 20 else "psm")
            assert fill_middle.restore(r["output"], r["form"]) == t
    assert fill_middle.fill_middle(df.limit(0)).count() == 0
    for markers in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P>", "P>x", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_middle(df, markers=markers)
    with pytest.raises(ValueError):
        fill_middle.fill_middle(df, unit="page")


# ---- hard negatives


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 40), st.sampled_from([1, 200, 2**15, 2**31, 2**57]))
def test_packed_products_are_exact(seed, d, n, size):
    rng = np.random.default_rng(seed)
    size = min(size, int((2**61 / d) ** 0.5))
    x, a = rng.integers(-size, size + 1, (n, d)), rng.integers(-size, size + 1, (5, d))
    packed = hard_negatives.Packed(x, int(a.min()), int(a.max()))
    assert size > 200 or packed.per > 1
    assert packed.scores(a).tolist() == (a.astype(object) @ x.T.astype(object)).tolist()


def brute_negatives(rows, every=100, positives=5, negatives=10):
    usable = [(i, lab, [int(np.floor(256 * np.float64(c))) for c in v]) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for k, (i, lab, v) in enumerate(usable):
        if i % every:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, other) for m, (j, other, w) in enumerate(usable) if m != k and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2] == lab)[:positives]:
            near = sorted(x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives]
            out += [(i, p, r, x[1], -s, -x[0]) for r, x in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile, strip", [(1 << 17, 1 << 21), (256, 7)])
def test_negatives_against_brute_force(spark, monkeypatch, tile, strip):
    monkeypatch.setattr(hard_negatives, "TILE_BYTES", tile)
    monkeypatch.setattr(hard_negatives, "STRIP", strip)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(320):
        v = [float(x) for x in rng.normal(0, 1, 8)] if i % 9 else [float(x) for x in rng.integers(0, 2, 8)]
        rows.append((i * 5, int(rng.integers(0, 3)), v))
    rows += [(100, 1, rows[20][2]), (100, 1, rows[20][2]), (200, 2, [1.0] * 8), (-300, 0, [5.0] * 8), (300, None, [1.0] * 8), (None, 1, [1.0] * 8), (400, 1, None)]
    rows += [(500, 1, [float("nan")] * 8), (600, 1, [None] * 8), (700, 1, [1.0, 2.0]), (701, 1, [1.0, 2.0]), (702, 0, [1.0, 1.0]), (800, 4, [1e6] * 8), (801, 4, [1e6] * 8), (802, 1, [6e5] * 8), (900, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").selectExpr("*", "1 AS rank", "'x' AS key").repartition(4)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect())
    assert got == brute_negatives(rows) and got
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(df.where("vec_id = 701")).count() == 0
    few = sorted(tuple(r) for r in hard_negatives.hard_negatives(df, every=50, positives=2, negatives=3).collect())
    assert few == brute_negatives(rows, 50, 2, 3)


def test_huge_components_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300])], "vec_id long, label long, embedding array<double>")
    with pytest.raises(Exception, match="over 62 bits"):
        hard_negatives.hard_negatives(df).count()
