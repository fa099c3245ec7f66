"""Very long and odd inputs of the operators on texts, rows without keys, and what is read how often."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterflow.llm import chat, html_text, pii, recurrent_lm

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")


def test_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(30_000):
        text = "".join(rng.choices("ab@@..-1 %é", k=rng.randint(1, 22)))
        assert pii.emails(text) == [m.span() for m in EMAIL.finditer(text)], text
        text = "".join(rng.choices("12..5 ", k=rng.randint(1, 22)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in IP.finditer(text)], text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "+1 ", "1 ", "AA11 ", "(", "<a ", "<div>", "<div>x", "<b><p>", "<a \">\"", "<!--", "</ ", "<li>", "<"])
def test_a_megabyte_takes_seconds(unit):
    text = unit * (1_000_000 // len(unit))
    start = time.process_time()
    pii.find(text + " x@y.z")
    html_text.blocks(text)
    html_text.blocks(text + ">")
    assert time.process_time() - start < 20


def test_pages_of_odd_tags():
    def texts(page):
        return [b[1] for b in html_text.blocks(page)[0]]

    assert texts("<p>a<!-- <p>b --><p>c") == ["a", "c"]
    assert texts("a <b title='x>y'>b</b> c") == ["a b c"]
    assert texts("a < b > c <1 &lt;d") == ["a < b > c <1 <d"]
    assert texts("<p>a</p><a href=\"x>b") == ["a", "b"]
    assert texts("<p>kept<div") == ["kept"] and texts("x <!-- open") == ["x"]
    assert texts("<p \"><p>one</p><p>two</p>") == ["one", "two"]
    deep = html_text.blocks("<div>" * 700 + "<p>x</p>" + "</div>" * 700 + "<p>y</p>")[0]
    assert [b[1] for b in deep] == ["x", "y"] and len(deep[0][0]) == html_text.DEPTH


def test_classes_against_plain_python(spark):
    """Template blocks of a host by whole occurrence vectors and chains of elements, against the joins."""
    pages = [
        f"<body><div class=top>Shop</div><div class=box><p>note</p></div>{'<p>twice</p>' * (1 + k % 2)}<article><h1>Title {k}</h1><p>Body {k}</p>"
        f"{'<p>share this</p>' if k != 3 else ''}</article><footer>end</footer></body>" for k in range(6)]
    rows = [("h", p) for p in pages] + [("other", pages[0])]
    df = spark.createDataFrame(rows, "host string, html string")
    tokens = df.mapInArrow(html_text._tokens, "host string, page bigint, path bigint, block bigint, n int, other bigint, inside boolean, above array<bigint>").distinct()
    got = {r["host"]: set(r["fixed"]) for r in html_text.template_blocks(tokens).collect()}
    parsed = [html_text.blocks(p) for p in pages]
    vector = {}
    for found, tags in parsed:
        for path in {t[-1] for t in tags}:
            vector[path] = tuple(sum(t[-1] == path for t in tags_) for _, tags_ in parsed)
    vector[0] = (1,) * len(pages)
    fixed = set()
    for path, text in {(b[0], b[1]) for found, _ in parsed for b in found}:
        own = tuple(sum((b[0], b[1]) == (path, text) for b in found) for found, _ in parsed)
        inside = any(b[3] for found, _ in parsed for b in found if (b[0], b[1]) == (path, text))
        if sum(map(bool, own)) >= (3 if inside else 2) and any(vector[p] == own for p in (0, *path)):
            fixed.add(html_text._block_key(path, text))
    # all but the titles, the bodies and what one article lacks
    assert got == {"h": fixed} and len(fixed) == 4


def test_chat_paths_against_all_paths():
    rng = np.random.default_rng(1)
    model = chat.Model({(k, i, j): float(rng.integers(1, 9)) for k, n in (("step", 6), ("first", 1)) for i in range(n) for j in range(6)})
    texts = ["User: hi", "there", "", "Assistant: yes", "- one", "Q: what", "plain"]
    seen = [chat.features(t, k > 0 and not texts[k - 1].strip()) for k, t in enumerate(texts)]
    for n in range(1, 6):
        e = model.emissions(seen[:n])
        states = e.shape[1]
        scored = {p: model.first[p[0]] + sum(model.step[a, b] for a, b in zip(p, p[1:])) + e[range(n), list(p)].sum() for p in itertools.product(range(states), repeat=n)}
        last = int(model.matrix(e, True)[0].argmax())
        path = tuple(model.path(e, True, 0, last))
        assert scored[path] == pytest.approx(max(scored.values()), abs=1e-9)


def test_chat_keeps_rows_without_a_place(spark):
    rows = [(1, 0, "user", "a\nb"), (1, None, "user", "c"), (None, 3, "user", "d\ne"), (None, None, None, None), (1, 0, "user", "a\nb"), (1, 1, "assistant", "\n" * 5000), (2, 3_000_000_000, "user", "far")]
    turns = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    lines = chat.transcript_lines(turns)
    assert lines.count() == 2 + 1 + 2 + 1 + 2 + 5001 + 1
    parsed = chat.parse(lines, chat.learn(turns), part=64 * chat.TURN_LINES)
    assert parsed.count() == lines.count() and parsed.where("role IS NULL").count() == 4
    # n copies of a turn after m copies of the one before are n rows
    twice = spark.createDataFrame([(1, 0, "user", "a")] * 5 + [(1, 1, "assistant", "b")] * 7, "conv long, turn long, role string, text string")
    once = chat.learn(twice)
    again = chat.learn(twice.withColumn("conv", F.monotonically_increasing_id() * 0 + 1))
    assert np.allclose(once.step, again.step)
    assert chat.learn(twice).step.shape == (6, 6)


def test_every_training_document_is_read_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).repartition(7)
    plain = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    expected = sum(len(recurrent_lm.words(r["_text"])) + 1 for r in plain.collect())
    s = recurrent_lm.Symbols([("the", 9), ("a", 5)], np.ones(recurrent_lm.BUCKETS), 120)
    for rounds in (1, 2, 3):
        tokens = []
        recurrent_lm.train(plain, s, rounds, tokens)
        assert len(tokens) == rounds and sum(tokens) == expected


def test_means_of_many_trainers_are_weighted(spark):
    rows = [(np.full(3, k, np.float32).tobytes(), k + 1) for k in range(40)]
    mean = recurrent_lm._averaged(spark.createDataFrame(rows, "w binary, n bigint")).first()
    n = np.arange(1, 41)
    assert mean["n"] == n.sum() and np.allclose(np.frombuffer(mean["w"], np.float32), ((n - 1) * n).sum() / n.sum())
    assert recurrent_lm._averaged(spark.createDataFrame([], "w binary, n bigint")).first() is None


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    named = docs.selectExpr("*", "doc_id AS _key", "doc_id AS _id", "doc_id AS _row", "doc_id AS n", "doc_id AS `a.b`")
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_leaks, corpus_pipeline.redact):
        got = stage(spark, named, SF)
        assert got.columns == named.columns
        assert got.where("_key <> doc_id OR _row <> doc_id OR `a.b` <> doc_id").count() == 0 < got.count()
