"""Operators on single texts and pages against plain Python."""

import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from meterflow.llm import chat, decontaminate, html_text, mixing, pii, toxicity, warc
from meterflow.llm.queries import OP6_SQL  # noqa: F401
from meterflow.llm.registry import QUERIES
from meterflow.llm.shared import fresh_folder

SF = "/root/testdata/sf0.001"


def sizes(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(per_source, share=1.5, most=2.0):
    """Shares by weight with caps, source by source."""
    names = sorted((s for s in per_source if s is not None), key=lambda s: s) + ([None] if None in per_source else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, free, out = share * sum(per_source.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * per_source[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = most * per_source[s]
            left -= out[s]
        free -= over
    return out


def test_mixing(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows += [(900, None, None), (901, " \n", "src0"), (902, " a  b\t", None), (None, "x", "Z"), (902, " a  b\t", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.selectExpr("*", "1 AS size", "2 AS copies", "3 AS target")
    got = mixing.mix(df).toPandas()
    per = {}
    for _, text, source in rows:
        per[source] = per.get(source, 0) + sizes(text)
    want = filled(per)
    assert abs(sum(want.values()) - 1.5 * sum(per.values())) < 1e-6
    by_id = {i: (s, sizes(t)) for i, t, s in rows}
    for r in got.itertuples():
        source, size = by_id[None if pd.isna(r.doc_id) else int(r.doc_id)]
        assert r.size == size and r.source_size == per[source] and abs(r.target - want[source]) < 1e-6
        rate = want[source] / per[source] if per[source] else 0
        assert int(rate) <= r.copies <= int(rate) + (rate % 1 > 0) and r.taken == r.copies * size
    again = mixing.mix(df.repartition(7)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    emitted = mixing.emit(df)
    assert emitted.columns == [*df.columns, "copy"]
    assert emitted.count() == got.copies.sum()
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_amounts_are_near_targets(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")).toPandas()
    total = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((total.taken / total.target - 1).abs() < 0.12).all()


def brute_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_pii(spark):
    more = [
        (9000, None), (9001, ""), (9002, "é mail: a.b@c.de, card 4111 1111-1111 1111 or 4111111111111112; ip 10.0.0.256 010.1.2.3"),
        (9003, "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765433, ssn: 123-45-6789" + " and" * 20 + " order 123-45-6789"), (9004, "+49 (30) 1234-567.8 +1 2"),
        (9005, "x" * 200_000 + " 1.2.3.4" + "9" * 5000 + ".1.1.1"), (None, "a@b.cd"),
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.detect(docs).collect():
        base = [(s.kind, s.start, s.end) for s in r.pii if s.kind in pii.BASE]
        assert base == brute_spans(texts[r.doc_id] or "")
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert pii.digest([tuple(s) for s in r.pii]) == hashlib.sha256(want.encode()).hexdigest()
    added = {r.doc_id: [(s.kind, s.start) for s in r.pii if s.kind not in pii.BASE] for r in pii.detect(docs).collect()}
    assert added[9003] == [("iban", 5), ("ssn", texts[9003].index("123-"))]
    out = {r.doc_id: r.redacted for r in pii.detect(docs.selectExpr("*", "1 AS kind"), redacted=True).collect()}
    assert out[9000] is None and out[9002].startswith("é mail: [EMAIL], card [CARD] or 4111111111111112") and out[9002].endswith("[IP]")
    with pytest.raises(ValueError):
        pii.detect(docs.selectExpr("*", "1 AS pii"), redacted=True)
    assert pii.detect(docs.limit(0)).count() == 0


def test_pii_query_digest(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = brute_spans(r.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert rows[r.doc_id].n_phone == sum(k == "phone" for k, _, _ in spans)


WORDS = [f"w{k}" for k in range(400)]


def brute_leaks(docs, items, window=13, rate=0.8):
    out = set()
    for d, t in docs:
        w = (t or "").lower().split()
        for i, u in items:
            v = (u or "").lower().split()
            if len(v) < 5:
                continue
            n = min(window, len(v))
            need = -(-n * 8 // 10)
            for off in range(-len(v) + n, len(w) - n + 1):
                same = [0 <= off + k < len(w) and w[off + k] == v[k] for k in range(len(v))]
                if any(sum(same[k:k + n]) >= need for k in range(max(0, -off), min(len(v), len(w) - off) - n + 1)):
                    out.add((d, i))
                    break
    return out


def test_decontamination(spark):
    rng = np.random.default_rng(3)

    def words(n):
        return [WORDS[k] for k in rng.integers(0, 400, n)]

    items = [(k, " ".join(words(n))) for k, n in enumerate([20, 40, 13, 7, 5, 4, 60])] + [(90, None), (91, "")]
    docs = []
    for k in range(60):
        body, (item, text) = words(50), items[k % 7]
        part = text.split()
        if k % 3 == 0 and len(part) >= 13:
            part[2], part[9] = "changed", "too"  # two of the first thirteen
        docs.append((k, " ".join(body + (part if k % 4 else []) + words(20)).title()))
    docs += [(100, None), (101, ""), (102, " \n" + items[1][1] + " "), (103, " ".join(items[6][1].split()[20:40]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS seed")
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = decontaminate.leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_leaks(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) > 30
    assert decontaminate.leaks(df.limit(0), bench).count() == 0 == decontaminate.leaks(df, bench.limit(0)).count()
    with_null = spark.createDataFrame([(None, items[1][1])], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(with_null, bench).collect()] == [(None, 1)]


def test_masks_find_two_substitutions():
    for a in range(13):
        for b in range(a, 13):
            assert any({a, b}.isdisjoint({o + p for p in m}) for m in decontaminate.MASKS for o in range(13 - m[-1]))


def test_short_items_are_found_with_every_allowed_substitution(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(5, 13)]
    docs = []
    for n, text in items:
        # one more than allowed as well, which must not be found
        for gone in [*combinations(range(n), n // 5), *list(combinations(range(n), n // 5 + 1))[:5]]:
            docs.append((len(docs), " ".join(["before", *["x" if k in gone else w for k, w in enumerate(text.split())], "after"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_leaks(docs, items) and len(got) == 201


def small_model():
    text = "you are an idiot and a loser moron stupid trash clown scum the of and other is in it not what why " * 30
    c = toxicity._TABLE[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 0x250)].astype(np.int64)
    n = toxicity.CLASSES
    return toxicity.CharModel(np.bincount(((c[:-3] * n + c[1:-2]) * n + c[2:-1]) * n + c[3:], minlength=n ** 4))


@pytest.mark.parametrize("disguise", ["1d10t", "idi0t", "i d i o t", "i.d.i.o.t", "iiidiooot", "!diot", "id1oooot!!", "i-d-i-0-t"])
def test_decoding(disguise):
    assert toxicity.restored_text(f"what {disguise} is", small_model()) == "what idiot is"


@pytest.mark.parametrize("disguise", ["s" * 40 + "tupid", ".".join("stupid") + "." * 60 + "!", "5" + "t" * 200 + "up1d", "i" * 50_000 + "d1ot"])
def test_long_disguises_are_decoded(disguise):
    assert toxicity.restored_text(f"what {disguise} is", small_model()) == f"what {'idiot' if disguise[0] == 'i' else 'stupid'} is"


def test_clean_words_pass_through():
    assert toxicity.restored_text("Other %%% is it? (Not) *2024* **coffee**", small_model()) == "other is it not 2024 coffee"
    assert toxicity.restored_text(None, small_model()) == ""


def toxic_table(spark, extra=()):
    rng = np.random.default_rng(5)
    plain = [f"{a}{b}" for a in ("the", "of", "tion", "er", "in") for b in ("st", "ea", "ou", "nd", "ing")]
    rows, labels = [], []
    for k in range(300):
        words = [plain[j] for j in rng.integers(0, len(plain), 40)]
        bad = k % 4 == 0
        if bad:
            words[5:5] = [("idiot", "loser", "moron")[k % 3]] * 2
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += list(extra)
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_toxicity_held_out_and_edges(spark):
    extra = [(900, None), (901, ""), (902, "the 1d10t of a l o s e r"), (903, "theea " * 30_000), (None, "moron idiot")]
    docs, labels, truth = toxic_table(spark, extra)
    labels = labels.unionByName(spark.createDataFrame([(1, None), (None, 1), (5, 7), (4000, 1)], "doc_id long, toxic int"))
    rows = {r.doc_id: r for r in toxicity.score(docs.selectExpr("*", "'x' AS score", "1 AS held_out"), labels).collect()}
    assert len(rows) == 305 and all(0 <= r.score <= 1 for r in rows.values())
    for k, y in truth:
        assert rows[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert (rows[k].score >= 0.7) == bool(y)
    assert rows[900].score == rows[901].score < 0.7 and rows[903].score < 0.7 < rows[902].score and rows[None].score > 0.7
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_archive_round_trip(spark):
    rows = [(5, "http://a/\r\nX: y", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "u", None), (4, "v", ""), (7, "w", "z" * 300_000), (None, "n", "alone"), (3, None, "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS keeper")
    folder = fresh_folder(spark, "archive-test")
    warc.write_archive(pages, folder)
    got = {(r.page_id, r.url): r for r in warc.read_archive(spark, folder).collect()}
    assert len(got) == 6 and spark.read.parquet(f"{folder}/payloads").count() == 4
    assert warc.read_archive(spark, folder).count() == 7
    one = got[5, "http://a/%0D%0AX: y"]
    assert (one.record_type, one.refers_to, bytes(one.payload)) == ("revisit", 3, "<p>é</p>".encode())
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: w\r\n"
        f"WARC-Payload-Digest: sha1:{got[7, 'w'].payload_digest}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 300000\r\n\r\n")
    assert bytes(got[7, "w"].record) == head.encode() + b"z" * 300_000 + b"\r\n\r\n"
    assert got[4, "v"].record_type == "response" and got[9, "u"].refers_to == 4 and got[None, "n"].record_type == "response"
    import base64
    assert all(r.payload_digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() for r in got.values())
    folder = fresh_folder(spark, "archive-least")
    warc.write_archive(pages, folder, least=100)
    assert {r.record_type for r in warc.read_archive(spark, folder).collect()} == {"response"}
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    folder = fresh_folder(spark, "archive-empty")
    warc.write_archive(pages.limit(0), folder)
    assert warc.read_archive(spark, folder).count() == 0


def test_archive_fails_on_a_broken_payload(spark):
    folder = fresh_folder(spark, "archive-broken")
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), folder)
    spark.read.parquet(f"{folder}/payloads").selectExpr("digest", "CAST('abd' AS binary) AS payload").write.mode("overwrite").parquet(f"{folder}/other")
    spark.read.parquet(f"{folder}/other").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="no valid payload"):
        warc.read_archive(spark, folder).select("payload").collect()


def page(body):
    return f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body>{body}</body></html>"


@pytest.mark.parametrize("html,want", [
    (page("<nav><a>Menu</a></nav><article><h1>A &amp; B</h1><p>one\n two<b>bold</b> x</p><p>three<br>four</p></article><footer>f</footer>"), "A & B\none twobold x\nthree\nfour"),
    (page("<article><p>text<div class='ad'>buy</div><p>more<aside>side</aside><section id=comments><p>reader</p></section></article>"), "text\nmore"),
    (page("<div class='cookie-notice'>ok?</div><main><p><b>open<br><p>next</main><form>f</form>"), "open\nnext"),
    (page("<div class='header'>h</div><div><p>only slots</p><style>p{}</style></div><div role=navigation>n</div>"), "only slots"),
    ("<article><p>cut &lt;off&gt; 1 < 2<p>tail<a hre", "cut <off> 1 < 2\ntail"),
    ("<head><title>x</title><body><p>plain<!-- c --> text<script>z</script>", "plain text"),
    ("", ""), (None, ""), ("no markup", "no markup"), ("<p class=\"open>broken</p><p>fine</p>", "broken\nfine"),
])
def test_pages(spark, html, want):
    df = spark.createDataFrame([(1, "http://h/x", html)], "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    assert html_text.extract(df).first().text == want


def test_template_of_a_host(spark):
    rows = [(k, f"https://www.Host.org:80/{k}", f"<html><body><div class=top><p>Welcome to us</p></div><div><p>story {k}</p><p>of day {k}</p></div><div>All rights</div></body></html>") for k in range(6)]
    rows += [(50, "http://other/", rows[0][2]), (51, None, "<p>x</p>"), (52, "http://copies/a", "<p>same</p>"), (53, "http://copies/b", "<p>same</p>"), (None, "http://copies/b", "<p>same</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert all(got[k] == f"story {k}\nof day {k}" for k in range(6))
    assert got[50] == "Welcome to us\nstory 0\nof day 0\nAll rights" and got[51] == "x" and got[52] == got[53] == got[None] == "same"
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("body,want", [
    ("<article class='post hentry tag-politics legal'><p>text</p></article>", "text"),
    ("<div class='content with-sidebar'><article><p>text</p></article></div><p>left</p>", "text"),
    ("<div class='sidebar'><article><p>text</p></article></div><p>left</p>", "text"),
    ("<div class='sidebar'><article><p>card</p></article></div><article><p>text</p></article>", "text"),
    ("<article><div class='entry-header'><h1>Title</h1></div><div class='product-reviews'>text</div></article>", "Title\ntext"),
    ("<article><header class='entry-header'><h1>Title</h1></header><p>text</p></article>", "Title\ntext"),
    ("<article><p>text</p><ol class='comment-list'><li>reader</ol><div class='ad-slot ad_2'>buy</div></article>", "text"),
    ("<div class='cookie-notice'>ok</div><div class='site-header'>h</div><p>text</p>", "text"),
])
def test_names_of_parts(spark, body, want):
    df = spark.createDataFrame([(1, "http://h/x", page(body))], "page_id long, url string, html string")
    assert html_text.extract(df).first().text == want


def test_template_inside_articles(spark):
    def html(k, story):
        return page(f"<article><h1>Head {k}</h1><p>{story}</p><p>Read our paper daily</p></article>")

    story = "a long story that two pages of this host share word by word"
    rows = [(k, f"http://host/{k}", html(k, f"what happened on day {k} and the days after it was new")) for k in range(6)]
    rows += [(10 + k, "http://host/c", html(f"copy {k}", story)) for k in range(2)] + [(20, "http://one/", html(0, "x"))]
    # no article, boilerplate and content at one path
    rows += [(30 + k, f"http://mixed/{k}", f"<body><div><p>Terms of use</p><p>own text {k} of this page</p></div>") for k in range(4)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"Head {k}\nwhat happened on day {k} and the days after it was new" for k in range(6))
    assert got[10] == f"Head copy 0\n{story}" and got[20] == "Head 0\nx\nRead our paper daily"
    assert all(got[30 + k] == f"own text {k} of this page" for k in range(4))


def test_chat_parts_agree_with_one_pass(spark):
    model = chat.Model({})
    rng = np.random.default_rng(1)
    lines = []
    for c in range(3):
        for k in range(200):
            lines.append((c, k, rng.choice(["User: hi?", "Assistant: well", "more text", "", "Note: x", "Q: what", "A: that", None])))
    df = spark.createDataFrame([(int(a), int(b), None if t is None else str(t)) for a, b, t in lines], "conv long, line long, text string")
    for part in (7, 1000):
        parsed = sorted(chat.parse(df.repartition(5), model, part=part).collect(), key=lambda r: (r.conv, r.line))
        for c in range(3):
            texts = [t or "" for a, _, t in lines if a == c]
            seen = [chat.features(t, k % part > 0 and not texts[k - 1].strip()) for k, t in enumerate(texts)]
            e = model.emissions(seen)
            last = int(model.matrix(e, True)[0].argmax())
            own = [r for r in parsed if r.conv == c]
            found = [2 * chat.ROLES.index(r.role) + (not r.opens) for r in own]

            def total(states):
                return model.first[states[0]] + sum(model.step[x, y] for x, y in zip(states, states[1:], strict=False)) + e[range(len(states)), states].sum()

            # equally likely paths may differ, their probability may not
            assert abs(total(found) - total(model.path(e, True, 0, last))) < 1e-6
            assert [r.turn for r in own] == (np.cumsum([s % 2 == 0 for s in found]) - 1).tolist()
    assert parsed[0].text == (lines[0][2] or "") or parsed[0].opens


def test_chat_roles_and_edges(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").withColumnRenamed("conv_id", "conv")
    lines = chat.transcript_lines(turns)
    parsed = chat.parse(lines, chat.learn(turns), part=64 * chat.TURN_LINES).toPandas()
    parsed["true_turn"] = parsed.line // chat.TURN_LINES
    both = parsed.merge(turns.toPandas(), left_on=["conv", "true_turn"], right_on=["conv", "turn"])
    assert len(both) == len(parsed) == lines.count() and (both.role_x == both.role_y).mean() > 0.95
    odd = spark.createDataFrame([(None, 1, "User: x"), (1, None, "y"), (2, 0, None)], "conv long, line long, text string")
    rows = {(r.conv, r.line): (r.turn, r.role) for r in chat.parse(odd, chat.Model({})).collect()}
    assert rows[None, 1] == (None, None) == rows[1, None] and rows[2, 0][1] is not None
    assert chat.parse(odd.limit(0), chat.Model({})).count() == 0
    shown = chat.render(chat.parse(spark.createDataFrame([(1, 0, "User: hi"), (1, 1, "AI: yes")], "conv long, line long, text string"), chat.Model({})))
    assert [r.rendered for r in shown.orderBy("line").collect()] == ["<|user|>\nhi", "<|assistant|>\nyes"]
