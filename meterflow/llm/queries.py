"""The operators applied to their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import chat, decontaminate, fill_middle, hard_negatives, html_text, mixing, near_vectors, ngram_join, pii
from meterflow.llm import recurrent_lm, token_records, toxicity, warc
from meterflow.llm.registry import query, table
from meterflow.llm.shared import fresh_folder


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op3_near_vectors")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op4_recurrent_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(table(spark, sf_dir, "documents"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# DuckDB has no base 32: the digest is put together from the bits of the hexadecimal SHA-1
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, sha1(h) AS hex, octet_length(encode(h)) AS n FROM p),
k AS (SELECT hex, min(page_id) AS keeper FROM d GROUP BY hex),
b AS (SELECT hex, keeper, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (('0x' || substr(hex, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT & 31)::INT, 1)), 'string_agg', '') AS digest FROM k)
SELECT d.page_id, d.n::BIGINT AS payload_bytes, b.digest AS payload_digest,
    CASE WHEN d.page_id = b.keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN d.page_id <> b.keeper THEN b.keeper END AS refers_to
FROM d JOIN b USING (hex)
"""


@query("op6_warc", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@query("op7_chat")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "conv")
    parsed = chat.parse(chat.transcript_lines(turns), chat.learn(turns), part=64 * chat.TURN_LINES)
    return chat.render(parsed).select(F.col("conv").alias("conv_id"), "line", "turn", "role", "rendered")


@query("op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))

    def text(kinds: tuple[str, ...]):
        # base kinds come by kind and start already, added ones after them
        of = F.filter("pii", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(text(pii.BASE), 256).alias("base_sha256"), text(pii.KINDS).alias("spans"))


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op11_token_records")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = fresh_folder(spark, "token-records")
    token_records.write_records(table(spark, sf_dir, "documents"), folder, str(public_tokenizers.path("byte_bpe_50k.json")))
    return token_records.read_records(spark, folder, ids=False)


# the first four groups of the hash as h1 to h4, cuts in code points
OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
    ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query("op12_fill_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.restored(fill_middle.fill_middle(table(spark, sf_dir, "documents")))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
r AS (SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS rank
    FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))
