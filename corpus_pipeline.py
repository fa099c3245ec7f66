"""Corpus pipeline: stages applied in turn to ``documents``, each written and read again before the next.

A stage is ``(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns of the documents. Toxic texts go,
one document of each group of near duplicates stays, texts with benchmark passages go, personal data is replaced, and
what is left is mixed by source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import decontaminate, mixing, ngram_join, pii, toxicity
from meterflow.llm.shared import sized, stored

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is learned from the labels beside the documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.with_score(docs, labels, name="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def keyed(docs: DataFrame) -> DataFrame:
    """``_key``, a hash of id and text, since ids may be null or stand for different texts; id, text, and the row in ``_row``."""
    key = F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())
    return docs.select(key.alias("_key"), "doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group; of rows that repeat an id and its text one, rows without an id all."""
    rows = keyed(docs.where("doc_id is not null"))
    found = stored(ngram_join.ngram_join(rows.select("_key", "text"), "_key"), "near-copies")
    linked = found.where("n_links > 0").select(F.col("_key").alias("_id"), F.col("component_id").alias("_group")).distinct()
    linked = stored(linked, "linked")
    ids = rows.select("_key", "doc_id").join(sized(linked), F.col("_key") == F.col("_id")).select("_id", "_group", "doc_id")
    first = ids.groupBy("_group").agg(F.min(F.struct("doc_id", "_id")).alias("m")).select(F.col("m._id").alias("_first"))
    gone = stored(linked.join(first, F.col("_id") == F.col("_first"), "left_anti").select("_id"), "gone")
    rest = rows.join(sized(gone), F.col("_key") == F.col("_id"), "left_anti")
    again = found.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_key").alias("_id"))
    again = sized(stored(again, "repeated"))
    single = rest.join(again, F.col("_key") == F.col("_id"), "left_anti")
    folded = rest.join(again, F.col("_key") == F.col("_id"), "left_semi").dropDuplicates(["_key"])
    return single.unionByName(folded).select("_row.*").unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, decided for each text."""
    rows = keyed(docs)
    found = decontaminate.leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "_key")
    gone = stored(found.select(F.col("_key").alias("_id")).distinct(), "leaks")
    return rows.join(sized(gone), F.col("_key") == F.col("_id"), "left_anti").select("_row.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    found = pii.detect(docs, redacted=True)
    length = F.length("redacted").cast(docs.schema["n_chars"].dataType)
    return found.withColumns({"text": F.col("redacted"), "n_chars": length}).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target share; ``copy`` numbers the repetitions."""
    return mixing.emit(docs)


STAGES = [
    ("toxicity", drop_toxic), ("near copies", drop_near_copies), ("benchmark", drop_leaks), ("personal data", redact), ("mixing", mix),
]

#: The stages draw on hashes, models and patterns that SQL does not express; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
