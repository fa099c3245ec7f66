"""Topics: JSON messages from and to any streaming format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def read_topic(
    spark: SparkSession, schema: T.StructType | str, format: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Stream of JSON messages; the source must have a ``value`` column, as Kafka and text have.

    A malformed message fails the query; a null one, as Kafka uses for deletions, gives no record.
    """
    stream = spark.readStream.format(format).options(**dict(options or {})).load()
    message = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
    return stream.where("value IS NOT NULL").select(message.alias("_message")).select("_message.*")


def write_topic(
    messages: DataFrame, checkpoint: str, format: str = "kafka", options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """Writer for a stream with a ``value`` column, for example the output of ``json_lines``."""
    writer = messages.select("value").writeStream.format(format).options(**dict(options or {}))
    return writer.option("checkpointLocation", checkpoint)
