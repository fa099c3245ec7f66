"""Session defaults the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "meterflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC times and adaptive execution; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
