"""Writers for metric frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterflow.operators.batches import DEFAULT_RATE, rows_per_batch
from meterflow.sinks.formats import documents, json_lines

Writer = Callable[[DataFrame, str], None]


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", **options) -> int:
    """Write JSON lines; returns the number of lines."""
    return write_text(json_lines(df, **options), path, mode)


def write_documents(df: DataFrame, path: str, ts_field: str | None = None, mode: str = "overwrite") -> int:
    """Write one JSON document per metric; returns their number."""
    return write_text(documents(df, ts_field), path, mode)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write the ``value`` column as text, counting rows on the way.

    The commit of a Spark write is all or nothing, so a successful write holds every row counted.
    """
    seen = Observation()
    df.select("value").observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).text(path)
    return int(seen.get["n"])


def lines_to(path: str, **options) -> Writer:
    """Writer of JSON lines, one folder per run key, replaced when the same run is repeated."""
    return lambda df, run: write_lines(df, f"{path}/run={run}", **options) and None


def documents_to(path: str, ts_field: str | None = None) -> Writer:
    """Writer of documents, one folder per run key, replaced when the same run is repeated."""
    return lambda df, run: write_documents(df, f"{path}/run={run}", ts_field) and None


def table_to(path: str, format: str = "parquet") -> Writer:
    """Writer of the frame itself, one folder per run key."""
    return lambda df, run: df.write.mode("overwrite").format(format).save(f"{path}/run={run}")


def send_batches(df: DataFrame, send: Callable[[list[str]], None], size: int | str = DEFAULT_RATE) -> None:
    """Hand the ``value`` texts to ``send`` in lists of at most ``size``, on the executors.

    Each task sends its own rows; a repeated task sends them again, so ``send`` should be
    idempotent. Pauses between batches are left to ``send``.
    """
    rows_at_once = rows_per_batch(size)

    def partition(rows: Iterator) -> None:
        values = (row["value"] for row in rows)
        while batch := list(islice(values, rows_at_once)):
            send(batch)

    df.select("value").foreachPartition(partition)
