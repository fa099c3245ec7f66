"""Content-addressed WARC archive: payload bytes once by digest, exact record headers beside them.

``write_archive`` stores two tables below a folder: ``headers`` with the header block of every record as bytes, and
``payloads`` with each distinct payload once under its SHA-1. Two payloads of one SHA-1 but another SHA-256 fail the
job. ``read_archive`` joins them, verifies every payload against its address and rebuilds the records byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import sized, stored

# fixed values: line end, the alphabet of base 32, the profile of revisits to equal payloads, the records' date
CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are four groups of eight digits."""
    text = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(text, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _header(page: Column, url: Column, kind: Column, digest: Column, size: Column, refers: Column) -> Column:
    def line(name: str, value: Column) -> Column:
        # a line that has no value is left out
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    revisit = kind == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind), line("WARC-Record-ID", _record_id(page)), line("WARC-Date", F.lit(DATE)),
        # control characters would end the line
        line("WARC-Target-URI", F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), line("WARC-Refers-To", F.when(revisit, _record_id(refers))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))), F.lit(CRLF)).cast("binary")


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> None:
    """Writes one record for each row: a response, or a revisit of the smallest id with an equal payload.

    Payloads below ``least`` bytes are responses every time, yet stored once. A null payload is empty; a null id comes
    after all others, and rows with it are responses only where no other row has the payload; rows that repeat an id and
    a payload repeat its record. A null url has no header line, line ends in one are percent-encoded. The payloads are
    written by the row of the smallest id: no shuffle carries them.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    index = stored(rows.select("page", "url", "digest", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("check")), "index")
    keepers = index.groupBy("digest").agg(F.min("page").alias("keeper"), F.min("check").alias("low"), F.max("check").alias("high"))
    clash = F.raise_error(F.concat(F.lit("two payloads have the SHA-1 "), F.col("digest")))
    keepers = keepers.select("digest", F.when(F.col("low") == F.col("high"), F.col("keeper")).otherwise(clash.cast("long")).alias("keeper"))
    index = stored(index.join(keepers, "digest").withColumn("own", F.col("page").eqNullSafe(F.col("keeper"))), "records")
    revisit = ~F.col("own") & (F.col("size") >= least)
    kind = F.when(revisit, "revisit").otherwise("response")
    index.select(
        "digest", _header(F.col("page"), F.col("url"), kind, F.col("digest"), F.col("size"), F.col("keeper")).alias("header"),
    ).write.parquet(f"{folder}/headers")
    # rows that do not write their payload; of rows repeating the smallest id one payload is kept
    others = index.where(~F.col("own")).select(F.col("page").alias("_page"), F.col("digest").alias("_digest")).distinct()
    repeated = index.where("own").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("_digest"))
    first = rows.join(sized(others), (F.col("digest") == F.col("_digest")) & F.col("page").eqNullSafe(F.col("_page")), "left_anti")
    repeated = sized(stored(repeated, "repeated"))
    once = first.join(repeated, F.col("digest") == F.col("_digest"), "left_anti").select("digest", "payload")
    folded = first.join(repeated, F.col("digest") == F.col("_digest"), "left_semi").groupBy("digest").agg(F.min("payload").alias("payload"))
    once.unionByName(folded).write.option("compression", "zstd").parquet(f"{folder}/payloads")


def _value(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, f"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def _page(value: Column) -> Column:
    number = F.regexp_extract(value, "^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number.cast("long"))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records: what their headers say, the full payload, and the record's exact bytes.

    ``page_id, url, record_type, payload_digest, refers_to, content_length, payload, record``; a payload that does not
    hash to its address, or is missing, fails the job.
    """
    headers = spark.read.schema("digest string, header binary").parquet(f"{folder}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    rows = headers.join(payloads.withColumnRenamed("digest", "_address"), F.col("digest") == F.col("_address"), "left")
    broken = F.raise_error(F.concat(F.lit("no valid payload for "), F.col("digest"))).cast("binary")
    rows = rows.withColumn("payload", F.when(base32_sha1(F.col("payload")) == F.col("digest"), F.col("payload")).otherwise(broken))
    text = F.decode("header", "utf-8")
    kind = _value(text, "WARC-Type")
    end = F.lit(CRLF + CRLF).cast("binary")
    return rows.select(
        _page(_value(text, "WARC-Record-ID")).alias("page_id"), _value(text, "WARC-Target-URI").alias("url"), kind.alias("record_type"),
        F.regexp_extract(_value(text, "WARC-Payload-Digest"), "^sha1:([A-Z2-7]{32})$", 1).alias("payload_digest"),
        _page(_value(text, "WARC-Refers-To")).alias("refers_to"), _value(text, "Content-Length").cast("long").alias("content_length"),
        "payload", F.when(kind == "revisit", F.concat("header", end)).otherwise(F.concat("header", "payload", end)).alias("record"))
