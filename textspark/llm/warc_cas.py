"""Content-addressed WARC archive (dealt operator 9).

An archive is a folder of two tables:

- ``payloads``: each distinct payload once, under its SHA-256; bytes that share the key must
  agree in length and SHA-1, or the write fails;
- ``headers``: the exact header block of every record, with the key of its payload.

Reading joins the two, recomputes the SHA-256 and the header's SHA-1 of every payload (a
mismatch fails the job) and gives the records back byte for byte. Everything is DataFrame
functions; a payload with a third of all records is one row of the store, and the joins read
written tables, so Spark can split its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

CRLF = "\r\n"
#: Alphabet of RFC 4648 (fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Profile of records that repeat a payload (fixed value of the WARC 1.1 standard).
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"


def base32_of_hex(hex40: Column) -> Column:
    """Bare upper-case base32 of 160 bits given as 40 hex digits (5 digits are 4 letters)."""
    def letter(i):
        bits = F.conv(F.substring(hex40, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        value = F.call_function("shiftright", bits, 15 - 5 * (i % 4)).bitwiseAND(31)
        return F.substring(F.lit(BASE32), value + 1, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def payload_digest(payload: Column) -> Column:
    return let(F.sha1(payload), base32_of_hex)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row. Of records with equal payloads of at least ``min_bytes``
    bytes, that with the largest id is the response and the others revisit it.

    A null payload is empty. A null url gives a record without target; control characters
    and spaces of a url are percent-encoded, so a header stays one line per field. A row with
    a null id revisits like any other, and is a response if no equal payload has an id. Rows
    that repeat the largest id are responses too. Other columns are not read."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = (pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"))
            .withColumn("sha256", F.sha2("payload", 256)))
    same = (F.min("sha1") == F.max("sha1")) & (F.min("n") == F.max("n"))
    (rows.select("sha256", "payload", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n"))
     .groupBy("sha256").agg(F.first("payload").alias("payload"), same.alias("same"))
     .select("sha256", F.when(F.col("same"), F.col("payload"))
             .otherwise(F.raise_error(F.lit("two payloads share a SHA-256"))).alias("payload"))
     .write.parquet(f"{path}/payloads"))

    (rows.select("page_id", "url", "sha256", payload_digest(F.col("payload")).alias("digest"),
                 F.octet_length("payload").cast("bigint").alias("n")).write.parquet(f"{path}/records"))
    spark = pages.sparkSession
    records = spark.read.parquet(f"{path}/records")
    records.groupBy("sha256").agg(F.max("page_id").alias("first_id")).write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")

    revisit = (F.col("n") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    unsafe = r"[\x00-\x20\x7f]"
    percent = F.array_join(F.transform(F.split("url", ""), lambda c: F.when(
        c.rlike(unsafe), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")
    encoded = F.when(F.col("url").rlike(unsafe), percent).otherwise(F.col("url"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def urn(c):
        return F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    header = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", encoded), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", urn("first_id"))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))), F.lit(CRLF))
    (records.join(index, "sha256").select(header.cast("binary").alias("header"), "sha256")
     .write.parquet(f"{path}/headers"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``header, payload, record`` (binary) of every record: the exact header block, the whole
    payload (also of revisits) and the record's own bytes. Fails on any wrong digest."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    both = headers.join(payloads, "sha256", "left")
    text = F.col("header").cast("string")
    digest = F.regexp_extract(text, r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n", 1)
    good = (F.sha2("payload", 256) == F.col("sha256")) & (payload_digest(F.col("payload")) == digest)
    checked = F.when(F.coalesce(good, F.lit(False)), F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload is missing or differs from its digest")))
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return both.select("header", checked.alias("payload")).select(
        "header", "payload", F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"))


def field(name: str) -> Column:
    """A field of the column ``header``; empty if the header has none of that name."""
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)


def page_number(name: str) -> Column:
    return F.regexp_extract(field(name), rf"^<{_URN}(-?[0-9]+)>$", 1).try_cast("bigint")


def export_warc(records: DataFrame, path: str) -> None:
    """The records as plain WARC files, one after another (each partition one file)."""
    # a record ends with two line breaks; the last byte is left to the writer of lines
    body = F.expr("substring(record, 1, octet_length(record) - 1)").cast("string")
    records.select(body).write.option("lineSep", "\n").text(path)
