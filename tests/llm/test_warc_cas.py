"""Content-addressed archive: exact round trip, revisits, verification."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from textspark.llm.common import Scratch
from textspark.llm.warc_cas import export_warc, field, page_number, payload_digest, read_archive, write_archive

PAGES = [(1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, "http://a/3", "same"), (2, "http://b/\r\nX: y z", "é\r\n\r\nWARC/1.1\r\n"),
         (4, None, None), (6, "u", ""), (7, "u", "x" * 300_000), (None, "n", "same"), (None, "n", "only null"), (8, "r", "twice"),
         (8, "r", "twice"), (-9, "neg", "n")]


def archive(spark, rows, **options):
    path = Scratch(spark, "warc").path("archive")
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, sha256 string")
    write_archive(df, path, **options)
    return path


def summary(spark, path):
    out = read_archive(spark, path).select(
        page_number("WARC-Record-ID").alias("id"), field("WARC-Type").alias("kind"), page_number("WARC-Refers-To").alias("to"),
        payload_digest(F.col("payload")).alias("digest"), F.octet_length("payload").alias("n"))
    return sorted(tuple(r) for r in out.collect() if r.id is not None), sum(r.id is None for r in out.collect())


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_records(spark):
    path = archive(spark, PAGES)
    got, nulls = summary(spark, path)
    want = [(1, "revisit", 5, "same"), (3, "revisit", 5, "same"), (5, "response", None, "same"), (2, "response", None, PAGES[3][2]),
            (4, "revisit", 6, ""), (6, "response", None, ""), (7, "response", None, "x" * 300_000),
            (8, "response", None, "twice"), (8, "response", None, "twice"), (-9, "response", None, "n")]
    assert got == sorted((i, k, t, digest(x), len(x.encode())) for i, k, t, x in want) and nulls == 2
    assert spark.read.parquet(f"{path}/payloads").count() == 7  # each distinct payload once


def test_bytes_come_back(spark):
    path = archive(spark, PAGES[:7])
    rows = {r.id: r for r in read_archive(spark, path).select(page_number("WARC-Record-ID").alias("id"), "*").collect()}
    for i, _, html in PAGES[:7]:
        r = rows[i]
        head, body = bytes(r.header), (html or "").encode()
        assert bytes(r.payload) == body and head.startswith(b"WARC/1.1\r\n") and head.endswith(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head[:-4].split(b"\r\n")[1:])
        revisit = lines[b"WARC-Type"] == b"revisit"
        assert lines[b"Content-Length"] == (b"0" if revisit else str(len(body)).encode())
        assert bytes(r.record) == head + (b"" if revisit else body) + b"\r\n\r\n"
    assert b"WARC-Target-URI: http://b/%0D%0AX:%20y%20z\r\n" in bytes(rows[2].header)
    assert b"WARC-Target-URI" not in bytes(rows[4].header)
    out = Scratch(spark, "warc").path("files")
    export_warc(read_archive(spark, path), out)
    total = spark.read.format("binaryFile").load(f"{out}/part-*").agg(F.sum("length")).first()[0]
    assert total == sum(len(bytes(r.record)) for r in rows.values())


def test_small_payloads_empty_table_and_damage(spark):
    got, _ = summary(spark, archive(spark, PAGES[:3] + PAGES[4:6], min_bytes=4))
    assert [g[:3] for g in got] == [(1, "revisit", 5), (3, "revisit", 5), (4, "response", None), (5, "response", None), (6, "response", None)]
    assert summary(spark, archive(spark, [])) == ([], 0)
    path = archive(spark, PAGES[:2])
    payloads = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other"))
    payloads.coalesce(1).collect()
    bad = Scratch(spark, "warc").path("bad")
    payloads.write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{bad}/headers")
    with pytest.raises(Exception, match="differs from its digest"):
        read_archive(spark, bad).collect()


def test_oracle(spark, sf_dir):
    from textspark.llm.queries import ORACLE, QUERIES
    from textspark.plans.oracle_check import compare, duck_connection
    name = "op9_warc_cas"
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], duck_connection(sf_dir))
    assert r["ok"], r
