"""Proportional stratified interleaving into shards (dealt operator 7, native).

Rows of each source are shuffled by a seeded hash; a row's fractional rank is
``(rank + 1/2) / rows of its source``. Sorting all rows by it interleaves the sources in
proportion, so each contiguous cut holds the mixture of the whole; row number p of N goes to
shard ``p * shards div N`` (law ``rows``: counts at most one apart).

Neither order uses a window over a source or over the table: rows are range partitioned and
sorted, ``monotonically_increasing_id`` numbers them within their partition, and the offset of
each partition is a prefix sum over one row per partition. A source with a third of all rows is
spread over a third of the partitions. Only ids, sources and sizes are moved, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Low bits of ``monotonically_increasing_id`` that count rows within a partition (fixed by Spark).
ROW_BITS = 33


def shuffle_key(id_col: Column, seed: int) -> Column:
    """60 bits of md5("seed:id"); a null id hashes as "null"."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def global_index(df: DataFrame, order: list[str], index: str, scratch: Scratch) -> DataFrame:
    """``df`` with the row's number from 0 in the order of the given columns."""
    at = F.monotonically_increasing_id()
    rows = scratch.save(df.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_at", at), index)
    part = F.shiftright("_at", ROW_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    # one row per partition of the range shuffle, whatever the input's size
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(index, F.col("_before") + F.col("_at") - F.shiftleft("_part", ROW_BITS))
            .drop("_part", "_before", "_at"))


def stratified_shards(docs: DataFrame, shards: int = 40, seed: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and ``source`` for each row.

    Size: UTF-8 bytes of the text plus 16 (null text: 16, and the checksum of no bytes). A null
    source is a source of its own, after the others. Null ids sort first; repeated rows are
    rows of their own, and ties of the seeded key are broken by id, size and checksum. An empty
    table gives no rows; fewer rows than shards leave shards empty. Other columns are not read."""
    scratch = Scratch(docs.sparkSession, "shards")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        shuffle_key(F.col(id_col), seed).alias("key"))
    rest = ["key", "doc_id", "size", "text_crc32"]
    by_source = global_index(rows, ["no_source", "source", *rest], "at", scratch)
    sources = scratch.save(by_source.groupBy("no_source", "source")
                           .agg(F.count("*").alias("n"), F.min("at").alias("first")), "sources")
    ranked = by_source.join(sources, ["no_source", "source"]).withColumn(
        "frac", (2 * (F.col("at") - F.col("first")) + 1).cast("double") / (2 * F.col("n")).cast("double"))
    mixed = global_index(ranked.drop("at", "first", "n"), ["frac", "no_source", "source", *rest], "at", scratch)
    total = mixed.agg(F.count("*").alias("total"))  # one row
    shard = F.expr(f"at * {shards} div total")
    return (mixed.crossJoin(F.broadcast(total)).withColumn("shard", shard)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    F.expr(f"at - (shard * total + {shards - 1}) div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"),
                    F.when(~F.col("no_source"), F.col("source")).alias("source")))
