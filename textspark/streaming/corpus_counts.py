"""Incremental chunk counts over arriving documents (Structured Streaming).

Documents land as Parquet files; every micro-batch explodes its chunks and
updates the running ``groupBy(chunk).count()`` state. No watermark is needed:
the state is the vocabulary of chunks, which the batch job holds as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bpe_chunks

#: Parts of micro-batches that are kept beside a snapshot.
COMPACT_EVERY = 8

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def chunk_count_stream(spark: SparkSession, source: str, schema: str = DOC_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.parquet(source)
    return docs.select(F.explode(bpe_chunks("text")).alias("chunk")).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("freq"))


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Finished parts below ``path``, by the number at the end of their names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return {int(n.split("=")[1]): f"{path}/{n}" for n in names if "=" in n
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))}


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run_to_table(counts: DataFrame, checkpoint_location: str, out_path: str, compact_every: int = COMPACT_EVERY) -> None:
    """Run until the available input is consumed. Each micro-batch writes its updated keys as a
    part of its own; a batch that is retried replaces its part. Every ``compact_every`` parts
    the counts are written as one snapshot, and the parts and the snapshot before it go, so there are
    never more than two snapshots and ``compact_every`` parts, each of at most one row for a
    key. A crash in between leaves parts that the snapshot covers; they are not read again."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out_path}/delta/epoch={epoch_id}")
        upto = max(_folders(spark, f"{out_path}/snapshot"), default=-1)
        parts = _folders(spark, f"{out_path}/delta")
        if sum(e > upto for e in parts) >= compact_every:
            latest_counts(spark, out_path).write.mode("overwrite").parquet(f"{out_path}/snapshot/upto={epoch_id}")
            for e, path in parts.items():
                if e <= epoch_id:
                    _remove(spark, path)
            for e, path in _folders(spark, f"{out_path}/snapshot").items():
                if e < epoch_id:
                    _remove(spark, path)

    q = (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint_location)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest count of every chunk: the last finished snapshot and the parts after it. No
    part at all gives no rows."""
    snapshots = _folders(spark, f"{out_path}/snapshot")
    upto = max(snapshots, default=-1)
    parts = {e: p for e, p in _folders(spark, f"{out_path}/delta").items() if e > upto} | (
        {upto: snapshots[upto]} if snapshots else {})
    rows = spark.createDataFrame([], "chunk string, freq bigint, epoch bigint")
    for epoch, path in sorted(parts.items()):
        rows = rows.unionByName(spark.read.schema("chunk string, freq bigint").parquet(path).withColumn("epoch", F.lit(epoch).cast("bigint")))
    return rows.groupBy("chunk").agg(F.max_by("freq", "epoch").alias("freq"))
