"""Loading a corpus.

A corpus is a DataFrame ``(doc_id bigint, text string)`` whose global order is
``doc_id``. Plain text files become one row a line; a missing path raises Spark's
``AnalysisException``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import global_index
from .tables import documents


def load_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text``: the lines of all files below ``path`` (ends of lines are "\n" alone), numbered
    from 0 in the order of file paths and of places in a file. A large file is read in byte
    ranges of ``spark.sql.files.maxPartitionBytes``, each by a task of its own; a line belongs to the
    range that it begins in. Lines are numbered by file, start of the range and place in it, so
    ranges may be read in any order."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    return global_index(lines, ["path", "start", "at"], "doc_id").select("doc_id", "text")


def load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "doc_id", "text")


def corpus_stats(docs: DataFrame) -> DataFrame:
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"),
        F.min("doc_id").cast("bigint").alias("first_doc"),
        F.max("doc_id").cast("bigint").alias("last_doc"),
    )
