"""Corpus pipeline: rules, classifier, near-dedup, mixing, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All stages but the last return the columns of ``docs``; the last gives the sampled
encodings of what is left. Each is written before the next one reads it.

Rows with a null id go through: they cannot be named as copies; each is mixed as a row of its own.
Rows that repeat id and text wholly are one document from the near-dedup stage on, the
smallest of them by the columns in order. A mixed row is repeated as often as the mix takes
it. Null and empty texts go at the rules; texts of any length are taken whole. Ties: the
smallest id of a group of copies stays. Other columns pass through, whatever their names. Empty
input gives empty output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.llm.common import Scratch, fresh, small_batches, split_by_ids, table
from textspark.llm.divergence import judge_documents
from textspark.llm.entropy_balance import mix_in_place
from textspark.llm.gumbel_lattice import sample_encodings
from textspark.llm.lsh_forest import near_duplicates
from textspark.llm.subword_clf import fit_quality, score_texts

#: Least score of a document that stays.
KEEP_SCORE = 0.3
SAMPLES = 2
#: Bytes of text sampled at once: less than the default, as executors are full from the stages before.
CHUNK = 1 << 18


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = fresh(docs, "_judgement")
    return judge_documents(docs, out=verdict).where(F.col(verdict)["kept"]).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pull, bias = fit_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    score = fresh(docs, "_score")
    return score_texts(docs, pull, bias, "text", score).where(F.col(score) >= KEEP_SCORE).select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids that go (copies) and ids that repeat are few, so their rows are split off by a map of
    bits; all other texts stay where they are."""
    scratch = Scratch(spark, "dedup")
    gone = near_duplicates(docs, words=5).where("not kept and id is not null").select("id", F.lit(True).alias("gone"))
    twice = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count().where("count > 1")
    marks = scratch.save(gone.unionByName(twice.select("id", F.lit(False).alias("gone")))
                         .groupBy("id").agg(F.max("gone").alias("gone")), "marks")
    stay, marked = split_by_ids(docs, "doc_id", marks, "id", scratch)
    key, gone = fresh(docs, "_id"), fresh(docs, "_gone")
    marked = marked.join(marks.toDF(key, gone), F.col("doc_id") == F.col(key), "left")
    alone = marked.where(F.col(gone).isNull()).select(*docs.columns)
    # of rows with one id and text the smallest is kept, columns compared in order
    repeated = (marked.where(~F.col(gone)).groupBy(F.col("doc_id").alias(key), F.sha2(F.coalesce("text", F.lit("")), 256),
                                                   F.col("text").isNull())
                .agg(F.min(F.struct(*docs.columns)).alias(gone)).select(f"{gone}.*"))
    return stay.unionByName(alone).unionByName(repeated)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_in_place(docs)


def sentencepiece_samples(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = docs.select("doc_id", "text", F.crc32(F.translate(F.coalesce("text", F.lit("")), "▁", " ").cast("binary")).alias("plain"))
    rows = sample_encodings(texts, path, k=SAMPLES, keep=("plain",), decoded="decoded", chunk=CHUNK)
    return rows.select(F.col("id").alias("doc_id"), "sample", "ids", "log_prob", "inclusion", "log_inclusion",
                       (F.crc32(F.col("decoded").cast("binary")) == F.col("plain")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece_samples),
]

#: SQL can express neither the trained classifier nor the dual's solution.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.save(docs, name)
    return docs
