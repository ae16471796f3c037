"""Vocabularies (V1-V3, V8-V9) as ``(token string, id int)`` tables.

Ids follow code-point order of the tokens (Spark compares strings by UTF-8
bytes, which is code-point order), after the reserved tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import char_split, word_split
from .order import global_index


def _specials(spark: SparkSession, tokens: list[str]) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, id int")


def vocab_from_tokens(distinct_tokens: DataFrame, specials: list[str]) -> DataFrame:
    """specials (ids 0..k-1) + sorted distinct tokens (ids k..)."""
    spark = distinct_tokens.sparkSession
    indexed = global_index(distinct_tokens.select("token"), ["token"], "id")
    ranked = indexed.select("token", (F.col("id") + len(specials)).cast("int").alias("id"))
    return _specials(spark, specials).unionByName(ranked)


def char_vocab(docs: DataFrame, text_col="text") -> DataFrame:
    """V1: ``<unk>`` = 0, then the sorted distinct lowercased characters."""
    # de-duplicate inside each row first: a few dozen rows per document reach
    # the aggregate instead of every character
    chars = docs.select(F.explode(F.array_distinct(char_split(F.lower(F.col(text_col))))).alias("token")).distinct()
    return vocab_from_tokens(chars, [K.UNK_TOKEN])


def word_vocab(docs: DataFrame, text_col="text") -> DataFrame:
    """V2: four reserved tokens, then the sorted distinct words."""
    words = docs.select(F.explode(F.array_distinct(word_split(text_col))).alias("token")).distinct()
    return vocab_from_tokens(words, K.SPECIAL_TOKENS)


def base_symbols(chunk_freqs: DataFrame, chunk_col="chunk") -> DataFrame:
    """V3: distinct characters of all chunks, case kept."""
    return chunk_freqs.select(F.explode(F.array_distinct(char_split(chunk_col))).alias("token")).distinct()


def bpe_vocab(base: DataFrame, merges: DataFrame) -> DataFrame:
    """V8: 4 reserved + sorted(base characters U every merge output)."""
    outs = merges.select(F.concat("a", "b").alias("token"))
    return vocab_from_tokens(base.select("token").unionByName(outs).distinct(), K.SPECIAL_TOKENS)


def vocab_size(vocab: DataFrame) -> DataFrame:
    """V9: number of entries."""
    return vocab.agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"))
