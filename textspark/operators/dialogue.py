"""Conversation operators.

A dialogue is kept as *line rows* ``(conv_id, idx, line)``, never as one
collected string: a conversation of any size stays spread over tasks. Exact
de-duplication compares conversations through a fingerprint built with
combinable aggregates (count, length sum and two independent 64-bit hash
XORs over ``(idx, line)``), so a group of copies holding a third of all rows is
reduced map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import clean_utterance, split_lines


# --- S2 / S3 ----------------------------------------------------------------
def lines_from_files(files: DataFrame, text_col="text", key_cols=("split_ord",)) -> DataFrame:
    """Whole-text files -> (keys..., line_no, line) with Python splitlines rules."""
    return files.select(*key_cols, F.posexplode(split_lines(text_col)).alias("line_no", "line"))


def union_splits(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """S3: three line tables in fixed order; order key is (split_ord, line_no)."""
    parts = [df.withColumn("split_ord", F.lit(i)) for i, df in enumerate((train, validation, test))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def parse_dialogue_lines(lines: DataFrame, line_col="line") -> DataFrame:
    """One conversation per line; turns split at the separator, cleaned,
    blanks dropped, conversations with fewer than two turns dropped.
    Returns the input keys plus ``turns array<string>``."""
    turns = F.filter(F.transform(F.split(F.col(line_col), K.TURN_SEPARATOR), clean_utterance),
                     lambda t: t != "")
    keys = [c for c in lines.columns if c != line_col]
    return lines.select(*keys, turns.alias("turns")).where(F.size("turns") >= 2)


def turn_rows(parsed: DataFrame, key_cols=("split_ord", "line_no")) -> DataFrame:
    """Array form -> row form ``(keys..., idx, text)``."""
    return parsed.select(*key_cols, F.posexplode("turns").alias("idx", "text"))


# --- D1 / D2 ----------------------------------------------------------------
def clean_turns(turns: DataFrame, text_col="text") -> DataFrame:
    return turns.withColumn(text_col, clean_utterance(text_col))


def drop_blank_turns(turns: DataFrame, text_col="text") -> DataFrame:
    """Turns that are empty after cleaning go."""
    return turns.where(F.col(text_col) != "")


def min_turns_filter(turns: DataFrame, conv_col="conv_id", min_turns: int = 2) -> DataFrame:
    """Keep conversations with at least ``min_turns`` turns (count per
    conversation via partial aggregation, then a semi join)."""
    keep = turns.groupBy(conv_col).agg(F.count(F.lit(1)).alias("n_turns")).where(
        F.col("n_turns") >= min_turns)
    return turns.join(keep.select(conv_col), conv_col, "left_semi")


# --- D3 ---------------------------------------------------------------------
def format_dialogue(turns: DataFrame, conv_col="conv_id", order_col="turn", text_col="text") -> DataFrame:
    """D3: ``(conv, idx, line)`` with ``User:``/``Bot:`` by index parity of the
    kept turns (first speaker is always User)."""
    idx = F.row_number().over(Window.partitionBy(conv_col).orderBy(order_col)) - 1
    t = turns.withColumn("idx", idx)
    prefix = F.when(F.col("idx") % 2 == 0, F.lit(K.CHAT_USER_PREFIX)).otherwise(F.lit(K.CHAT_BOT_PREFIX))
    return t.select(conv_col, F.col("idx").cast("bigint").alias("idx"),
                    F.concat(prefix, F.lit(" "), F.col(text_col)).alias("line"))


def block_strings(lines: DataFrame, conv_col="conv_id") -> DataFrame:
    """Convenience view for bounded conversations: one ``block`` string each."""
    return lines.groupBy(conv_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))),
                                 lambda s: s["line"]), "\n").alias("block"))


# --- D4 ---------------------------------------------------------------------
def conversation_fingerprints(lines: DataFrame, conv_col="conv_id") -> DataFrame:
    """Per conversation: (n_lines, n_chars, h1, h2), all combinable aggregates."""
    return lines.groupBy(conv_col).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("line")).alias("n_chars"),
        F.bit_xor(F.xxhash64("idx", "line")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit("fp2"), "line", "idx")).alias("h2"),
    )


def dedup_conversations(lines: DataFrame, order_cols, conv_col="conv_id") -> tuple[DataFrame, DataFrame]:
    """D4 on dialogues: keep the first of every set of identical conversations.

    ``order_cols`` gives the corpus order of a conversation (e.g. split_ord,
    line_no). Returns (kept lines, kept conversations with their copy count)."""
    order_cols = [c for c in order_cols if c != conv_col]
    fp = conversation_fingerprints(lines, conv_col)
    if order_cols:
        fp = fp.join(lines.select(conv_col, *order_cols).distinct(), conv_col)
    ord_struct = F.struct(*order_cols, conv_col)
    kept = (fp.groupBy("n_lines", "n_chars", "h1", "h2")
            .agg(F.min(ord_struct).alias("first"), F.count(F.lit(1)).alias("copies"))
            .select(F.col(f"first.{conv_col}").alias(conv_col), "copies",
                    *[F.col(f"first.{c}").alias(c) for c in order_cols]))
    return lines.join(kept.select(conv_col), conv_col, "left_semi"), kept


def dedup_texts(docs: DataFrame, key_col="doc_id", text_col="text") -> DataFrame:
    """D4 on single-row texts: group by a 256-bit digest (not the text itself, so
    the shuffle carries 32 bytes a row); keep the smallest key of each group."""
    return (docs.groupBy(F.sha2(F.col(text_col), 256).alias("digest"))
            .agg(F.min(key_col).alias(key_col), F.count(F.lit(1)).alias("copies"))
            .select(key_col, F.col("copies").cast("bigint")))


# --- D5 / D6 ----------------------------------------------------------------
def corpus_lines(lines: DataFrame, conv_order_col: str, conv_col="conv_id") -> DataFrame:
    """Rows in file order ``(conv, conv_ord, idx, line)``. An empty line opens
    every conversation but the first (idx -1), so writing each row followed by
    "\\n" gives ``"\\n\\n".join(blocks) + "\\n"``. The first conversation is
    found with a scalar subquery, not a global window."""
    first = lines.select(F.min(conv_order_col)).scalar()
    blanks = (lines.select(conv_col, conv_order_col).distinct()
              .where(F.col(conv_order_col) > first)
              .select(conv_col, conv_order_col, F.lit(-1).cast("bigint").alias("idx"),
                      F.lit("").alias("line")))
    return lines.select(conv_col, conv_order_col, F.col("idx").cast("bigint"), "line").unionByName(blanks)


def corpus_summary(lines: DataFrame, kept: DataFrame, conv_col="conv_id") -> DataFrame:
    """Conversations, duplicates removed, characters and newlines of the
    assembled corpus, from per-line lengths (the corpus string is never built).
    ``kept`` is ``(conv, copies)`` from :func:`dedup_conversations`."""
    per_conv = lines.groupBy(conv_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("c"))
    agg = per_conv.join(kept.select(conv_col, "copies"), conv_col).agg(
        F.count(F.lit(1)).alias("conversations"), F.sum(F.col("copies") - 1).alias("duplicates"),
        F.sum("c").alias("c"), F.sum("n").alias("n"))
    newlines = (F.col("n") - F.col("conversations")) + 2 * (F.col("conversations") - 1) + 1
    return agg.select(
        F.col("conversations").cast("bigint"),
        F.col("duplicates").cast("bigint"),
        (F.col("c") + newlines).cast("bigint").alias("characters"),
        newlines.cast("bigint").alias("lines"),
    )
