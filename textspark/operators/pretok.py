"""Pre-tokenization.

Pieces are produced per document with ``regexp_extract_all`` and counted with a
plain ``groupBy``: Spark plans a partial (map-side) hash aggregate before the
shuffle, so a piece that makes up a third of the corpus (" ", " the") ships one
partial count per map task, never its occurrences.

Where BPE chunks are only counted or encoded, tasks cut the texts of an Arrow batch at once
(:func:`cut_chunks`): chunks cover a text, so they are its bytes with other bounds, and the
bounds follow from the class (word, space, other) of a character and its neighbours. The
classes are those of the same pattern, read off it once (:func:`char_classes`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import S, W
from ..functions.text import bpe_chunks, char_split, word_split

#: Characters, chunks or ids of a batch that a task works on at once (a single row may have more).
SLICE_VALUES = 1 << 20
#: Rows of partial counts that a task adds up before it hands them on.
COUNT_ROWS = 1 << 20
SPACE = ord(" ")


@lru_cache(maxsize=None)
def char_classes(spark) -> np.ndarray:
    """The class of every code point in the chunk pattern: ``w`` word, space, ``!`` other."""
    step = 1 << 11                                             # the surrogates are one step
    rows = [(i, "".join(map(chr, range(i, i + step)))) for i in range(0, 0x110000, step) if i != 0xD800]
    marked = F.regexp_replace(F.col("chars"), rf"(?U)[^{W}{S}]", "!")
    marked = F.regexp_replace(F.regexp_replace(marked, rf"(?U)[{W}]", "w"), rf"(?U)[{S}]", " ")
    out = np.full(0x110000, ord("!"), np.uint8)
    for r in spark.createDataFrame(rows, "first int, chars string").select("first", marked.alias("marks")).collect():
        out[r["first"]:r["first"] + step] = np.frombuffer(r["marks"].encode("ascii"), np.uint8)
    return out


def _valid(column: pa.Array) -> pa.Array:
    """The column with malformed UTF-8 as U+FFFD, as the JVM reads it."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        return pa.array([b if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()], pa.string())


def cut_chunks(column: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """P1 on a column of texts: the chunks, one after the other, and the bounds of its rows in them (null: none).

    A chunk begins at a text's start, where the class changes (but a blank goes with the word or
    the other characters behind it), and at the last of several spaces before such characters."""
    column = _valid(column)
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.append(0, np.cumsum(size))                       # rows in bytes
    data = b"".join(column.drop_null().cast(pa.binary()).to_pylist())
    if not data:
        return pa.array([], pa.string()), np.zeros(len(ends), np.int64)
    if data.isascii():
        points, rows, at = np.frombuffer(data, np.uint8), ends, None
    else:
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)     # first byte of each character
        rows = np.searchsorted(at, ends)
    kind = classes[points]
    space = kind == SPACE
    begins = np.ones(len(points), bool)
    begins[1:] = (kind[1:] != kind[:-1]) & ((points[:-1] != SPACE) | space[1:])
    begins[:-1] |= space[:-1] & ~space[1:]
    first = rows[:-1][np.diff(rows) > 0]
    last = first[1:] - 1                                       # of the texts but the last one
    alone = space[last] & ~space[last + 1]                     # a space at a text's end belongs to its run
    begins[last[alone]] = (kind[last[alone] - 1] != SPACE) | (last[alone] == 0)
    begins[first] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts if at is None else at[starts], len(data)).astype(np.int32)
    chunks = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return chunks, np.searchsorted(starts, rows)


def row_slices(column: pa.Array, lengths: pa.Array) -> Iterator[pa.Array]:
    """The column in stretches of rows whose ``lengths`` add up to ``SLICE_VALUES`` at most (or of one row)."""
    upto = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(upto):
        end = max(int(np.searchsorted(upto, done + SLICE_VALUES, "right")), at + 1)
        yield column.slice(at, end - at)
        at, done = end, int(upto[end - 1])


def explode_pieces(df: DataFrame, pieces, key_cols=("doc_id",), name="chunk") -> DataFrame:
    """One row per piece with its position inside the row: (keys..., pos, piece)."""
    return df.select(*key_cols, F.posexplode(pieces).alias("pos", name))


def chunk_occurrences(docs: DataFrame, text_col="text", key_cols=("doc_id",)) -> DataFrame:
    """BPE pre-tokenizer chunks, one row per occurrence."""
    return explode_pieces(docs, bpe_chunks(text_col), key_cols, "chunk")


def word_occurrences(docs: DataFrame, text_col="text", key_cols=("doc_id",)) -> DataFrame:
    """Lowercased word/punctuation tokens, one row per occurrence."""
    return explode_pieces(docs, word_split(text_col), key_cols, "word")


def char_occurrences(docs: DataFrame, text_col="text", key_cols=("doc_id",), lower=True) -> DataFrame:
    """One row per code point (lowercased for the char tokenizer)."""
    c = F.lower(F.col(text_col)) if lower else F.col(text_col)
    return explode_pieces(docs, char_split(c), key_cols, "ch")


def piece_frequencies(docs: DataFrame, pieces, name: str = "chunk") -> DataFrame:
    """(piece, freq) for every distinct piece; partial + final hash aggregate."""
    return (docs.select(F.explode(pieces).alias(name))
            .groupBy(name).agg(F.count(F.lit(1)).alias("freq")))


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("chunk").aggregate([("n", "sum")]).rename_columns(["chunk", "n"])


def chunk_frequencies(docs: DataFrame, text_col="text") -> DataFrame:
    """P4 of BPE chunks. Tasks count the chunks of their texts by themselves (at most ``COUNT_ROWS`` at a
    time), so that not the occurrences but their distinct values enter the aggregate."""
    shared = docs.sparkSession.sparkContext.broadcast(char_classes(docs.sparkSession))

    def run(batches):
        parts, rows = [], 0
        for batch in batches:
            for texts in row_slices(batch.column(0), pc.binary_length(batch.column(0))):
                coded = cut_chunks(texts, shared.value)[0].dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                parts.append(pa.table({"chunk": coded.dictionary, "n": n}))
                rows += len(n)
                if rows > COUNT_ROWS:
                    parts = [_added(parts)]
                    rows = parts[0].num_rows
                    if rows > COUNT_ROWS // 2:
                        yield from parts.pop().to_batches()
                        rows = 0
        if parts:
            yield from _added(parts).to_batches()

    text = F.col(text_col) if isinstance(text_col, str) else text_col
    found = docs.select(text.cast("string").alias("text")).mapInArrow(run, "chunk string, n bigint")
    return found.groupBy("chunk").agg(F.sum("n").alias("freq"))


def word_frequencies(docs: DataFrame, text_col="text") -> DataFrame:
    return piece_frequencies(docs, word_split(text_col), "word")


def top_chunks(freqs: DataFrame, n: int = 100, name: str = "chunk") -> DataFrame:
    """Top-n report by (freq desc, piece); planned as TakeOrderedAndProject."""
    return freqs.orderBy(F.col("freq").desc(), F.col(name)).limit(n)
