"""Dataset construction.

The corpus is the concatenation of documents in ``doc_id`` order. Global
positions come from an exclusive prefix sum over a *narrow* per-document table
(``operators.order``); only scalars (totals, the cut document) and per-document
offsets ever meet the wide rows.

Packed windows (W2) are cut from token arrays in order, partition by partition; a
partition gets the few tokens that follow it, so no window is put together by a shuffle. The
training order of windows (W5) is a keyed permutation of their numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import reliable_checkpoint
from .order import exclusive_prefix_sum


def check_window_args(context_length: int, stride: int) -> None:
    """Argument checks, before any planning."""
    if context_length < 1:
        raise ValueError(f"windows need at least one token, not {context_length}")
    if stride < 1:
        raise ValueError(f"window starts must advance by one token or more, not {stride}")


def check_val_ratio(val_ratio: float) -> None:
    if not 0.0 < val_ratio < 1.0:
        raise ValueError(f"the validation share is an open interval (0, 1) value, not {val_ratio}")


# --- W1 ---------------------------------------------------------------------
def contiguous_split(docs: DataFrame, val_ratio: float = K.VAL_RATIO, key="doc_id",
                     text_col="text") -> DataFrame:
    """Cut the concatenated corpus at ``int(total * (1 - val_ratio))`` characters.

    Returns ``(doc_id, split, text)`` with split 0 = train, 1 = validation; the
    document containing the cut appears on both sides. Only the narrow
    ``(doc_id, length)`` table is range-partitioned; the texts are read in one scan that
    compares the key with scalar subqueries (no shuffle of text)."""
    check_val_ratio(val_ratio)
    narrow = docs.select(key, F.length(text_col).alias("len"))
    pref = exclusive_prefix_sum(narrow, [key], "len", "offset")
    total = pref.select(F.sum("len")).scalar()  # of the written lengths: each action would read all texts for it
    cut = F.floor(total.cast("double") * F.lit(1.0 - val_ratio)).cast("bigint")
    at = pref.where((F.col("offset") <= cut) & (cut < F.col("offset") + F.col("len")))
    cut_doc = at.select(F.min(key)).scalar()
    cut_off = at.select(F.min("offset")).scalar()
    here = F.col(key) == cut_doc
    whole = F.when(F.col(key) > cut_doc, 1).otherwise(0)
    sides = F.when(here, F.array(
        F.struct(F.lit(0).alias("split"), F.substring(text_col, F.lit(1), cut - cut_off).alias("part")),
        F.struct(F.lit(1).alias("split"), F.substring(text_col, cut - cut_off + 1, F.lit(1 << 30)).alias("part")))).otherwise(
        F.array(F.struct(whole.alias("split"), F.col(text_col).alias("part"))))
    out = docs.select(key, F.explode(sides).alias("s")).select(key, "s.split", F.col("s.part").alias(text_col))
    return out.where(F.length(text_col) > 0)


# --- W2 / W3 -------------------------------------------------------------------
def packed_windows(encoded: DataFrame, context_length: int = K.CONTEXT_LENGTH,
                   stride: int = K.STRIDE, key="doc_id", ids_col="ids") -> DataFrame:
    """W2 + W3 over the one concatenated token stream: window k starts at
    ``k * stride`` for ``k * stride < N - ctx``; ``x`` = ctx tokens from the
    start, ``y`` = the same shifted by one. Returns (k, start, x, y). A stream without a window
    is an error (W4).

    The token arrays are put in order once (range partitions by key, written, so that encoding
    runs once). Each partition then cuts the windows that start in it, in one pass: all it
    needs from elsewhere is its place in the stream and a halo, the ctx tokens that follow it.
    Heads and lengths of the partitions (partitions x ctx ints) come to the driver for that."""
    check_window_args(context_length, stride)
    ctx = context_length
    spark = encoded.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = reliable_checkpoint(encoded.select(F.col(key).alias("key"), F.col(ids_col).cast("array<int>").alias("ids"))
                                 .repartitionByRange(parts, "key").sortWithinPartitions("key").select("ids"))

    def ends(batches):
        n, head = 0, np.zeros(0, np.int32)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            head = np.concatenate([head, flat[:ctx - len(head)]])
            n += len(flat)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64()),
                               pa.array([head], pa.list_(pa.int32()))], ["part", "n", "head"])

    found = {r["part"]: (r["n"], r["head"]) for r in stream.mapInArrow(ends, "part int, n bigint, head array<int>").collect()}
    total = sum(n for n, _ in found.values())
    if total < ctx + 1:
        raise ValueError(f"a stream of {total} tokens holds no window of {ctx} tokens and its target")
    first, halo, at = {}, {}, 0
    for p in sorted(found):
        first[p], at = at, at + found[p][0]
    after: list[int] = []
    for p in sorted(found, reverse=True):
        halo[p] = after
        after = (found[p][1] + after)[:ctx] if found[p][0] < ctx else found[p][1]
    shared = spark.sparkContext.broadcast((first, halo))

    def cut(batches):
        place = TaskContext.get().partitionId()
        own, following = shared.value[0][place], np.array(shared.value[1][place], np.int32)
        buffer, at = np.zeros(0, np.int32), own          # ``buffer`` holds the stream from ``at`` on

        def windows(end):
            """Windows that start in the buffer before ``end`` and lie in it."""
            nonlocal buffer, at
            lo = -(-at // stride)
            hi = min((end - 1) // stride, (at + len(buffer) - ctx - 1) // stride, (total - ctx - 1) // stride)
            for k in range(lo, hi + 1, 4096):
                ks = np.arange(k, min(k + 4096, hi + 1))
                places = (ks * stride - at)[:, None] + np.arange(ctx + 1)
                block = buffer[places]
                bounds = pa.array(np.arange(len(ks) + 1) * ctx, pa.int32())
                yield pa.record_batch([pa.array(ks), pa.array(ks * stride),
                                       pa.ListArray.from_arrays(bounds, pa.array(block[:, :-1].ravel())),
                                       pa.ListArray.from_arrays(bounds, pa.array(block[:, 1:].ravel()))], ["k", "start", "x", "y"])
            next_start = max(hi + 1, lo) * stride
            drop = min(max(next_start - at, 0), len(buffer))
            buffer, at = buffer[drop:], at + drop

        for batch in batches:
            buffer = np.concatenate([buffer, batch.column(0).flatten().to_numpy(zero_copy_only=False)])
            yield from windows(at + len(buffer))
        end = at + len(buffer)
        buffer = np.concatenate([buffer, following])
        yield from windows(end)

    return stream.mapInArrow(cut, "k bigint, start bigint, x array<int>, y array<int>")


def per_document_windows(encoded: DataFrame, context_length: int = K.CONTEXT_LENGTH,
                         stride: int = K.STRIDE, key="doc_id", ids_col="ids") -> DataFrame:
    """The same rule inside every row, no shuffle. Rows with at most ``ctx``
    tokens yield nothing (see :func:`short_documents`)."""
    check_window_args(context_length, stride)
    ctx = context_length
    n = F.size(ids_col)
    return (encoded.where(n > ctx)
            .select(key, ids_col, F.explode(F.sequence(F.lit(0), n - ctx - 1, F.lit(stride))).alias("start"))
            .select(key, "start", F.slice(ids_col, F.col("start") + 1, ctx).alias("x"),
                    F.slice(ids_col, F.col("start") + 2, ctx).alias("y")))


def short_documents(encoded: DataFrame, context_length: int = K.CONTEXT_LENGTH, key="doc_id",
                    ids_col="ids") -> DataFrame:
    """Rows too short for one sample (fewer than ctx + 1 tokens)."""
    return encoded.where(F.size(ids_col) < context_length + 1).select(key, F.size(ids_col).alias("n_tokens"))


def require_stream_length(encoded: DataFrame, context_length: int, ids_col="ids") -> int:
    """W4 for packed mode: the whole stream must hold ctx + 1 tokens."""
    n = encoded.agg(F.sum(F.size(ids_col))).first()[0] or 0
    if n < context_length + 1:
        raise ValueError(f"a stream of {n} tokens holds no window of {context_length} tokens and its target")
    return int(n)


# --- W5 ---------------------------------------------------------------------
def ordered_batches(windows: DataFrame, batch_size: int = K.BATCH_SIZE, drop_last: bool = False,
                    index_col="k") -> DataFrame:
    """W5 (validation order): batch = floor(index / size); drop_last keeps only
    full batches."""
    out = windows.withColumn("batch_id", F.floor(F.col(index_col) / batch_size).cast("bigint"))
    if drop_last:
        n = windows.select(F.count(F.lit(1))).scalar()
        out = out.where(F.col("batch_id") < F.floor(n / batch_size))
    return out


def permute(index: np.ndarray, size: int, seed: int, epoch: int) -> np.ndarray:
    """A permutation of 0 .. size - 1 for each (seed, epoch): a four-round Feistel network on the
    smallest even number of bits that holds the numbers, walked on until it is back in range."""
    half, keys = feistel_keys(size, seed, epoch)
    mask = (1 << half) - 1
    out = index.astype(np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for c, d in keys:
            left, right = right, left ^ ((((right + c) * (right ^ d)) >> (half // 2)) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= size]
    return out


def feistel_keys(size: int, seed: int, epoch: int) -> tuple[int, list[tuple[int, int]]]:
    """Bits of a half (30 at most) and two constants for each round."""
    half = max(2, (max(size - 1, 1).bit_length() + 1) // 2)
    if half > 30:
        raise ValueError("more than 2**60 windows")
    digest = hashlib.sha256(f"{seed}:{epoch}".encode()).digest()
    word = [int.from_bytes(digest[4 * i:4 * i + 4], "big") & ((1 << half) - 1) for i in range(8)]
    return half, [(word[2 * i], word[2 * i + 1] | 1) for i in range(4)]


def shuffled_batches(windows: DataFrame, seed: int, epoch: int, batch_size: int = K.BATCH_SIZE,
                     drop_last: bool = True, index_col="k", n_windows: int | None = None) -> DataFrame:
    """W5 (training order): adds ``batch_id`` and ``place`` (in the batch). The place of a window in the epoch is a keyed permutation of its number, so
    it is arithmetic beside the row: no sort, no shuffle, the same on any partitioning. Numbers
    are 0 .. ``n_windows`` - 1, each once (counted if not given)."""
    size = windows.count() if n_windows is None else n_windows

    def run(column: pa.Array) -> pa.Array:
        return pa.array(permute(column.to_numpy(zero_copy_only=False), size, seed, epoch))

    at = fresh_name(windows, "_at")
    out = windows.withColumn(at, F.arrow_udf(run, "bigint")(F.col(index_col).cast("bigint")))
    out = out.withColumns({"batch_id": F.floor(F.col(at) / batch_size).cast("bigint"), "place": (F.col(at) % batch_size).cast("int")})
    return (out.where(F.col("batch_id") < size // batch_size) if drop_last else out).drop(at)


def fresh_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


# --- W6 / W7 ----------------------------------------------------------------
def chars_per_token(encoded: DataFrame, text_col="text", ids_col="ids") -> DataFrame:
    return encoded.agg((F.sum(F.length(text_col)) / F.sum(F.size(ids_col))).alias("chars_per_token"))


def sample_counts(n_tokens_col, context_length: int, stride: int, batch_size: int, epochs: int,
                  drop_last: bool = True):
    """W7 as columns over a total token count."""
    n = n_tokens_col
    samples = F.when(n > context_length, F.floor((n - context_length - 1) / stride) + 1).otherwise(0)
    batches = F.floor(samples / batch_size) if drop_last else F.ceil(samples / batch_size)
    return samples.cast("bigint"), batches.cast("bigint"), (batches * epochs).cast("bigint")
