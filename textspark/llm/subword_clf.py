"""Quality classifier on learned subword embeddings (dealt operator 4).

A text is three bags of hashed features: its words, its word pairs (hashed by the difference of
the two words' hashes, so all immediate repetitions share a bucket) and its byte 3- and 4-grams
up to word ends. Each feature has a learned vector; a document is the sum of its bags' mean
vectors, and softmax over two classes follows. Vectors and output weights are trained together
by plain stochastic gradient descent in numpy on a bounded sample of labelled documents.

Between the mean and the softmax there is nothing but a product, so for scoring each feature's
vector is folded into one number, its pull on the logit. Tasks get that table (``BUCKETS``
floats) and score whole texts with a few numpy passes over their bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texthash import _SEP, prefix_hash, span_hash, text_chunks, word_spans

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
DIM = 16
#: Labelled documents that the model learns from at most; their features (at most BUCKETS a
#: document, some thousands as a rule) go to the driver.
SAMPLE = 4000
#: Steps of gradient descent (one document each).
STEPS = 16_000
GRAMS = (3, 4)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return ((h ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def feature_bags(raw: np.ndarray, off: np.ndarray):
    """The bags of a chunk of texts: (bucket of each feature, where each row's features begin)."""
    starts, ends, first = word_spans(raw, off)
    words = span_hash(prefix_hash(raw, False), starts, ends)
    yield _bucket(words, 1), first
    pair = np.ones(max(len(words) - 1, 0), bool)
    cut = first[1:-1]
    pair[cut[(cut > 0) & (cut < len(words))] - 1] = False
    at = np.flatnonzero(pair)
    yield _bucket(words[at] - words[at + 1], 2), np.searchsorted(at, first)
    sep = _SEP[raw]
    code = np.where(sep, 32, raw).astype(np.uint32)
    positions, buckets = [], []
    for n in GRAMS:
        m = len(raw) - n + 1
        if m <= 0:
            continue
        value, good = code[:m].copy(), np.ones(m, bool)
        for i in range(1, n):
            value |= code[i:m + i] << np.uint32(8 * i)
            if i < n - 1:
                good &= ~sep[i:m + i]
        for back in range(1, n):  # not across two texts
            last = off[1:-1] - back
            good[last[(last >= 0) & (last < m)]] = False
        p = np.flatnonzero(good)
        h = value[p] * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        positions.append(p)
        buckets.append(((h * np.uint32(2246822519)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    if not positions:
        yield np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        return
    for p, b in zip(positions, buckets):
        yield b, np.searchsorted(p, off)


def _weights(raw, off):
    """Per row its distinct buckets and their weights (each bag's counts over its size)."""
    bags = list(feature_bags(raw, off))
    for r in range(len(off) - 1):
        total = np.zeros(BUCKETS, np.float32)
        for bucket, first in bags:
            part = bucket[first[r]:first[r + 1]]
            if len(part):
                total += np.bincount(part, minlength=BUCKETS) / np.float32(len(part))
        idx = np.flatnonzero(total)
        yield idx.astype(np.uint16), total[idx]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int, steps: int = STEPS,
          rate: float = 0.6):
    """(pull of each bucket on the logit of label 1, bias) from (buckets, weights, label) rows."""
    g = np.random.Generator(np.random.PCG64(seed))
    vectors = g.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = g.uniform(-0.5, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    epochs = -(-steps // len(rows))
    for epoch in range(epochs):
        lr = np.float32(rate * (1 - epoch / epochs))
        for k in g.permutation(len(rows)):
            idx, w, label = rows[k]
            hidden = w @ vectors[idx]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            pull = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * np.float32(0.1) * p
            vectors[idx] -= lr * w[:, None] * pull
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, seed: int, id_col: str, text_col: str,
                    label_col: str):
    """The features of at most ``sample`` labelled documents outside the held-out fifth, in the
    order of a seeded hash of their ids."""
    key = F.xxhash64(F.lit(seed), F.col("_id"))
    chosen = (labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("_label"))
              .where("_id is not null and _label in (0, 1)").groupBy("_id").agg(F.min("_label").alias("_label"))
              .where(~held_out(F.col("_id"))).orderBy(key, "_id").limit(sample))

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column(2)):
                feats = list(_weights(raw, off))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array([a.tobytes() for a, _ in feats], pa.binary()),
                     pa.array([b.tobytes() for _, b in feats], pa.binary())], ["id", "label", "idx", "w"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    # at most ``sample`` ids: a proven bound
    found = (texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text")
             .mapInArrow(run, "id bigint, label int, idx binary, w binary").collect())
    unique = {r["id"]: r for r in found}  # rows that repeat an id count once
    return [(np.frombuffer(r["idx"], np.uint16).astype(np.int64), np.frombuffer(r["w"], np.float32), r["label"])
            for _, r in sorted(unique.items())]


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_texts(docs: DataFrame, pull: np.ndarray, bias: float, text_col: str, score_col: str) -> DataFrame:
    """``docs`` with the probability of label 1 in one more column."""
    table = pull.astype(np.float32)

    def score(column: pa.Array) -> pa.Array:
        out = np.full(len(column), bias)
        for i, j, raw, off in text_chunks(column):
            for bucket, first in feature_bags(raw, off):
                size = np.diff(first)
                rows = np.flatnonzero(size)
                if len(rows):
                    sums = np.add.reduceat(table[bucket].astype(np.float64), first[:-1][rows])
                    out[i + rows] += sums / size[rows]
        return pa.array([1 / (1 + math.exp(-max(min(z, 700), -700))) for z in out])

    return docs.withColumn(score_col, F.arrow_udf(score, "double")(F.col(text_col)))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 4, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality"):
    """Learned (pull table, bias). Labels other than 0 and 1, null ids and labels of documents
    that are not there are left out; without any label every score is 1/2."""
    rows = labelled_sample(docs, labels, sample, seed, id_col, text_col, label_col)
    if not rows:
        return np.zeros(BUCKETS), 0.0
    return train(rows, seed)


def classify(docs: DataFrame, labels: DataFrame, limit: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
             **fit) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, over whole texts.

    A null or empty text has no features: its score is the learned prior. A null id is not held
    out. Repeated rows are scored alike; an empty table gives no rows; other columns are not read."""
    pull, bias = fit_quality(docs, labels, id_col=id_col, text_col=text_col, **fit)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score_texts(rows, pull, bias, "text", "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
