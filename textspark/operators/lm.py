"""Count-based next-token model and its evaluation.

``p(w | c) = (n(c, w) + alpha) / (n(c) + alpha * V)`` over bigrams inside each
document; an unseen context backs off to the smoothed unigram
``(n(w) + alpha) / (N + alpha * V)``. Every evaluation first pre-aggregates
the scored pairs (``groupBy(context, token).count()``) so each distinct pair is
looked up once: a pair holding a third of all rows costs one join row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import reliable_checkpoint
from .encode import id_lists
from .order import exclusive_running


#: A model table of at most so many rows goes whole to the tasks that look it up.
NEAR_ROWS = 200_000
#: Ids that a task counts at once.
COUNT_IDS = 1 << 20


def token_counts(encoded: DataFrame, ids_col="ids", pairs: bool = False, out="n") -> DataFrame:
    """``token`` (with ``pairs``: ``context, token`` of neighbours inside a row) and how often it occurs.
    Tasks count stretches of ids by themselves, so that not the occurrences but their distinct values
    enter the aggregate. Null rows have no ids; a null id is an error."""
    names = ["context", "token"] if pairs else ["token"]
    return _counted(encoded, ids_col, pairs, not pairs).groupBy(*names).agg(F.sum("n").alias(out))


def _counted(encoded: DataFrame, ids_col: str, pairs: bool, singles: bool) -> DataFrame:
    """``context, token, n`` by stretch: neighbours (``pairs``) and single ids (``singles``: context null)."""
    def run(batches):
        for batch in batches:
            values, bounds = id_lists(batch.column(0))
            if values.null_count:
                raise ValueError("null token id")
            ids = values.to_numpy(zero_copy_only=False)
            inside = np.ones(max(len(ids) - 1, 0), bool)  # place i and the next one are in one row
            start = bounds[1:-1]
            inside[start[(start > 0) & (start < len(ids))] - 1] = False
            for at in range(0, len(ids), COUNT_IDS):
                key = ids[at:at + COUNT_IDS + 1].astype(np.int64)  # 8 bytes an id for a stretch only
                if singles:
                    found, n = np.unique(key[:COUNT_IDS], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.int32()), pa.array(found.astype(np.int32)), pa.array(n)], names)
                if pairs:
                    here = np.flatnonzero(inside[at:at + COUNT_IDS])
                    found, n = np.unique((key[here] << 32) | (key[here + 1] & 0xFFFFFFFF), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array((found >> 32).astype(np.int32)), pa.array(found.astype(np.int32)), pa.array(n)], names)

    names = ["context", "token", "n"]
    return encoded.select(F.col(ids_col).cast("array<int>")).mapInArrow(run, "context int, token int, n bigint")


@dataclass
class NgramModel:
    pairs: DataFrame      # context, token, n
    contexts: DataFrame   # context, n_c
    unigrams: DataFrame   # token, n_w
    vocab_size: int
    n_tokens: int
    alpha: float = 1.0

    def near(self, name: str) -> DataFrame:
        """A table of the model to look up. Written tables have no size statistics, and rows that are dealt by a context
        land in a few tasks where there are few contexts (characters): a table of at most ``NEAR_ROWS``
        rows (counted once) is broadcast instead."""
        seen = self.__dict__.setdefault("_near", {})
        table = getattr(self, name)
        if name not in seen:
            seen[name] = table.limit(NEAR_ROWS + 1).count() <= NEAR_ROWS
        return F.broadcast(table) if seen[name] else table

    def log_prob(self, scored: DataFrame) -> DataFrame:
        """L2 for arbitrary (context, token) rows: adds ``logp`` (natural log)."""
        a, V = self.alpha, self.vocab_size
        j = (scored.join(self.near("pairs"), ["context", "token"], "left")
             .join(self.near("contexts"), "context", "left")
             .join(self.near("unigrams"), "token", "left"))
        p_ctx = (F.coalesce("n", F.lit(0)) + a) / (F.col("n_c") + a * V)
        p_uni = (F.coalesce("n_w", F.lit(0)) + a) / (F.lit(self.n_tokens) + a * V)
        return j.withColumn("logp", F.log(F.when(F.col("n_c").isNotNull(), p_ctx).otherwise(p_uni))) \
            .drop("n", "n_c", "n_w")

    def next_token_probs(self) -> DataFrame:
        """L2: (context, token, prob, n_tokens), a whole distribution for each context: a row for
        every observed successor (``n_tokens`` 1), and one with a null token that gives the
        probability of each of the ``n_tokens`` other ids. sum(prob * n_tokens) is 1."""
        a, V = self.alpha, self.vocab_size
        seen = self.pairs.join(self.contexts, "context").select(
            "context", "token", ((F.col("n") + a) / (F.col("n_c") + a * V)).alias("prob"), F.lit(1).cast("bigint").alias("n_tokens"))
        rest = (self.pairs.groupBy("context").agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("n_c"))
                .select("context", F.lit(None).cast("int").alias("token"), (F.lit(a) / (F.col("n_c") + a * V)).alias("prob"),
                        (F.lit(V) - F.col("s")).cast("bigint").alias("n_tokens")).where("n_tokens > 0"))
        return seen.unionByName(rest)


def fit_ngram(encoded: DataFrame, vocab_size: int, alpha: float = 1.0, ids_col="ids") -> NgramModel:
    """L1: bigram and single counts (counted in tasks in one pass, then a partial and a final hash aggregate):
    the ids are neither kept nor written. The model tables are
    written to the checkpoint folder once: every evaluation and generation
    round reads them, and their size is bounded by the observed pairs."""
    both = reliable_checkpoint(_counted(encoded, ids_col, True, True).groupBy("context", "token").agg(F.sum("n").alias("n")))
    pairs = both.where("context is not null")
    contexts = reliable_checkpoint(pairs.groupBy("context").agg(F.sum("n").alias("n_c")))
    unigrams = reliable_checkpoint(both.where("context is null").select("token", F.col("n").alias("n_w")))
    n_tokens = unigrams.agg(F.sum("n_w")).first()[0] or 0
    return NgramModel(pairs, contexts, unigrams, vocab_size, int(n_tokens), alpha)


def counted_scores(encoded: DataFrame, vocab_size: int, alpha: float = 1.0, ids_col="ids") -> DataFrame:
    """(context, token, logp) of the observed pairs, counted without the model's tables: each
    token occurrence meets the next by its place, contexts are counted by their own occurrences."""
    occ = encoded.where(F.size(ids_col) > 1).select(F.posexplode(ids_col).alias("pos", "token"), F.col(ids_col).alias("ids"))
    occ = occ.where("pos > 0").select(F.get("ids", F.col("pos") - 1).alias("context"), "token")
    both = occ.groupBy("context", "token").count().withColumnRenamed("count", "n")
    alone = occ.groupBy("context").count().withColumnRenamed("count", "n_c")
    return both.join(alone, "context").select(
        "context", "token", (F.log(F.col("n") + alpha) - F.log(F.col("n_c") + alpha * vocab_size)).alias("logp"))


def score_difference(model: NgramModel, scores: DataFrame) -> tuple[float, int]:
    """The largest difference between the model's scores and ``scores`` (infinite where one has a pair that
    the other lacks), and the number of pairs."""
    mine = model.next_token_probs().where("token is not null").select("context", "token", F.log("prob").alias("a"))
    both = mine.join(scores.select("context", "token", F.col("logp").alias("b")), ["context", "token"], "full_outer")
    gap = F.coalesce(F.abs(F.col("a") - F.col("b")), F.lit(float("inf")))
    r = both.agg(F.max(gap).alias("d"), F.count(F.lit(1)).alias("n")).first()
    return float(r["d"] or 0.0), int(r["n"])


def cross_entropy(model: NgramModel, encoded: DataFrame, ids_col="ids") -> DataFrame:
    """L3: token-weighted mean -ln p(next) over held-out pairs, in nats."""
    s = model.log_prob(token_counts(encoded, ids_col, pairs=True, out="cnt"))
    return s.agg((F.sum(-F.col("logp") * F.col("cnt")) / F.sum("cnt")).alias("loss"),
                 F.sum("cnt").cast("bigint").alias("n_pairs"))


def window_pairs(windows: DataFrame) -> DataFrame:
    """(batch_id, context, token) for every position of every (x, y) window."""
    z = F.arrays_zip(F.col("x").alias("context"), F.col("y").alias("token"))
    return windows.select("batch_id", F.explode(z).alias("p")).select("batch_id", "p.context", "p.token")


def mean_of_batch_means(model: NgramModel, batched_windows: DataFrame) -> DataFrame:
    """L4: evaluation loss as the mean of per-batch means (a short last batch
    weighs as much as a full one), plus the token-weighted mean."""
    counted = window_pairs(batched_windows).groupBy("batch_id", "context", "token").agg(
        F.count(F.lit(1)).alias("cnt"))
    s = model.log_prob(counted)
    per_batch = s.groupBy("batch_id").agg(F.sum(-F.col("logp") * F.col("cnt")).alias("tot"),
                                          F.sum("cnt").alias("cnt"))
    return per_batch.agg(F.avg(F.col("tot") / F.col("cnt")).alias("loss"),
                         (F.sum("tot") / F.sum("cnt")).alias("token_weighted_loss"),
                         F.count(F.lit(1)).cast("bigint").alias("n_batches"))


def perplexity(loss_col) -> F.Column:
    """L5"""
    return F.exp(loss_col)


def bits_per_char(loss_col, chars_per_token_col) -> F.Column:
    """Nats per token -> bits per character."""
    return loss_col / chars_per_token_col / F.lit(math.log(2))


def interval_train_loss(step_log: DataFrame, every: int = K.EVAL_EVERY, step_col="step",
                        loss_col="loss") -> DataFrame:
    """Mean training loss over each evaluation interval (evaluation every
    ``every`` steps and at the final step)."""
    iv = F.ceil(F.col(step_col) / every).cast("bigint")
    return step_log.groupBy(iv.alias("interval")).agg(
        F.max(step_col).cast("bigint").alias("eval_step"),
        F.avg(loss_col).alias("train_loss"), F.count(F.lit(1)).cast("bigint").alias("steps"))


def best_checkpoints(step_log: DataFrame, step_col="step", val_col="val_loss") -> DataFrame:
    """Mark rows whose validation loss is strictly below every earlier one
    (an equal minimum is not marked again). Running minimum by the distributed
    two-level scan, not a single-task window."""
    prev = exclusive_running(step_log.select(step_col, val_col), [step_col], val_col, "min", "prev_min")
    return prev.select(step_col, val_col,
                       (F.col("prev_min").isNull() | (F.col(val_col) < F.col("prev_min"))).alias("improved"))


def uniform_baseline(vocab_size_col) -> tuple[F.Column, F.Column]:
    """Loss ln V and perplexity V of uniform guessing."""
    return F.log(vocab_size_col.cast("double")), vocab_size_col.cast("double")
