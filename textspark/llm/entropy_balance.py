"""Mixing sources to target weights by entropy balancing (dealt operator 8).

Each document gets a rate r between 0 and 2, as near as possible (in relative entropy of
Fermi-Dirac form, prior one copy) to taking it once, so that the words of every source come to
its target. The convex dual has one multiplier per source and the solution is an exponential
tilt of the prior odds: ``r = 2 / (1 + exp(-m * x))``, x = size over the source's mean size.

Newton steps on the multipliers are Spark aggregates over the (source, size) histogram, all
sources at once; sums are taken in fixed point, so every run gives the same multipliers. Rates
become copies by error diffusion in blocks of at most ``BLOCK`` documents of a source, largest
first, each from the error that the source's earlier blocks leave (a prefix sum of expected
words), so a source differs from its target by about half a small document. Blocks are cut by rank, not by partition, so copies do not depend on the cluster; a hot source is many
blocks. Nothing but the largest relative error (one number a step) comes to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import exclusive_prefix_sum
from .common import WORD, Scratch, fresh
from .stratified_shards import global_index, shuffle_key

#: Documents that are rounded together.
BLOCK = 1024
#: Copies of one document at most (a document's words at most twice).
MOST = 2
STEPS = 60
#: Rows of a batch that the mix hands on.
TAKEN_ROWS = 1000


def source_targets(sources: DataFrame, weights: tuple[int, ...], percent: int, scratch: Scratch) -> DataFrame:
    """``sources`` (no_source, source, source_size) with ``weight`` and ``target``.

    Weights repeat over the sources by code point, null last. Targets share ``percent`` of all
    words by weight; a target stops at ``MOST`` times its source's words and the excess goes to
    the others by weight, until none is above."""
    at = F.pmod(F.col("at"), F.lit(len(weights))).cast("int")
    rows = scratch.save(global_index(sources, ["no_source", "source"], "at", scratch).withColumn(
        "weight", F.array(*[F.lit(w) for w in weights])[at]).withColumn("capped", F.lit(False)), "targets")
    most = MOST * F.col("source_size")
    while True:
        sums = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
                        F.coalesce(F.sum(F.when(F.col("capped"), most)), F.lit(0)).alias("fixed"),
                        F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0)).alias("free"),
                        F.sum(F.col("capped").cast("int")).alias("n")).first()
        left = sums["all"] * percent / 100 - sums["fixed"]
        share = F.col("weight") * F.lit(left) / F.lit(max(sums["free"], 1))
        rows = rows.withColumn("target", F.when(F.col("capped"), most.cast("double")).otherwise(share))
        above = rows.where(~F.col("capped") & (F.col("target") > most))
        if above.isEmpty():
            return scratch.save(rows.drop("at"), "targets")
        rows = scratch.save(rows.withColumn("capped", F.col("capped") | (F.col("target") > most)), "targets")


def _rate(m, x):
    return MOST / (1 + F.exp(-m * x))


def balance(sizes: DataFrame, targets: DataFrame, tolerance: float, scratch: Scratch) -> DataFrame:
    """``no_source, source, m``: the multiplier of each source (null: all copies; see ``rate``)."""
    hist = scratch.save(sizes.where("size > 0").groupBy("no_source", "source", "size").agg(F.count("*").alias("n")), "sizes")
    key = ["no_source", "source"]
    state = scratch.save(
        targets.where(f"target < {MOST} * source_size and source_size > 0")
        .select(*key, "target", (F.col("source_size") / F.col("words")).alias("mean"),
                F.lit(0.0).alias("m"), F.lit(-700.0).alias("lo"), F.lit(700.0).alias("hi")), "multipliers")
    x = F.col("size") / F.col("mean")
    r = _rate(F.col("m"), x)
    words = F.col("n") * F.col("size")
    # fixed point: exact sums, whatever the order of the rows
    value = F.round(words * r * 1024).cast("bigint")
    slope = F.round(words * r * (1 - r / MOST) * x * 1024).cast("bigint")
    for _ in range(STEPS):
        sums = (hist.join(state, key).groupBy(*key, "target", "mean", "m", "lo", "hi")
                .agg((F.sum(value) / 1024).alias("got"), (F.sum(slope) / 1024).alias("slope")))
        miss = F.col("got") - F.col("target")
        step = F.col("m") - F.try_divide(miss, F.col("slope"))
        lo = F.when(miss < 0, F.col("m")).otherwise(F.col("lo"))
        hi = F.when(miss > 0, F.col("m")).otherwise(F.col("hi"))
        safe = F.when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
        done = F.abs(miss) <= tolerance * F.col("target")
        new = scratch.save(sums.select(*key, "target", "mean", F.when(done, F.col("m")).otherwise(F.round(safe, 10)).alias("m"),
                                       lo.alias("lo"), hi.alias("hi"), done.alias("done")), "multipliers")
        scratch.drop(state)
        state = new
        if state.where("not done").isEmpty():
            break
    return state.select(*key, "m", "mean")


def _diffuse(size: list[float], rate: list[float], error: float) -> tuple[np.ndarray, float]:
    """Copies by error diffusion in words, from an error that is carried in; and the error left."""
    copies = np.zeros(len(size), np.int64)
    for i, (s, r) in enumerate(zip(size, rate, strict=True)):
        low = min(int(r), MOST)
        up = low < MOST and (r - low) * s + error > s / 2
        copies[i] = low + up
        error += r * s - copies[i] * s
    return copies, error


def _round_block(block: pa.Table) -> pa.Table:
    """Copies of one block, largest documents first. The error it starts from is what is left when
    the words expected of the source's earlier blocks (``ahead``) are taken in documents of the size of its first,
    so the errors of blocks do not add up: low rates take a document every few blocks."""
    block = block.sort_by([("at", "ascending")])
    size = block["size"].to_numpy().astype(float)
    s, ahead = size[0], block["ahead"][0].as_py() / 1024
    start = (ahead + s / 2) % s - s / 2 if s else 0.0
    copies, _ = _diffuse(size.tolist(), block["rate"].to_numpy().tolist(), start)
    return block.drop_columns(["at", "no_source", "block", "ahead"]).append_column("copies", pa.array(copies))


def _sized(text_col: str):
    return F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_tilts(rows: DataFrame, weights: tuple[int, ...], percent: int, tolerance: float, scratch: Scratch) -> DataFrame:
    """``no_source, source, source_size, target, m, mean`` of each source of ``rows`` (no_source,
    source, size)."""
    key = ["no_source", "source"]
    sources = scratch.save(rows.groupBy(*key).agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"),
                                                  F.sum((F.col("size") > 0).cast("bigint")).alias("words")), "sources")
    targets = source_targets(sources, weights, percent, scratch)
    return scratch.save(targets.select(*key, "source_size", "target").join(
        balance(rows, targets, tolerance, scratch), key, "left"), "tilts")


def _rate_of(size, m, mean):
    return (F.when(size == 0, 1.0).when(m.isNull(), float(MOST)).otherwise(_rate(m, size / mean)))


def mix_in_place(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, tolerance: float = 1e-4,
                 text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0 to ``MOST`` times), with their columns.

    The rates are those of :func:`mix_sources`. Rows are rounded where they are read, by error
    diffusion over the rows of a source in each task, so no text is shuffled and rows need no
    ids; a source's error is that of its tasks, under half a document each and of either sign. A
    run over the same files and split sizes takes the same rows. Nulls, ties, repeated rows and
    empty tables as there; any other columns pass through, whatever their names."""
    scratch = Scratch(docs.sparkSession, "mix")
    sized = docs.select(F.col(source_col).isNull().alias("no_source"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
                        _sized(text_col).alias("size"))
    rows = scratch.save(sized, "sizes")
    tilts = source_tilts(rows, weights, percent, tolerance, scratch)
    named = tilts.select(F.when(~F.col("no_source"), F.col("source")).alias("s"), "m", "mean")
    s, m, mean, size, rate = (fresh(docs, f"_mix_{c}") for c in ("s", "m", "mean", "size", "rate"))
    named = named.toDF(s, m, mean)
    rated = (docs.withColumn(size, _sized(text_col)).join(named, F.col(source_col).eqNullSafe(F.col(s)), "left")
             .withColumn(rate, _rate_of(F.col(size), F.col(m), F.col(mean))).select(*docs.columns, size, rate))
    at = docs.columns.index(source_col)

    def run(batches):
        errors: dict = {}
        for batch in batches:
            sources = batch.column(at).to_pylist()
            sizes, rates = batch.column(len(batch.columns) - 2).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()
            places: dict = {}
            for i, name in enumerate(sources):
                places.setdefault(name, []).append(i)
            times = np.zeros(len(sources), np.int64)
            for name, own in places.items():
                times[own], errors[name] = _diffuse([float(sizes[i]) for i in own], [rates[i] for i in own], errors.get(name, 0.0))
            picked = pa.array(np.repeat(np.arange(len(sources)), times))
            for part in range(0, len(picked), TAKEN_ROWS):
                yield pa.RecordBatch.from_arrays([c.take(picked[part:part + TAKEN_ROWS]) for c in batch.columns[:-2]],
                                                 batch.schema.names[:-2])

    return rated.mapInArrow(run, docs.schema)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, seed: int = 0,
                tolerance: float = 1e-4, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for each row, and
    ``row``, the values of ``row_col`` (a bigint that names the row), if it is given.

    Size is the number of words (null text: 0). Documents without words get one copy and take
    nothing. A null source is a source of its own, last in order. Sources whose target is twice
    their words take every document twice. Ties of size are ordered by a seeded hash of the id;
    repeated rows are rounded as rows of their own, null ids pass through; an empty table gives
    no rows. Other columns are not read."""
    scratch = Scratch(docs.sparkSession, "mix")
    kind = docs.schema[id_col].dataType.simpleString()
    named_rows = [F.col(row_col).alias("row"), F.xxhash64(text_col).alias("text_hash")] if row_col else []
    kept = ["row"] if row_col else []
    rows = scratch.save(docs.select(
        *named_rows,
        F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        _sized(text_col).alias("size"), shuffle_key(F.col(id_col), seed).alias("key")), "rows")
    key = ["no_source", "source"]
    tilts = source_tilts(rows, weights, percent, tolerance, scratch)
    order = [*key, "down", "key", "doc_id", *(["text_hash", "row"] if row_col else [])]
    indexed = global_index(rows.withColumn("down", -F.col("size")), order, "at", scratch)
    first = scratch.save(indexed.groupBy(*key).agg(F.min("at").alias("first")), "first")
    rate = _rate_of(F.col("size"), F.col("m"), F.col("mean"))
    rated = (indexed.join(tilts.join(first, key).select(*key, "m", "mean", "first"), key)
             .select(*kept, "doc_id", "source", "no_source", "size", rate.alias("rate"), "at",
                     F.floor((F.col("at") - F.col("first")) / BLOCK).alias("block")))
    rated = scratch.save(rated, "rated")
    blocks = scratch.save(rated.groupBy(*key, "block").agg(
        F.sum(F.round(F.col("rate") * F.col("size") * 1024).cast("bigint")).alias("words")), "blocks")
    upto = scratch.save(exclusive_prefix_sum(blocks, [*key, "block"], "words", "ahead"), "ahead")
    ahead = upto.join(upto.where("block = 0").select(*key, F.col("ahead").alias("base")), key).select(
        *key, "block", (F.col("ahead") - F.col("base")).alias("ahead"))
    named = rated.join(ahead, [*key, "block"]).withColumn("source", F.when(~F.col("no_source"), F.col("source")))
    named = named.select(*kept, "doc_id", "source", "no_source", "size", "rate", "at", "block", "ahead")
    copies = (named.groupBy("source", "block").applyInArrow(
        _round_block, f"{'row bigint, ' if row_col else ''}doc_id {kind}, source string, size bigint, rate double, copies bigint"))
    totals = tilts.select(F.when(~F.col("no_source"), F.col("source")).alias("s"), "source_size", "target")
    return (scratch.save(copies, "copies").join(totals, F.col("source").eqNullSafe(F.col("s")))
            .select(*kept, "doc_id", "source", "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
