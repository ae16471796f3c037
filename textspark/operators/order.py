"""Distributed global order: dense indexes and prefix sums without a single-task window.

Scheme (two-level scan): range-partition by the order key and sort inside each
partition; ``monotonically_increasing_id`` then encodes (partition, local
index); the table is checkpointed to the shared checkpoint folder so those ids
stay fixed under retries; per-partition totals (one row per partition) get an
exclusive scan; the offsets (bounded by the partition count) are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def _ranged(df: DataFrame, order_cols, partitions):
    r = (df.repartitionByRange(_partitions(df, partitions), *order_cols)
         .sortWithinPartitions(*order_cols)
         .withColumn("_mid", F.monotonically_increasing_id()))
    r = reliable_checkpoint(r)
    return (r.withColumn("_pid", F.shiftrightunsigned("_mid", _LOCAL_BITS))
            .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))).drop("_mid"))


def _offsets(per_part: DataFrame, value: str) -> DataFrame:
    """Exclusive scan over one row per partition (a bounded, tiny table)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_pid", F.coalesce(F.sum(value).over(w), F.lit(0)).alias("_off"))


def global_index(df: DataFrame, order_cols, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order_cols`` (ties must
    not exist, or are broken arbitrarily)."""
    r = _ranged(df, order_cols, partitions)
    counts = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = _offsets(counts, "_n")
    return (r.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_loc")).cast("bigint"))
            .drop("_pid", "_loc", "_off"))


def exclusive_prefix_sum(df: DataFrame, order_cols, value_col: str, name: str = "offset",
                         partitions: int | None = None) -> DataFrame:
    """Sum of ``value_col`` over all rows strictly before each row in the order.

    Only narrow columns should be passed in (keys and the value); join the
    result back to wide tables by key."""
    r = _ranged(df, order_cols, partitions)
    totals = r.groupBy("_pid").agg(F.sum(value_col).alias("_t"))
    offs = _offsets(totals, "_t")
    w = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value_col).over(w), F.lit(0))
    return (r.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + local).cast("bigint"))
            .drop("_pid", "_loc", "_off"))


def exclusive_running(df: DataFrame, order_cols, value_col: str, how: str = "min", name: str = "prev",
                      partitions: int | None = None) -> DataFrame:
    """Running ``min``/``max`` of ``value_col`` over all rows strictly before each
    row (null for the first row), by the same two-level scan."""
    agg = {"min": F.min, "max": F.max}[how]
    r = _ranged(df, order_cols, partitions)
    per = r.groupBy("_pid").agg(agg(value_col).alias("_t"))
    w_parts = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_pid", agg("_t").over(w_parts).alias("_off"))
    w = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    local = agg(value_col).over(w)
    both = F.when(F.col("_off").isNull(), local).when(local.isNull(), F.col("_off")).otherwise(
        F.least(local, F.col("_off")) if how == "min" else F.greatest(local, F.col("_off")))
    return (r.join(F.broadcast(offs), "_pid").withColumn(name, both)
            .drop("_pid", "_loc", "_off"))
