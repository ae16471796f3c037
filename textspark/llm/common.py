"""Shared helpers: scratch tables in the cluster's folder, word rule, id handling."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a run of characters other than space and \t \n \v \f \r.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Tables in the folder named by ``spark.checkpoint.dir``: each is computed once,
    cuts the lineage, is read by every executor and outlives a lost one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables that no later plan reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(conf).delete(path, True)


#: Bits of the map of ids in ``split_by_ids``: 1,024 pages of 4 KB, a proven bound of what is broadcast.
ID_BITS = 25


def split_by_ids(rows: DataFrame, key: str, ids: DataFrame, id_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose key is certainly not among ``ids`` (they stay where they are), and those that
    share a bit of a map of hashed ids with one (all that have such a key, and few others). Null keys are with
    the first."""
    bit = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << ID_BITS))
    maps = scratch.save(ids.where(F.col(id_col).isNotNull()).select(F.shiftright(bit, 15).alias("slot"), bit.bitwiseAND(F.lit(32767)).alias("place"))
                        .groupBy("slot").agg(F.bitmap_construct_agg("place").alias("bits")), "bits")
    mine, bits = fresh(rows, "_slot"), fresh(rows, "_bits")
    own = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << ID_BITS))
    place = own.bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)) & F.col(key).isNotNull()
    met = rows.join(F.broadcast(maps.select(F.col("slot").alias(mine), F.col("bits").alias(bits))),
                    F.shiftright(own, 15) == F.col(mine), "left")
    return met.where(~hit).select(*rows.columns), met.where(hit).select(*rows.columns)


def release_memory() -> None:
    """Hands memory that a task no longer uses back to the system, for the worker lives on."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand rows of long texts or id lists to Python in batches of at most ``rows`` (a setting
    of the session: ``spark.sql.execution.arrow.maxRecordsPerBatch``)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Shuffle files go as soon as the query that wrote them has ended, not when the driver next
    collects its garbage (a setting of the session, put back at the end). For steps that write tables:
    a frame that is run twice shuffles twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also inside lambdas
    (the optimizer may otherwise inline it into each use)."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def byte_chunks(offsets, limit: int):
    """Row ranges [i, j) of an offset array whose bytes stay near ``limit`` (one long row alone)."""
    import numpy as np
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
