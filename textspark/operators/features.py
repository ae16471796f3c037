"""Token features (X1-X3): embedding rows for token ids, positions, row usage.

Tables are joined on the row id. Nothing forces a broadcast: Spark's size statistics pick it,
and a shuffle join splits hot ids (such as the space token) by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def embedding_lookup(tokens: DataFrame, table: DataFrame, key_cols=("doc_id",), ids_col="ids",
                     id_of=None) -> DataFrame:
    """One row per token occurrence ``(keys..., pos, id, embedding)``.
    ``id_of`` maps a token id to a table row id (identity by default)."""
    occ = tokens.select(*key_cols, F.posexplode(ids_col).alias("pos", "id"))
    row = id_of(F.col("id")) if id_of is not None else F.col("id")
    occ = occ.withColumn("vec_id", row.cast("bigint"))
    return occ.join(table.select("vec_id", "embedding"), "vec_id").drop("vec_id")


def add_positions(looked_up: DataFrame, positions: DataFrame, max_seq_length: int) -> DataFrame:
    """Token vector + position vector; a position past the table is an error."""
    checked = looked_up.withColumn("pos", F.when(F.col("pos") < max_seq_length, F.col("pos")).otherwise(
        F.raise_error(F.lit("position beyond max_seq_length")).cast("int")))
    p = positions.select(F.col("pos").cast("int").alias("pos"), F.col("embedding").alias("pvec"))
    return checked.join(p, "pos").withColumn(
        "embedding", F.zip_with("embedding", "pvec", lambda a, b: a + b)).drop("pvec")


def row_usage(tokens: DataFrame, table: DataFrame, ids_col="ids", id_of=None) -> DataFrame:
    """How often each table row is read (once per occurrence); unused rows
    get 0 (a left join from the table side)."""
    ids = tokens.select(F.explode(ids_col).alias("id"))
    row = id_of(F.col("id")) if id_of is not None else F.col("id")
    used = ids.groupBy(row.cast("bigint").alias("vec_id")).agg(F.count(F.lit(1)).alias("uses"))
    return table.select("vec_id").join(used, "vec_id", "left").select(
        "vec_id", F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses"))
