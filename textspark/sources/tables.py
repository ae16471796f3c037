"""Readers for the provided Parquet tables.

Only the columns a query needs are selected, so the scan's ``ReadSchema`` stays
narrow (the ``text`` column dominates the bytes; never read it when unused).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def documents(spark, sf_dir, *columns) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def conversations(spark, sf_dir, *columns) -> DataFrame:
    return read_table(spark, sf_dir, "conversations",
                      *(columns or ("conv_id", "turn", "role", "text")))


def benchmark(spark, sf_dir, *columns) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark", *(columns or ("item_id", "text")))
