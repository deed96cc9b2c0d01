"""Parquet tables of a data folder (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Table names of the test data folders.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the Parquet scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def conversations(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "conversations")
