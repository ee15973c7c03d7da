"""Parquet table access for a data directory (one parquet per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, d).orders`` reads ``d/orders.parquet``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.data_dir, name)
        raise AttributeError(name)
