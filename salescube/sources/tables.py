"""Readers for the parquet inputs with explicit column pruning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one parquet table; selecting `columns` keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Expose the driver tables as temp views for `spark.sql`."""
    for name in names or DRIVER_TABLES:
        if os.path.exists(table_path(sf_dir, name)):
            read_table(spark, sf_dir, name).createOrReplaceTempView(name)
