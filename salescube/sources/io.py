"""Sources and sinks.

All writes go to paths the caller gives (on a cluster: shared storage).
Appends are plain ``mode("append")``; a date-range replace uses dynamic
partition overwrite so only the touched ``date=`` folders are rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with header skip and a declared schema (I1, I17): no inference pass."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def append_csv_to_table(spark: SparkSession, csv_path: str, schema: T.StructType, table_path: str) -> None:
    """Append-load a CSV into a raw Parquet table."""
    df = load_csv(spark, csv_path, schema)
    df.select(*schema.fieldNames()).write.mode("append").parquet(table_path)


def clustered(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows of one output partition together, so that each task writes few files.

    Large output partitions are spread over tasks, small ones put together, by their
    measured size; nothing is computed twice for a sample.
    """
    return df.hint("rebalance", partition_col)


def write_long_history(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Long history output, partitioned by month of `date`."""
    w = clustered(df.withColumn("month_start", F.trunc("date", "month")), "month_start").write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.partitionBy("month_start").format(fmt).save(path)


def append(df: DataFrame, path: str) -> None:
    """Plain append of result rows (I8)."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read an append-only table whose later files added columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_evolve(df: DataFrame, path: str) -> None:
    """Append allowing new (nullable) columns; readers use ``read_evolving``."""
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_col: str = "date") -> None:
    """Idempotent range replace (I9): rewrite exactly the partitions present in `df`.

    Requires `df` to hold every row of each replaced partition (true for a
    prediction table: each date holds all series of that date).
    """
    (clustered(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def append_json_lines(df: DataFrame, path: str) -> None:
    """Run-log append as JSON lines with nested fields."""
    df.write.mode("append").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
