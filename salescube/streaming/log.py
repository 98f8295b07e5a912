"""A log of small states in the shared folder: each version is one file, written whole."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class CommitLog:
    """``commit`` writes the next version, ``read`` gives the newest one's rows.

    A version has a single file, which the commit protocol renames into its
    folder when the write has ended: a version is there in whole or not at all.
    A writer that dies before leaves the version before in force. There is one
    writer at a time. States are a few rows (runs, counters), never data.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> tuple[int, list[Row]]:
        """(newest version, its rows); (0, []) before the first commit."""
        if not path_exists(self.spark, self.path):
            return 0, []
        rows = self.spark.read.schema(f"{self.schema}, version int").parquet(self.path).collect()
        version = max((r["version"] for r in rows), default=0)
        return version, [r for r in rows if r["version"] == version]

    def commit(self, version: int, rows: list[tuple]) -> None:
        (self.spark.createDataFrame(rows, self.schema).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/version={version}"))
