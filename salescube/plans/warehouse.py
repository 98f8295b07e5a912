"""Materialised tables in the shared folder.

The modelled application keeps raw inputs and marts as tables and staging as
views. ``Warehouse.table`` writes a DataFrame once as Parquet under
``spark.checkpoint.dir`` (shared storage on a cluster, so it survives
executor loss, unlike a cached or locally checkpointed frame) and hands back
a plain Parquet read, which also cuts the lineage of everything built on it.
Tables are keyed per application so a new run never reads stale output.

A table may be bucketed (``buckets`` and the columns ``by``): rows of equal
columns lie in one file, so joins, groups and windows on them need no shuffle.
Frames read from bucketed tables of as many buckets keep their places when
they are stored.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from salescube.session import shared_path

_WRITTEN: dict[tuple, str] = {}
_LOCKS: dict[tuple, threading.Lock] = {}
_GUARD = threading.Lock()


class Warehouse:
    def __init__(self, spark: SparkSession, namespace: str):
        self.spark = spark
        self.app = spark.sparkContext.applicationId
        self.ns = hashlib.sha1(namespace.encode()).hexdigest()[:12]

    def path(self, name: str) -> str:
        return shared_path(self.spark, f"warehouse-{self.app}", self.ns, name)

    def table(self, name: str, build, partition_by: list[str] | None = None,
              buckets: int | None = None, by: list[str] | None = None) -> DataFrame:
        """Write `build()` once (per application and namespace) and read it back."""
        key = (self.app, self.ns, name)
        listed = f"wh_{hashlib.sha1(self.app.encode()).hexdigest()[:12]}_{self.ns}_{name}"
        with _GUARD:
            lock = _LOCKS.setdefault(key, threading.Lock())
        with lock:  # concurrent callers wait for one writer instead of racing
            path = _WRITTEN.get(key)
            if path is None:
                path = self.path(name)
                w = build().write.mode("overwrite")
                if partition_by:
                    w = w.partitionBy(*partition_by)
                if buckets:
                    w.bucketBy(buckets, *by).format("parquet").option("path", path).saveAsTable(listed)
                else:
                    w.parquet(path)
                _WRITTEN[key] = path
        return self.spark.table(listed) if buckets else self.spark.read.parquet(path)
