"""Helpers shared by the training-data operators.

``stored`` cuts lineage with a written Parquet table in the shared folder that
the cluster names in ``spark.checkpoint.dir``: it survives lost executors and
is computed once. ``ranged`` is a range partition whose partition number is
stored with the rows, so later branches agree on it however often a plan is
re-run.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The six ASCII white-space characters and the ASCII letters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"


HOT_KEYS = 2_048  # bound of the keys that are broadcast to be joined where their rows are
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder; only a local master may fall back to a private one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``; the shuffle files behind the rows go at the end of the write and not when the driver forgets them."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """``many`` joined to ``one``, which has a row for each key and, as ``rows``, how many of ``many`` it meets.

    Keys of more than their share are at most HOT_KEYS, are broadcast and leave
    their rows where they are; the others meet by a shuffle. ``many`` is stored.
    """
    total = many.count()
    hot = F.col(rows) > max(1_000, total // HOT_KEYS)
    few = one.where(hot)
    cold = many.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(one.where(~hot), keys)
    return cold.unionByName(many.join(F.broadcast(few), keys).select(*cold.columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Words as runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (string or binary) has about ``limit`` bytes in each.

    What a task makes of a batch then has a bound of its own, however many rows
    Spark puts into one; a longer single value is a batch by itself.
    """
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < len(batch):
            past = upto[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(upto, past + limit, side="right")))
            yield batch.slice(at, until - at)
            at = until


def releasing(*forget: Callable[[], None]):
    """A function over Arrow batches that leaves no caches behind at the end of its task.

    Python workers are used again by later tasks, of other operators too; what
    one of them keeps would add to the needs of the next.
    """
    def deco(fn):
        @wraps(fn)
        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from fn(frames)
            finally:
                for clear in forget:
                    clear()
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
                if trim is not None:
                    trim(0)
        return run
    return deco


def ranged(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Range-partition by ``order``, sort, and store with the partition number ``_pid``.

    Ranges come from a sample of the key, so a key of few distinct values puts
    equal rows into one range: end ``order`` with a column that spreads them.
    """
    parted = df.repartitionByRange(*[F.col(c) for c in order])
    return stored(parted.withColumn("_pid", F.spark_partition_id()).sortWithinPartitions(*order), name)


def prefix_sums(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over earlier rows of the same ``by`` group.

    ``order`` has no nulls that matter (nulls sort first). A group may hold any
    share of the rows: it is cut into ranges, summed by range, and each range
    starts from the total of the ranges before it.
    """
    parts = ranged(df, by + order, name)
    totals = parts.groupBy(*by, "_pid").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, F.col("_pid").alias("_opid"),
                            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = (Window.partitionBy("_pid", *by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = parts.withColumn("_run", F.coalesce(F.sum(value).over(within), F.lit(0)))
    keys = [rows["_pid"] == F.col("_opid")]
    renamed = offsets
    for c in by:
        renamed = renamed.withColumnRenamed(c, f"_o_{c}")
        keys.append(rows[c].eqNullSafe(F.col(f"_o_{c}")))
    joined = rows.join(renamed, keys)
    return (joined.withColumn("before", F.col("_run") + F.col("_offset"))
            .drop("_run", "_offset", "_opid", *[f"_o_{c}" for c in by]))
