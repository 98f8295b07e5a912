"""Predictions that wait for their actuals: the accuracy join as an incremental step.

Both tables are folders that files are added to. Each run takes the new files
of both sides (``availableNow``), joins them on the grain with what the state
store holds of earlier runs, and writes the pairs found to
``out/batch_id=<n>``; a replayed batch rewrites its own folder.

The state lies in RocksDB, on the disks of the executors and with its changes in
the checkpoint: it is not bounded by their memory. An entry is a packet, the rows
of both sides of one day in one of `SLICES` slices of the series, so that a row
costs neither look-ups nor entries of its own. A batch reads and writes the packets
that it has rows for, and pairs each grain that has new rows in them: its latest
prediction with its latest actual.

The state holds a row until both sides have passed its date by `wait_days`
(the watermark is the smaller of the two), so it is bounded by that span and
not by the tables. A row that comes later than that would go missing: a run
that met such rows ends with an error that names their number, and their
dates are to be rebuilt by ``marts.prediction_accuracy``.

A row delivered again is joined anew; ``paired`` keeps, for each grain, the
pair of the latest deliveries. Rows with a null in the grain pair with
nothing. Without files on one side nothing is paired yet.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.schemas import GRAIN, ID_COLUMNS
from salescube.streaming.log import path_exists

STATE = {  # set while the stream runs
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",    # a store, and so a buffer, for each partition
}
SLICES = 200             # packets of a day; fixed for as long as a checkpoint is in use
WAIT_DAYS = 120          # longer than the days that a backfill rewrites
PAIRS = "date date, store_id string, item_id string, predicted_sales double, sales long, p_at timestamp, a_at timestamp"


def _side(spark: SparkSession, path: str, value: str, name: str, wait_days: int) -> DataFrame:
    """The rows that can pair, with the time of their file and of the batch that took them in."""
    df = spark.readStream.schema(f"date date, store_id string, item_id string, {value}").parquet(path)
    delivered = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.current_timestamp().alias("seen"),
                         F.col(value.split()[0]).alias("value"))
    return (df.select(F.col("date").cast("timestamp").alias("day"), *ID_COLUMNS, delivered.alias(name))
            .dropna(subset=["day", *ID_COLUMNS]).withWatermark("day", f"{wait_days} days"))


def run_accuracy_stream(spark: SparkSession, predictions: str, actuals: str, out: str, checkpoint: str,
                        wait_days: int = WAIT_DAYS) -> None:
    """Pair what is new in both folders (see the module's text)."""
    p = _side(spark, predictions, "predicted_sales double", "p", wait_days)
    a = _side(spark, actuals, "sales long", "a", wait_days)
    rows = (p.unionByName(a, allowMissingColumns=True).observe("came", F.count(F.lit(1)).alias("n"))
            .withColumn("slice", F.pmod(F.xxhash64(*ID_COLUMNS), F.lit(SLICES))))
    # Rows go to their packet's place as they are; packed before, they would be many lists of a row or two.
    packets = (rows.repartition("day", "slice").groupBy("day", "slice")
               .agg(F.collect_list(F.struct(*ID_COLUMNS, "p", "a")).alias("rows")))
    touched = (packets.select("day", "slice", F.inline("rows"))
               .withColumn("new", F.coalesce("p.seen", "a.seen") == F.current_timestamp())
               .observe("kept", F.count_if("new").alias("n")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("day", "slice", *ID_COLUMNS)
         .agg(F.max("p").alias("p"), F.max("a").alias("a"), F.bool_or("new").alias("new"))
         .where(F.col("new") & F.col("p").isNotNull() & F.col("a").isNotNull())
         .select(F.col("day").cast("date").alias("date"), *ID_COLUMNS, F.col("p.value").alias("predicted_sales"),
                 F.col("a.value").alias("sales"), F.col("p.at").alias("p_at"), F.col("a.at").alias("a_at"))
         .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))

    with settings(spark, STATE):
        q = (touched.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    if any(op["numRowsDroppedByWatermark"] for progress in q.recentProgress for op in progress["stateOperators"]):
        seen = [progress["observedMetrics"] for progress in q.recentProgress]
        late = sum(m["came"]["n"] for m in seen if "came" in m) - sum(m["kept"]["n"] for m in seen if "kept" in m)
        raise ValueError(f"{late} rows came over {wait_days} days late; rebuild the accuracy of their dates")


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session's settings with these, until the end of the block."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def paired(spark: SparkSession, out: str) -> DataFrame:
    """The accuracy rows of all pairs found so far, one a grain."""
    if path_exists(spark, out):
        rows = spark.read.schema(f"{PAIRS}, batch_id long").parquet(out)
    else:
        rows = spark.createDataFrame([], f"{PAIRS}, batch_id long")
    last = F.struct("p_at", "a_at", "batch_id", "predicted_sales", "sales")
    rows = rows.groupBy(*GRAIN).agg(F.max(last).alias("v")).select(*GRAIN, "v.predicted_sales", "v.sales")
    return accuracy_columns(rows)


def accuracy_columns(pairs: DataFrame) -> DataFrame:
    """The columns of J2 and P9 from pairs of predicted and actual sales."""
    err = F.abs(F.col("predicted_sales") - F.col("sales"))
    return pairs.select(*GRAIN, "predicted_sales", F.col("sales").alias("actual_sales"), err.alias("abs_error"),
                        F.when(F.col("sales") > 0, err / F.col("sales")).alias("pct_error"))
