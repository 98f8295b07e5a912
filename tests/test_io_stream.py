import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import long_frame
from salescube.schemas import SALES_DAILY_FEED_RAW, SALES_HISTORY
from salescube.sources import io
from salescube.streaming.feed import latest_feed, run_feed_stream


def test_replace_partitions_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "preds")
    preds = long_frame(spark, {("S", "A"): [1.0, 2.0, 3.0], ("S", "B"): [4.0, 5.0, 6.0]},
                       value_type="double").withColumnRenamed("sales", "predicted_sales")
    io.replace_partitions(preds, path)
    redo = preds.filter(F.col("date") == dt.date(2024, 1, 3)).withColumn("predicted_sales", F.lit(0.0))
    io.replace_partitions(redo, path)
    io.replace_partitions(redo, path)
    out = {(r["date"], r["item_id"]): r["predicted_sales"] for r in spark.read.parquet(path).collect()}
    assert len(out) == 6
    assert out[(dt.date(2024, 1, 1), "A")] == 1.0 and out[(dt.date(2024, 1, 3), "B")] == 0.0


def test_append_evolve_reads_null_for_old_rows(spark, tmp_path):
    path = str(tmp_path / "feed")
    old = long_frame(spark, {("S", "A"): [1, 2]})
    new = long_frame(spark, {("S", "A"): [3]}, start="2024-01-03").withColumn("sell_price", F.lit(2.5))
    io.append_evolve(old, path)
    io.append_evolve(new, path)
    rows = sorted(io.read_evolving(spark, path).collect(), key=lambda r: r["date"])
    assert [r["sell_price"] for r in rows] == [None, None, 2.5]


def test_csv_round_trip_with_declared_schema(spark, tmp_path):
    hist = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=d), "CA_1", "A", "D", "C", "CA", d)
                                  for d in range(39)], SALES_HISTORY)
    csv, table = str(tmp_path / "csv"), str(tmp_path / "table")
    io.write_long_history(hist, csv, fmt="csv")
    io.append_csv_to_table(spark, csv, SALES_HISTORY, table)
    back = spark.read.parquet(table)
    assert back.count() == 39 and back.schema == SALES_HISTORY


def test_feed_stream_late_delivery_replaces_only_its_grain(spark, tmp_path):
    src, landing, ckpt = (str(tmp_path / "src"), str(tmp_path / "landing"), str(tmp_path / "ckpt"))
    rows = [(dt.date(2024, 1, d), s, "A", d, "3.50") for d in (1, 2) for s in ("S1", "S2")]
    spark.createDataFrame(rows, SALES_DAILY_FEED_RAW).write.partitionBy("date").parquet(src)
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    # A late corrected file for one series of day 2.
    fix = [(dt.date(2024, 1, 2), "S1", "A", 99, "n/a")]
    spark.createDataFrame(fix, SALES_DAILY_FEED_RAW).write.mode("append").partitionBy("date").parquet(src)
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    # Re-running with nothing new is a no-op.
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    out = {(r["date"].day, r["store_id"]): r["sales"] for r in latest_feed(spark, landing).collect()}
    assert out == {(1, "S1"): 1, (1, "S2"): 1, (2, "S1"): 99, (2, "S2"): 2}
    assert len([d for d in os.listdir(landing) if d.startswith("batch_id=")]) == 2


def test_two_deliveries_in_one_run_keep_the_later(spark, tmp_path):
    src, landing, ckpt = (str(tmp_path / "src"), str(tmp_path / "landing"), str(tmp_path / "ckpt"))
    for at, value in enumerate((5, 99, 42)):
        row = [(dt.date(2024, 1, 1), "S1", "A", value, "3.50")]
        before = {os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs}
        spark.createDataFrame(row, SALES_DAILY_FEED_RAW).write.mode("append").partitionBy("date").parquet(src)
        for d, _, fs in os.walk(src):
            for f in fs:
                if os.path.join(d, f) not in before:
                    os.utime(os.path.join(d, f), (1_700_000_000 + at * 60,) * 2)
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    assert [r["sales"] for r in latest_feed(spark, landing).collect()] == [42]
