import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import long_frame
from salescube.operators import marts, quality, refresh
from salescube.schemas import GRAIN, SALES_DAILY_FEED_RAW
from salescube.sources.io import replace_partitions
from salescube.streaming.accuracy import SLICES, accuracy_columns, paired, run_accuracy_stream
from salescube.streaming.levelled import LevelledLanding

JAN = dt.date(2024, 1, 1)


def deliver(spark, src, rows):
    spark.createDataFrame(rows, SALES_DAILY_FEED_RAW).coalesce(1).write.mode("append").parquet(src)


def values(df):
    return {(r["date"].day, r["store_id"], r["item_id"]): (r["sales"], r["sell_price"]) for r in df.collect()}


def day(n):
    return JAN + dt.timedelta(days=n)


def test_levelled_landing_equals_the_last_delivery(spark, tmp_path):
    src = str(tmp_path / "src")
    landing = LevelledLanding(spark, str(tmp_path / "root"), SALES_DAILY_FEED_RAW, fan_in=2)
    assert landing.current().count() == 0 and landing.last_batch() == -1
    expected = {}
    for i in range(7):
        rows = [(day(d), "S", item, 100 * i + d, str(i)) for d in (i, i + 1) for item in ("A", None)]
        expected |= {(r[0].day, r[1], r[2]): (r[3], r[4]) for r in rows}
        deliver(spark, src, rows)
        landing.ingest(src)
        assert values(landing.current()) == expected
    landing.ingest(src)             # nothing new
    assert values(landing.current()) == expected
    version, state = landing.log.read()
    # Batches 0 to 5 are settled: six runs of one batch became one of four and one of two.
    assert version == 6 and {r["settled"] for r in state} == {5}
    assert sorted(r["level"] for r in state) == [1, 2]
    assert landing.changes(5).count() == 4


def test_a_read_opens_the_runs_and_the_new_batches_only(spark, tmp_path):
    src = str(tmp_path / "src")
    landing = LevelledLanding(spark, str(tmp_path / "root"), SALES_DAILY_FEED_RAW, fan_in=2)
    for i in range(4):
        deliver(spark, src, [(day(0), "S", "A", i, "1")])
        landing.ingest(src)
    plan = landing.current()._jdf.queryExecution().executedPlan().toString()
    assert "(batch_id#" in plan.split("PartitionFilters: [isnotnull(batch_id")[1].split("]")[0]
    assert "> 2)" in plan.split("PartitionFilters: [isnotnull(batch_id")[1].split("]")[0]
    assert values(landing.current()) == {(1, "S", "A"): (3, "1")}


def test_settling_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    landing = LevelledLanding(spark, str(tmp_path / "root"), SALES_DAILY_FEED_RAW, fan_in=2)
    for i in range(3):
        deliver(spark, src, [(day(0), "S", "A", i, "1"), (day(i), "S", "B", i, "1")])
        if i == 2:
            with monkeypatch.context() as m:
                m.setattr(landing.log, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(Exception):
                    landing.ingest(src)
        landing.ingest(src)
    assert values(landing.current()) == {(1, "S", "A"): (2, "1"), (1, "S", "B"): (0, "1"),
                                         (2, "S", "B"): (1, "1"), (3, "S", "B"): (2, "1")}
    version, state = landing.log.read()
    assert version == 2 and [r["level"] for r in state] == [1]


def test_only_touched_months_are_rebuilt(spark, tmp_path):
    fact = long_frame(spark, {("S", "A"): list(range(100)), ("S", "B"): list(range(100, 200))}, start="2024-01-01")
    path = str(tmp_path / "fact")
    replace_partitions(fact.withColumn(refresh.MONTH, F.trunc("date", "month")), path, refresh.MONTH)

    def files():
        return {(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    before = files()
    changes = spark.createDataFrame([(dt.date(2024, 2, 27),), (None,)], "date date")
    assert refresh.touched_months(changes) == [dt.date(2024, 2, 1)]
    months = refresh.touched_months(changes, 7)
    assert months == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    corrected = fact.withColumn("sales", F.when(F.col("date") == "2024-02-27", 7).otherwise(F.col("sales")))
    refresh.refresh_months(path, months, lambda m: corrected.where(refresh.in_months(m)))
    kept = {d[-10:] for d, f in before & files()}
    assert kept == {"2024-01-01", "2024-04-01"}
    back = spark.read.parquet(path).select(*GRAIN, "sales")
    assert back.exceptAll(corrected).isEmpty() and corrected.exceptAll(back).isEmpty()
    refresh.refresh_months(path, [], lambda m: 1 / 0)      # nothing changed, nothing built


def test_week_ago_predictions_count_days_not_rows(spark):
    rows = spark.createDataFrame([(day(0), "S", "A", 5), (day(7), "S", "A", 6), (day(15), "S", "A", 7)],
                                 "date date, store_id string, item_id string, sales long")
    out = {r["date"]: r["predicted_sales"] for r in refresh.week_ago_predictions(rows).collect()}
    assert out == {day(0): 0.0, day(7): 5.0, day(15): 0.0}


PRED = "date date, store_id string, item_id string, predicted_sales double"
ACT = "date date, store_id string, item_id string, sales long"


class Waiting:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.preds, self.actuals = str(tmp_path / "preds"), str(tmp_path / "actuals")
        self.out, self.ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
        os.makedirs(self.preds), os.makedirs(self.actuals)

    def add(self, path, rows, schema):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def run(self, **kw):
        run_accuracy_stream(self.spark, self.preds, self.actuals, self.out, self.ckpt, **kw)
        return {(r["date"], r["item_id"]): (r["predicted_sales"], r["actual_sales"], r["pct_error"])
                for r in paired(self.spark, self.out).collect()}


def test_predictions_wait_for_their_actuals(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    w.add(w.preds, [(day(d), "S", i, float(d)) for d in range(4) for i in ("A", None)], PRED)
    assert w.run() == {}
    w.add(w.actuals, [(day(0), "S", "A", 2), (day(1), "S", None, 2)], ACT)
    assert w.run() == {(day(0), "A"): (0.0, 2, 1.0)}
    w.add(w.actuals, [(day(1), "S", "A", 0), (day(9), "S", "A", 1)], ACT)
    first_two = {(day(0), "A"): (0.0, 2, 1.0), (day(1), "A"): (1.0, 0, None)}
    assert w.run() == first_two
    assert w.run() == first_two          # a run with nothing new, from the stored state
    # An actual that is there before its prediction, and a corrected actual.
    w.add(w.preds, [(day(9), "S", "A", 3.0)], PRED)
    w.add(w.actuals, [(day(0), "S", "A", 4)], ACT)
    out = w.run()
    assert out == {(day(0), "A"): (0.0, 4, 1.0), (day(1), "A"): (1.0, 0, None), (day(9), "A"): (3.0, 1, 2.0)}
    batch = marts.prediction_accuracy(
        spark.read.parquet(w.preds),
        spark.read.parquet(w.actuals).groupBy(*GRAIN).agg(F.max("sales").alias("sales")))
    assert accuracy_columns(batch.withColumnRenamed("actual_sales", "sales")).count() == len(out)


def test_rows_behind_the_watermark_are_an_error(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    w.add(w.preds, [(day(60), "S", "A", 1.0)], PRED)
    w.add(w.actuals, [(day(60), "S", "A", 1)], ACT)
    assert len(w.run(wait_days=5)) == 1
    w.add(w.preds, [(day(61), "S", "A", 1.0)], PRED)
    w.add(w.actuals, [(day(61), "S", "A", 1)], ACT)
    w.run(wait_days=5)
    w.add(w.actuals, [(day(1), "S", "A", 1)], ACT)
    with pytest.raises(ValueError, match="late"):
        w.run(wait_days=5)


def test_checked_write_counts_and_sets_aside(spark, tmp_path):
    rows = ([(day(0), "S", "A", 1)] * 200 + [(day(d), "S", "B", d) for d in range(5)]
            + [(None, "S", "A", 1), (None, None, "A", 1), (day(0), "S", "A", 2)])
    path = str(tmp_path / "t")
    seen = quality.write_checked(spark.createDataFrame(rows, ACT), path, ["date", "store_id"], unique=GRAIN)
    assert seen == {"rows": 208, "not_null:date": 2, "not_null:store_id": 1, "unique:date,store_id,item_id": 200}
    back = spark.read.parquet(path)
    clean = back.where("status = 'clean'")
    assert clean.count() == 6 and clean.select(*GRAIN).distinct().count() == 6
    assert back.where("status = 'quarantine'").count() == 202
    assert back.where("size(violations) = 2").select("date", "store_id").collect() == [(None, None)]


def test_checked_write_without_rows_or_rules(spark, tmp_path):
    none = spark.createDataFrame([], ACT)
    assert quality.write_checked(none, str(tmp_path / "a"), ["date"], unique=GRAIN)["rows"] == 0
    one = spark.createDataFrame([(None, "S", "A", 1)], ACT)
    assert quality.write_checked(one, str(tmp_path / "b"), []) == {"rows": 1}
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1


def test_waiting_rows_lie_in_rocksdb_and_settings_come_back(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    w = Waiting(spark, tmp_path)
    w.add(w.preds, [(day(0), "S", "A", 1.0)], PRED)
    w.add(w.actuals, [(day(0), "S", "A", 1)], ACT)
    assert len(w.run()) == 1 and spark.conf.get(key) == before
    stored = [f for _, _, fs in os.walk(f"{w.ckpt}/state") for f in fs]
    assert any(f.endswith(".changelog") for f in stored) and not any(f.endswith(".delta") for f in stored)


def test_waiting_rows_of_a_day_share_packets(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    n = 4 * SLICES
    w.add(w.preds, [(day(d), "S", f"I{i}", float(i)) for d in range(2) for i in range(n)], PRED)
    w.add(w.actuals, [(day(0), "S", f"I{i}", i + 1) for i in range(n // 2)], ACT)
    first = w.run()
    assert first == {(day(0), f"I{i}"): (float(i), i + 1, 1 / (i + 1)) for i in range(n // 2)}
    assert spark.read.format("statestore").load(w.ckpt).count() <= 2 * SLICES
    # Packets of the day are read and written again; only the grains with new rows are paired.
    w.add(w.actuals, [(day(0), "S", "I0", 3), (day(0), "S", f"I{n - 1}", n - 1)], ACT)
    assert w.run() == first | {(day(0), "I0"): (0.0, 3, 1.0), (day(0), f"I{n - 1}"): (n - 1.0, n - 1, 0.0)}
    assert spark.read.parquet(w.out).count() == n // 2 + 2


def test_rows_that_come_twice_and_values_that_are_null(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    w.add(w.preds, [(day(0), "S", "A", 1.0), (day(0), "S", "A", 2.0), (day(0), "S", "B", None),
                    (None, "S", "A", 1.0), (day(0), None, "A", 1.0)], PRED)
    w.add(w.actuals, [(day(0), "S", "A", 1), (day(0), "S", "A", 1), (day(0), "S", "B", 1), (None, "S", "A", 1),
                      (day(0), None, "A", 1)], ACT)
    assert w.run() == {(day(0), "A"): (2.0, 1, 1.0), (day(0), "B"): (None, 1, None)}


def test_the_error_counts_late_rows_not_packets(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    for path, rows, schema in ((w.preds, [(day(60), "S", "A", 1.0)], PRED), (w.actuals, [(day(60), "S", "A", 1)], ACT)):
        w.add(path, rows, schema)
    w.run(wait_days=5)
    w.add(w.actuals, [(day(1), "S", "A", 1), (day(1), "S", "A", 2), (day(58), "S", "A", 1)], ACT)
    with pytest.raises(ValueError, match="^2 rows"):
        w.run(wait_days=5)


def test_the_side_that_is_behind_sets_what_is_late(spark, tmp_path):
    w = Waiting(spark, tmp_path)
    w.add(w.preds, [(day(d), "S", "A", float(d)) for d in (7, 100)], PRED)
    w.add(w.actuals, [(day(10), "S", "A", 1)], ACT)
    assert w.run(wait_days=5) == {}
    w.add(w.actuals, [(day(7), "S", "A", 7)], ACT)
    assert w.run(wait_days=5) == {(day(7), "A"): (7.0, 7, 0.0)}
