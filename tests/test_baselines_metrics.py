import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import long_frame
from salescube.operators import baselines, metrics


def test_naive_repeats_last_value(spark):
    hist = long_frame(spark, {("CA_1", "A"): [i % 7 for i in range(14)],
                              ("CA_1", "B"): [i % 7 for i in range(14)]})
    fc = baselines.naive_forecast(hist, 5).filter("item_id = 'A'").orderBy("date").collect()
    assert [r["sales"] for r in fc] == [6] * 5
    assert fc[0]["date"] == dt.date(2024, 1, 15)


def test_seasonal_naive_cycles_last_week(spark):
    hist = long_frame(spark, {("CA_1", "A"): [i % 7 for i in range(14)]})
    fc = baselines.seasonal_naive_forecast(hist, 7).orderBy("date").collect()
    assert [r["sales"] for r in fc] == [0, 1, 2, 3, 4, 5, 6]


def test_seasonal_naive_short_history(spark):
    hist = long_frame(spark, {("CA_1", "A"): [3, 5], ("CA_1", "B"): [1, 2]})
    fc = baselines.seasonal_naive_forecast(hist, 3)
    assert fc.count() == 6
    assert [r["sales"] for r in fc.filter("item_id = 'A'").orderBy("date").collect()] == [3, 5, 3]


def test_score_pair(spark):
    actual = long_frame(spark, {("CA_1", "A"): [10, 20]})
    fc = long_frame(spark, {("CA_1", "A"): [8, 22]})
    r = metrics.score_forecast(actual, fc).first()
    assert r["n"] == 2
    assert r["rmse"] == pytest.approx(2.0)
    assert r["mape"] == pytest.approx(0.15)


def test_mape_epsilon_floor(spark):
    actual = long_frame(spark, {("CA_1", "A"): [0]})
    fc = long_frame(spark, {("CA_1", "A"): [1]})
    assert metrics.score_forecast(actual, fc).first()["mape"] == pytest.approx(1.0)


def test_rmsse_perfect(spark):
    train = long_frame(spark, {("CA_1", "A"): [1, 2, 3, 4, 5]})
    actual = long_frame(spark, {("CA_1", "A"): [6, 7]}, start="2024-01-06")
    r = metrics.rmsse_per_series(actual, actual, train).first()
    assert r["rmsse"] == 0.0 and r["total_sales"] == 15.0


def test_rmsse_constant_train_scale_falls_back(spark):
    train = long_frame(spark, {("CA_1", "A"): [3, 3, 3, 3, 3]})
    actual = long_frame(spark, {("CA_1", "A"): [3]}, start="2024-01-06")
    fc = long_frame(spark, {("CA_1", "A"): [5]}, start="2024-01-06")
    assert metrics.rmsse_per_series(actual, fc, train).first()["rmsse"] == pytest.approx(2.0)


def test_weighted_rmsse(spark):
    per = spark.createDataFrame([("S", "A", 0.0, 100.0), ("S", "B", 2.0, 0.0)],
                                "store_id string, item_id string, rmsse double, total_sales double")
    assert metrics.weighted_rmsse(per).first()["wrmsse"] == 0.0
    zero = spark.createDataFrame([("S", "A", 1.0, 0.0), ("S", "B", 3.0, 0.0)],
                                 "store_id string, item_id string, rmsse double, total_sales double")
    assert metrics.weighted_rmsse(zero).first()["wrmsse"] == 2.0


def test_evaluate_predictions_one_row(spark):
    train = long_frame(spark, {("CA_1", "A"): [1, 2, 3], ("CA_1", "B"): [2, 2, 4]})
    actual = long_frame(spark, {("CA_1", "A"): [10, 20], ("CA_1", "B"): [1, 1]}, start="2024-01-04")
    fc = long_frame(spark, {("CA_1", "A"): [8, 22], ("CA_1", "B"): [1, 1]}, start="2024-01-04")
    r = metrics.evaluate_predictions(actual, fc, train).first()
    assert r["n"] == 4 and r["n_series"] == 2
    assert r["rmse"] == pytest.approx(math.sqrt(8 / 4))


def test_series_weights(spark):
    train = long_frame(spark, {("CA_1", "A"): [10, 10, 10], ("CA_1", "B"): [1, 1, 1]})
    raw = {r["item_id"]: r["weight"] for r in metrics.series_weights(train, None).collect()}
    sq = {r["item_id"]: r["weight"] for r in metrics.series_weights(train, "sqrt").collect()}
    assert raw == {"A": 30.0, "B": 3.0}
    assert sq["A"] > sq["B"] and sq["A"] / sq["B"] < 10
    with pytest.raises(ValueError):
        metrics.dampen(F.col("x"), "cube")


def test_log1p_dampening(spark):
    got = spark.createDataFrame([(0.0,), (math.e - 1,)], "x double").select(
        metrics.dampen(F.col("x"), "log1p").alias("w")).collect()
    assert [r["w"] for r in got] == pytest.approx([0.0, 1.0])


def test_same_phase_mean_reference_phase(spark):
    vals = list(range(60))
    hist = long_frame(spark, {("CA_1", "A"): vals})
    last = baselines.same_phase_mean(hist, phase="last").first()["baseline"]
    assert last == pytest.approx(sum([59, 52, 45, 38, 31, 24, 17, 10]) / 8)
    tgt = baselines.same_phase_mean(hist, phase="target").first()["baseline"]
    assert tgt == pytest.approx(sum([53, 46, 39, 32, 25, 18, 11, 4]) / 8)


def test_next_day_table_price_carry_forward(spark):
    rows = []
    for item, prices in (("A", [3.5] * 26 + [None, None]), ("B", [None] * 28)):
        for i in range(28):
            rows.append((dt.date(2024, 1, 1) + dt.timedelta(days=i), "CA_1", item, 10 + i % 7, prices[i]))
    hist = spark.createDataFrame(rows, "date date, store_id string, item_id string, sales long, sell_price double")
    out = {r["item_id"]: r for r in baselines.next_day_table(hist).collect()}
    assert len(out) == 2
    assert out["A"]["sell_price"] == 3.5 and out["B"]["sell_price"] is None
    assert out["A"]["sales"] >= 0 and out["A"]["date"] == dt.date(2024, 1, 29)


def test_time_split(spark):
    hist = long_frame(spark, {("CA_1", "A"): list(range(90))})
    tr, va = baselines.time_split(hist, 28)
    assert tr.agg(F.max("date")).first()[0] + dt.timedelta(days=1) == va.agg(F.min("date")).first()[0]
    assert va.count() == 28


def test_same_phase_forecast_reads_history_only(spark):
    # Three weeks of the weekday's number, the first week ten higher; a series of three days.
    values = [i % 7 + (10 if i < 7 else 0) for i in range(21)]
    hist = long_frame(spark, {("S", "A"): values})
    short = long_frame(spark, {("S", "B"): [3, 6, 4]}, start="2024-01-19")
    out = baselines.same_phase_forecast(hist.unionByName(short), 9, weeks=2).orderBy("date")
    a = [r["predicted_sales"] for r in out.where("item_id = 'A'").collect()]
    assert a == [0, 1, 2, 3, 4, 5, 6, 0, 1]
    b = [r["predicted_sales"] for r in out.where("item_id = 'B'").collect()]
    assert b == [4, 4, 4, 4, 3, 6, 4, 4, 4]
    assert out.first()["date"] == dt.date(2024, 1, 22)


def test_same_phase_forecast_rounds_half_to_even_and_takes_no_rows(spark):
    hist = long_frame(spark, {("S", "A"): [1, 0, 0, 0, 0, 0, 0, 2, 0, 0, 0, 0, 0, 0]})
    assert baselines.same_phase_forecast(hist, 1).collect()[0]["predicted_sales"] == 2
    assert baselines.same_phase_forecast(hist.limit(0), 3).count() == 0


def test_catch_up_feeds_each_week_to_the_next_and_carries_prices(spark):
    # Three weeks of the weekday's number, the first week ten higher; weeks=2 averages the last two weeks.
    values = [i % 7 + (10 if i < 7 else 0) + (4 if i >= 14 else 0) for i in range(21)]
    hist = long_frame(spark, {("S", "A"): values}).withColumn(
        "sell_price", F.when(F.col("date") == "2024-01-20", 2.5).cast("double"))
    out = baselines.catch_up(hist, 14, weeks=2).orderBy("date").collect()
    assert [r["date"] for r in out] == [dt.date(2024, 1, 22) + dt.timedelta(days=i) for i in range(14)]
    # First week: the mean of k and k + 4; second: that of k + 4 and the generated k + 2.
    assert [r["sales"] for r in out] == [k + 2 for k in range(7)] + [k + 3 for k in range(7)]
    assert {r["sell_price"] for r in out} == {2.5}


def test_daily_catch_up_returns_every_day_of_every_series():
    import __spark_entry__ as E
    sql = E.oracle_sql()
    assert "b2_tail" in sql["daily_catch_up"] and "sell_price" in sql["daily_catch_up"].rsplit("SELECT b.date", 1)[1]
    assert "catch_up_scores" in sql
