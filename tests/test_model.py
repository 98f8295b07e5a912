import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from salescube.operators import model as mdl

def seasonal_history(spark, n_series=6, n_days=90, seed=0):
    """Weekly saw-tooth sales: level 3 * (series + 2) plus twice the day's place in the week, and 0 or 1 of noise."""
    noise = np.random.default_rng(seed).integers(0, 2, (n_series, n_days))
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=day), f"CA_{series % 2}", f"ITEM_{series}",
             3 * (series + 2) + 2 * (day % 7) + int(noise[series, day]))
            for series in range(n_series) for day in range(n_days)]
    return spark.createDataFrame(rows, "date date, store_id string, item_id string, sales long")


def test_train_score_backtest(spark):
    hist = seasonal_history(spark)
    res = mdl.train(hist, valid_days=14, max_iter=5)
    tr_max = res.train.agg(F.max("date")).first()[0]
    va_min = res.valid.agg(F.min("date")).first()[0]
    assert tr_max + dt.timedelta(days=1) == va_min
    m = mdl.training_metrics(res).first()
    assert m["n_series"] == 6 and m["n_valid_rows"] == 6 * 14
    assert 1 <= m["best_iteration"] <= 5
    nxt = mdl.predict_next_day(hist, res.model).collect()
    assert len(nxt) == 6 and all(r["predicted_sales"] >= 0 for r in nxt)
    assert {r["date"] for r in nxt} == {dt.date(2024, 3, 31)}
    targets = spark.createDataFrame([(dt.date(2024, 3, 30),), (dt.date(2024, 3, 29),)], "date date")
    assert mdl.backtest(hist, targets, res.model).count() == 12
    too_early = spark.createDataFrame([(dt.date(2023, 1, 1),)], "date date")
    assert mdl.backtest(hist, too_early, res.model).count() == 0


def test_best_iteration_patience():
    assert mdl.best_iteration([5, 4, 3, 3.5, 4]) == 3
    assert mdl.best_iteration([1.0] + [2.0] * 30, patience=20) == 1


def test_publish_gate_is_strict(spark):
    rows = spark.createDataFrame([(1.0,), (0.99,)], "wrmsse double")
    assert [r["publish"] for r in mdl.publish_gate(rows).collect()] == [False, True]


def test_publish_copies_only_when_gate_passes(spark, tmp_path):
    hist = seasonal_history(spark, n_series=3, n_days=60, seed=1)
    res = mdl.train(hist, valid_days=7, max_iter=3)
    good = spark.createDataFrame([(0.5,)], "wrmsse double")
    bad = spark.createDataFrame([(1.5,)], "wrmsse double")
    assert mdl.publish(res.model, good, str(tmp_path / "ok"))
    assert mdl.load(str(tmp_path / "ok")) is not None
    assert not mdl.publish(res.model, bad, str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()


def test_patience_refits_at_the_best_count(spark):
    res = mdl.train(seasonal_history(spark, n_days=120), valid_days=14, max_iter=12, learning_rate=0.3)
    trees = res.model.pipeline.stages[-1].getNumTrees
    assert trees == res.best_iteration > 1
    assert mdl.training_metrics(res).first()["rmse"] < 3.0   # naive errs by 2 on six days and 12 on one


def test_many_stores_need_no_index(spark):
    rows = spark.range(300 * 60).selectExpr(
        "date_add(date'2024-01-01', cast(id % 60 as int)) AS date", "concat('S', id div 60) AS store_id",
        "'A' AS item_id", "id % 7 + id div 600 AS sales")
    assert mdl.train(rows, valid_days=7, max_iter=2).best_iteration >= 1


def test_next_day_takes_the_last_price(spark):
    hist = seasonal_history(spark, n_series=1, n_days=40).withColumn(
        "sell_price", F.when(F.dayofmonth("date") < 20, 2.5))
    assert mdl.carry_price(hist).where("sell_price is null").count() == 0


def test_training_encodings_leave_the_own_fold_out(spark):
    """Of a store's rows only those on days of other folds count; a key of one fold takes the global mean."""
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=k), "S", "A", 10 * k) for k in range(12)]
    rows += [(dt.date(2024, 1, 1), "T", "A", 6), (dt.date(2024, 1, 1), None, "A", 6)]
    train = spark.createDataFrame(rows, "date date, store_id string, item_id string, sales long")
    fold = {r["date"]: r["f"] for r in train.select(
        "date", F.pmod(F.xxhash64("date"), F.lit(mdl.ENCODING_FOLDS)).alias("f")).collect()}
    prior = sum(r[3] for r in rows) / len(rows)
    got = mdl.out_of_fold(train, ["store_id"]).collect()
    assert len(got) == len(rows)
    for r in got:
        others = [y for d, s, _, y in rows if s == r["store_id"] and fold[d] != fold[r["date"]]]
        want = (sum(others) + 10 * prior) / (len(others) + 10) if r["store_id"] else prior
        assert abs(r["store_id_enc"] - want) < 1e-9
