import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import long_frame
from salescube.functions import dates
from salescube.operators import marts, quality, reads, staging
from salescube.schemas import FCT_SALES, SALES_HISTORY


def test_melt_wide_sales(spark):
    wide = spark.createDataFrame(
        [("FOODS_2_007", "FOODS_2", "FOODS", "TX_3", "TX", 11, 0, 4, 8),
         ("FOODS_2_009", "FOODS_2", "FOODS", "WI_2", "WI", None, 6, 2, 8)],
        "item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "d_1 long, d_2 long, d_3 long, d_4 long")
    cal = spark.createDataFrame([(f"d_{i}", dt.date(2019, 7, 3 + i)) for i in (1, 2, 3)], "d string, date date")
    out = staging.melt_sales(wide, cal)
    assert out.count() == 6   # the fourth day is past the calendar
    assert out.columns == ["date", "store_id", "item_id", "dept_id", "cat_id", "state_id", "sales"]
    got = {(r["item_id"], r["date"].day): r["sales"] for r in out.collect()}
    assert [got["FOODS_2_007", d] for d in (4, 5, 6)] == [11, 0, 4]
    assert [got["FOODS_2_009", d] for d in (4, 5, 6)] == [None, 6, 2]


def test_safe_cast_and_union(spark):
    hist = spark.createDataFrame([(dt.date(2011, 1, 1), "CA_1", "A", "D", "C", "CA", 2)], SALES_HISTORY)
    feed = spark.createDataFrame([(dt.date(2011, 1, 2), "CA_1", "A", 3, "n/a"), (dt.date(2011, 1, 3), "CA_1", "A", 4, "3.50")],
                                 "date date, store_id string, item_id string, sales long, sell_price string")
    u = staging.stg_sales(staging.stg_sales_history(hist, 7), staging.stg_sales_daily_feed(feed, 7)).orderBy("date").collect()
    assert [r["sell_price"] for r in u] == [None, None, 3.5]
    assert u[0]["date"] == dt.date(2011, 1, 8)
    with pytest.raises(ValueError):
        dates.shift_days(F.col("date"), 5)


def test_fct_sales_snap_case_and_price_fallback(spark):
    sales = spark.createDataFrame([(dt.date(2024, 1, 1), "CA_1", "A", 1, None), (dt.date(2024, 1, 1), "XX_1", "A", 2, 9.0)],
                                  "date date, store_id string, item_id string, sales long, sell_price double")
    cal = spark.createDataFrame([(dt.date(2024, 1, 1), 100, 1, 1, 2024, None, None, 1, 0, 0)],
                                "date date, wm_yr_wk int, wday long, month int, year int, event_name_1 string, "
                                "event_type_1 string, snap_ca long, snap_tx long, snap_wi long")
    stores = spark.createDataFrame([("CA_1", "CA"), ("XX_1", "XX")], "store_id string, state_id string")
    prices = spark.createDataFrame([("CA_1", "A", 100, 2.5), ("XX_1", "A", 100, 1.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    out = {r["store_id"]: r for r in marts.fct_sales(sales, cal, stores, prices).collect()}
    assert out["CA_1"]["snap_flag"] == 1 and out["CA_1"]["sell_price"] == 2.5
    assert out["XX_1"]["snap_flag"] is None and out["XX_1"]["sell_price"] == 9.0
    assert quality.schema_problems(marts.fct_sales(sales, cal, stores, prices), FCT_SALES) == []


def test_gap_list(spark):
    def gl(latest, target, cap=14):
        return [r["date"] for r in dates.missing_days(spark, latest, target, cap).collect()]
    assert gl("2024-07-10", "2024-07-10") == []
    assert gl("2024-07-10", "2024-07-09") == []
    assert gl("2024-07-10", "2024-07-11") == [dt.date(2024, 7, 11)]
    assert gl("2024-07-10", "2024-07-13") == [dt.date(2024, 7, d) for d in (11, 12, 13)]
    assert gl("2024-01-01", "2024-03-01", 5) == [dt.date(2024, 1, d) for d in range(2, 7)]


def test_backfill_targets(spark):
    out = [r["date"] for r in dates.backfill_targets(spark, "2026-07-14", 14).collect()]
    assert out == [dt.date(2026, 7, d) for d in range(1, 15)]
    assert dates.resolve_date_range(None, "2024-12-31") == (dt.date(2023, 1, 1), dt.date(2024, 12, 31))


def test_active_series_and_tail(spark):
    active = [1] * 60
    dormant = [1] * 15 + [0] * 45
    fct = long_frame(spark, {("CA_1", "A"): active, ("CA_1", "B"): dormant})
    assert [(r["store_id"], r["item_id"]) for r in reads.active_series(fct).collect()] == [("CA_1", "A")]
    hist = reads.series_history(fct, 10)
    assert hist.filter("item_id = 'A'").count() == 10
    assert hist.filter("item_id = 'A'").agg(F.max("date")).first()[0] == "2024-02-29"


def test_accuracy_marts(spark):
    fct = long_frame(spark, {("CA_1", "A"): [5, 5, 5], ("CA_1", "B"): [0, 1, 2]})
    preds = long_frame(spark, {("CA_1", "A"): [7.0, 7.0, 7.0], ("CA_1", "B"): [2.0, 3.0, 4.0]}, value_type="double") \
        .withColumnRenamed("sales", "predicted_sales")
    old = spark.createDataFrame([(dt.date(2023, 9, 1), "CA_1", "A", 1.0)],
                                "date date, store_id string, item_id string, predicted_sales double")
    acc = marts.prediction_accuracy(preds.unionByName(old), fct)
    daily = marts.accuracy_daily(acc).orderBy("date").collect()
    assert len(daily) == 3
    assert all(r["n_predictions"] == 2 and r["mae"] == 2.0 and r["rmse"] == 2.0 for r in daily)
    assert daily[0]["mape"] == pytest.approx(0.4)  # only actual > 0 rows count
    recent = reads.series_accuracy(acc, 90)
    assert recent.count() == 6


def test_labels(spark):
    s = spark.createDataFrame([("CA_1", "FOODS_3_090"), ("AFRICA", "Brand#1")], "store_id string, item_id string")
    out = {r["store_id"]: r["label"] for r in reads.series_labels(s).collect()}
    assert out["CA_1"] == "California · Store 1 — Foods · Dept 3 · Item 090"
    assert out["AFRICA"] == "AFRICA — Brand#1"


def test_quality_report_counts_duplicates(spark):
    fct = spark.createDataFrame([(dt.date(2024, 1, 1), "S", "A", 1), (dt.date(2024, 1, 1), "S", "A", None)],
                                "date date, store_id string, item_id string, sales long")
    rep = {(r["check"], r["column"]): r["failures"] for r in quality.quality_report({"fct_sales": fct}).collect()}
    assert rep[("unique", "date,store_id,item_id")] == 1
    assert rep[("not_null", "sales")] == 1
    with pytest.raises(ValueError):
        quality.require_columns(fct, ["sell_price"])
