import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import long_frame
from salescube.operators import features


def by_series(df, store, item, col):
    rows = df.filter((F.col("store_id") == store) & (F.col("item_id") == item)).orderBy("date").collect()
    return [r[col] for r in rows]


def test_lag_is_row_shift(spark):
    vals = [float(i % 7) for i in range(40)]
    df = long_frame(spark, {("CA_1", "A"): vals, ("CA_1", "B"): vals}, value_type="double")
    out = features.build_features(df)
    lag7 = by_series(out, "CA_1", "A", "sales_lag_7")
    assert lag7[:7] == [None] * 7
    assert lag7[7:] == vals[:-7]


def test_rolling_excludes_current_row(spark):
    vals = [5.0] * 9 + [1000.0]
    out = features.build_features(long_frame(spark, {("CA_1", "A"): vals}, value_type="double"))
    last = out.orderBy(F.col("date").desc()).first()
    assert last["sales_roll_mean_7"] == 5.0
    assert last["sales_roll_std_7"] == 0.0
    first = out.orderBy("date").first()
    assert first["sales_roll_mean_7"] is None and first["sales_roll_std_7"] is None
    second = out.orderBy("date").collect()[1]
    assert second["sales_roll_mean_7"] == 5.0 and second["sales_roll_std_7"] is None


def test_recency(spark):
    out = features.build_features(long_frame(spark, {("CA_1", "A"): [0, 0, 3, 0, 0]}))
    assert by_series(out, "CA_1", "A", "days_since_last_sale") == [0.0, 1.0, 2.0, 0.0, 1.0]


def test_recency_never_crosses_series(spark):
    df = long_frame(spark, {("CA_1", "A"): [5, 0, 0], ("CA_2", "A"): [0, 0, 0]})
    out = features.build_features(df)
    assert by_series(out, "CA_2", "A", "days_since_last_sale") == [0.0, 1.0, 2.0]
    assert by_series(out, "CA_1", "A", "days_since_last_sale") == [0.0, 0.0, 1.0]


def test_optional_columns_and_feature_list(spark):
    rows = []
    for store in ("CA_1", "TX_1"):
        for i in range(5):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((d, store, "A", 1, 2.5, None if i % 2 else 1, "Sporting" if i == 4 else None))
    df = spark.createDataFrame(rows, "date date, store_id string, item_id string, sales long, "
                                     "sell_price double, snap_flag int, event_type_1 string")
    out = features.build_features(df)
    assert out.agg(F.sum("has_event")).first()[0] == 2
    assert out.filter(F.col("snap_flag").isNull()).count() == 0
    assert out.filter(F.col("event_type_1") == "none").count() == 8
    cols, cats = features.feature_columns(out)
    assert cats == ["store_id", "item_id", "event_type_1"]
    assert {"sell_price", "snap_flag", "has_event", "dayofweek", "is_weekend", "month"} <= set(cols)


def test_calendar_monday_zero(spark):
    df = long_frame(spark, {("CA_1", "A"): [1] * 7}, start="2024-01-01")  # a Monday
    out = features.build_features(df)
    assert by_series(out, "CA_1", "A", "dayofweek") == [0, 1, 2, 3, 4, 5, 6]
    assert by_series(out, "CA_1", "A", "is_weekend") == [0, 0, 0, 0, 0, 1, 1]


def test_single_window_exchange(spark):
    out = features.build_features(long_frame(spark, {("CA_1", "A"): [1, 2, 3]}))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_next_day_stub(spark):
    df = long_frame(spark, {("CA_1", "A"): [1, 2], ("CA_1", "B"): [3]})
    out = features.next_day_stub(df)
    stubs = out.filter(F.col("sales").isNull()).collect()
    assert len(stubs) == 2
    assert {r["date"] for r in stubs} == {dt.date(2024, 1, 3)}


def test_densify(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "S", "A", 1), (dt.date(2024, 1, 4), "S", "A", 4),
                                (dt.date(2024, 1, 2), "S", "B", 2)],
                               "date date, store_id string, item_id string, sales long")
    out = features.densify(df, fill={"sales": 0})
    assert out.count() == 8
    assert by_series(out, "S", "A", "sales") == [1, 0, 0, 4]
