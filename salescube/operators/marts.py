"""Mart layer: dimensions, the sales fact, prediction accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.schemas import GRAIN, SNAP_COLUMN_BY_STATE


def dim_item(stg_history: DataFrame) -> DataFrame:
    return stg_history.select("item_id", "dept_id", "cat_id").distinct()


def dim_store(stg_history: DataFrame) -> DataFrame:
    return stg_history.select("store_id", "state_id").distinct()


def dim_calendar(stg_calendar: DataFrame) -> DataFrame:
    return stg_calendar.select("date", "wm_yr_wk", "weekday", "wday", "month", "year",
                               "event_name_1", "event_type_1", "event_name_2", "event_type_2",
                               "snap_ca", "snap_tx", "snap_wi")


def snap_for_state(state: str = "state_id") -> F.Column:
    """Simple CASE on the state without ELSE: other states get NULL."""
    expr = None
    for st, col in SNAP_COLUMN_BY_STATE.items():
        cond = F.col(state) == st
        expr = F.when(cond, F.col(col)) if expr is None else expr.when(cond, F.col(col))
    return expr


def fct_sales(stg_sales: DataFrame, calendar: DataFrame, stores: DataFrame,
              prices: DataFrame, by_series: bool = False) -> DataFrame:
    """Sales ⟕ calendar on date ⟕ stores on store ⟕ prices on (store, item, week).

    Calendar (bounded by the day span) and stores (bounded by the store
    count) are small dimension sides; prices grows with series × weeks and is
    joined by sort-merge unless AQE measures it small. Feed rows carry their
    own price, history rows fall back to the weekly price (P7).

    ``by_series``: sales and prices lie by series in the same places and meet
    there; a row then looks through its own series' weeks, which the calendar
    bounds.
    """
    cal = calendar.select("date", "wm_yr_wk", "wday", "month", "year", "event_name_1",
                          "event_type_1", "snap_ca", "snap_tx", "snap_wi")
    s = (stg_sales.withColumnRenamed("sell_price", "feed_price")
         .join(cal, "date", "left")
         .join(stores.select("store_id", "state_id"), "store_id", "left"))
    p = prices.select("store_id", "item_id", "wm_yr_wk", F.col("sell_price").alias("week_price"))
    if by_series:
        # A week as a span of one: with it among the equal keys, both sides would be shuffled by all three.
        p = p.withColumnsRenamed({c: f"p_{c}" for c in ("store_id", "item_id", "wm_yr_wk")}).hint("shuffle_hash")
        joined = s.join(p, (F.col("store_id") == F.col("p_store_id")) & (F.col("item_id") == F.col("p_item_id"))
                        & F.col("wm_yr_wk").between(F.col("p_wm_yr_wk"), F.col("p_wm_yr_wk")), "left")
    else:
        joined = s.join(p, ["store_id", "item_id", "wm_yr_wk"], "left")
    return joined.select(
        "date", "store_id", "item_id", "sales",
        F.coalesce(F.col("feed_price"), F.col("week_price")).alias("sell_price"),
        "wday", "month", "year", "event_name_1", "event_type_1",
        snap_for_state().alias("snap_flag"))


def prediction_accuracy(predictions: DataFrame, fct: DataFrame) -> DataFrame:
    """Predictions ⋈ actuals on the grain; pct_error NULL unless actual > 0."""
    actual = fct.select(*GRAIN, F.col("sales").alias("actual_sales"))
    j = predictions.select(*GRAIN, "predicted_sales").join(actual, GRAIN, "inner")
    abs_err = F.abs(F.col("predicted_sales") - F.col("actual_sales"))
    return j.select(*GRAIN, "predicted_sales", "actual_sales", abs_err.alias("abs_error"),
                    F.when(F.col("actual_sales") > 0, abs_err / F.col("actual_sales"))
                    .alias("pct_error"))


def accuracy_daily(accuracy: DataFrame) -> DataFrame:
    """Per-date count, MAE, NULL-skipping MAPE and RMSE (A2)."""
    err = F.col("predicted_sales") - F.col("actual_sales")
    return accuracy.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg("abs_error").alias("mae"),
        F.avg("pct_error").alias("mape"),
        F.sqrt(F.avg(F.pow(err, 2))).alias("rmse"))
