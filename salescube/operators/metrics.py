"""Forecast scores: MAPE, RMSE, RMSSE, weighted RMSSE, per-series accuracy.

Scores are algebraic: each is built from per-series partial sums (count,
sum of squared error, sum of floored percentage error) in one grouped
aggregate, then the partial sums are added up in a second tiny aggregate.
No scalar is joined back with a cross join, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.schemas import GRAIN, ID_COLUMNS, MAPE_EPSILON


# ---- row-level expressions -------------------------------------------------
def floored_pct_error(actual: Column, forecast: Column, epsilon: float = MAPE_EPSILON) -> Column:
    """|y - ŷ| / max(|y|, ε) (A4's summand)."""
    return F.abs(actual - forecast) / F.greatest(F.abs(actual), F.lit(float(epsilon)))


def positive_pct_error(actual: Column, forecast: Column) -> Column:
    """|y - ŷ| / y when y > 0, else NULL."""
    return F.when(actual > 0, F.abs(forecast - actual) / actual)


def dampen(c: Column, how: str | None) -> Column:
    """Weight dampening: None (raw), 'sqrt' or 'log1p'; anything else raises."""
    if how is None or how == "none":
        return c
    if how == "sqrt":
        return F.sqrt(c)
    if how == "log1p":
        return F.log1p(c)
    raise ValueError(f"Unknown dampening: {how!r}")


# ---- joins -----------------------------------------------------------------
def join_actual_forecast(actual: DataFrame, forecast: DataFrame, value: str = "sales") -> DataFrame:
    """Inner join on the grain with suffixed value columns."""
    a = actual.select(*GRAIN, F.col(value).cast("double").alias(f"{value}_actual"))
    f = forecast.select(*GRAIN, F.col(value).cast("double").alias(f"{value}_forecast"))
    return a.join(f, GRAIN, "inner")


# ---- aggregates ------------------------------------------------------------
def score_forecast(actual: DataFrame, forecast: DataFrame, epsilon: float = MAPE_EPSILON) -> DataFrame:
    """One row: mape (ε-floored), rmse, n."""
    m = join_actual_forecast(actual, forecast)
    y, p = F.col("sales_actual"), F.col("sales_forecast")
    return m.agg(F.avg(floored_pct_error(y, p, epsilon)).alias("mape"),
                 F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
                 F.count(F.lit(1)).alias("n"))


def naive_step_scale(train: DataFrame) -> DataFrame:
    """Per series: mean squared first difference (1.0 if none or ≤ 0) and total sales."""
    w = Window.partitionBy(*ID_COLUMNS).orderBy("date")
    x = F.col("sales").cast("double")
    diff = x - F.lag(x, 1).over(w)
    d = train.select(*ID_COLUMNS, x.alias("sales"), diff.alias("diff"))
    scale = F.avg(F.pow("diff", 2))
    return d.groupBy(*ID_COLUMNS).agg(
        F.when(scale > 0, scale).otherwise(F.lit(1.0)).alias("scale"),
        F.sum("sales").alias("total_sales"))


def _series_partials(actual: DataFrame, forecast: DataFrame, train: DataFrame,
                     epsilon: float = MAPE_EPSILON) -> DataFrame:
    m = join_actual_forecast(actual, forecast)
    y, p = F.col("sales_actual"), F.col("sales_forecast")
    per = m.groupBy(*ID_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pow(y - p, 2)).alias("sse"),
        F.sum(floored_pct_error(y, p, epsilon)).alias("spe"))
    scale = naive_step_scale(train)
    # Series without training rows: scale 1.0, total 0.0.
    return (per.join(scale, ID_COLUMNS, "left")
            .select(*ID_COLUMNS, "n", "sse", "spe",
                    F.sqrt(F.col("sse") / F.col("n") / F.coalesce("scale", F.lit(1.0))).alias("rmsse"),
                    F.coalesce(F.col("total_sales"), F.lit(0.0)).alias("total_sales")))


def rmsse_per_series(actual: DataFrame, forecast: DataFrame, train: DataFrame) -> DataFrame:
    """store_id, item_id, rmsse, total_sales."""
    return _series_partials(actual, forecast, train).select(*ID_COLUMNS, "rmsse", "total_sales")


def _wrmsse(r: Column, w: Column) -> Column:
    return F.when(F.sum(w) == 0, F.avg(r)).otherwise(F.sum(r * w) / F.sum(w))


def weighted_rmsse(per_series: DataFrame, weight_col: str = "total_sales") -> DataFrame:
    """One row: sales-weighted mean RMSSE; plain mean when all weights are 0."""
    return per_series.agg(_wrmsse(F.col("rmsse"), F.col(weight_col)).alias("wrmsse"))


def evaluate_predictions(actual: DataFrame, forecast: DataFrame, train: DataFrame) -> DataFrame:
    """One row: mape, rmse, wrmsse, n, n_series (A10) from per-series partial sums."""
    p = _series_partials(actual, forecast, train)
    n = F.sum("n")
    return p.agg((F.sum("spe") / n).alias("mape"),
                 F.sqrt(F.sum("sse") / n).alias("rmse"),
                 _wrmsse(F.col("rmsse"), F.col("total_sales")).alias("wrmsse"),
                 n.alias("n"), F.count(F.lit(1)).alias("n_series"))


def series_weights(train: DataFrame, dampening: str | None = "sqrt") -> DataFrame:
    """Per-row weight from each series' total training sales, dampened."""
    total = F.sum(F.col("sales").cast("double")).over(Window.partitionBy(*ID_COLUMNS))
    return train.select(*GRAIN, "sales", total.alias("total_sales"),
                        dampen(total, dampening).alias("weight"))


def series_accuracy_summary(accuracy: DataFrame) -> DataFrame:
    """Per series over the accuracy window: MAE, MAPE on actual > 0 only, n."""
    y, p = F.col("actual_sales"), F.col("predicted_sales")
    return accuracy.groupBy(*ID_COLUMNS).agg(
        F.avg(F.abs(p - y)).alias("mae"),
        F.avg(positive_pct_error(y, p)).alias("mape"),
        F.count(F.lit(1)).alias("n"))
