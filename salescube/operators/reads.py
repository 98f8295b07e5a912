"""Read-side tables: active series, trailing history, point lookup, labels, profiles
(A3, A13, J6, P16, P19, P20, R1-R5, S2, S5).

Every read is a table job over all series at once; a single-series read is
a pushed-down filter on the same table (P16), never a driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescube.schemas import (CATEGORY_NAMES, GRAIN, HISTORY_DAYS, ID_COLUMNS,
                               RECENT_ACCURACY_DAYS, RECENT_ACTIVITY_DAYS, STATE_NAMES)


def _as_of(df: DataFrame, as_of) -> Column:
    return df.agg(F.max("date")).scalar() if as_of is None else F.lit(as_of).cast("date")


def active_series(fct: DataFrame, days: int = RECENT_ACTIVITY_DAYS, as_of=None) -> DataFrame:
    """Series with SUM(sales) > 0 over the `days` days ending at as_of.

    `date > as_of - days` (exactly `days` days); as_of defaults to max(date).
    """
    start = F.date_sub(_as_of(fct, as_of), days)
    return (fct.filter(F.col("date") > start).groupBy(*ID_COLUMNS)
            .agg(F.sum("sales").alias("total_sales"))
            .filter(F.col("total_sales") > 0).select(*ID_COLUMNS))


def series_history(fct: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """Last `days` rows of every series (S2, R2), date as ISO text."""
    w = Window.partitionBy(*ID_COLUMNS).orderBy(F.col("date").desc())
    return (fct.select(*GRAIN, "sales").withColumn("rd", F.row_number().over(w))
            .filter(F.col("rd") <= days)
            .select(*ID_COLUMNS, F.date_format("date", "yyyy-MM-dd").alias("date"),
                    F.col("sales").cast("double").alias("sales")))


def series_point_lookup(spark: SparkSession, view: str, store_id: str, item_id: str,
                        columns: list[str]) -> DataFrame:
    """One series' rows by bound parameters (P16); the filter reaches the scan."""
    cols = ", ".join(columns)
    return spark.sql(f"SELECT {cols} FROM {view} WHERE store_id = :store_id AND item_id = :item_id",
                     args={"store_id": store_id, "item_id": item_id})


def series_accuracy(accuracy: DataFrame, days: int = RECENT_ACCURACY_DAYS) -> DataFrame:
    """Accuracy points of the trailing `days` days (date > max - days)."""
    start = F.date_sub(accuracy.agg(F.max("date")).scalar(), days)
    return accuracy.filter(F.col("date") > start).select(*GRAIN, "predicted_sales", "actual_sales")


def accuracy_points(daily: DataFrame) -> DataFrame:
    """Daily accuracy rows with a defined MAPE."""
    return daily.filter(F.col("mape").isNotNull())


def _lookup(mapping: dict, key: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, key), key)


def store_label(store_id: Column) -> Column:
    """'CA_1' -> 'California · Store 1'; codes without a number stay as they are (P20)."""
    parts = F.split(store_id, "_")
    return F.when(F.size(parts) < 2, store_id).when(F.get(parts, 1) == "", store_id).otherwise(
        F.concat(_lookup(STATE_NAMES, F.get(parts, 0)), F.lit(" · Store "), F.get(parts, 1)))


def item_label(item_id: Column) -> Column:
    """'FOODS_1_001' -> 'Foods · Dept 1 · Item 001'; fewer than 3 parts stay raw (P20)."""
    parts = F.split(item_id, "_")
    return F.when(F.size(parts) < 3, item_id).otherwise(
        F.concat(_lookup(CATEGORY_NAMES, F.get(parts, 0)), F.lit(" · Dept "), F.get(parts, 1),
                 F.lit(" · Item "), F.get(parts, 2)))


def series_labels(series: DataFrame) -> DataFrame:
    """store_id, item_id, label; callers order by label at the output edge."""
    return series.select(*ID_COLUMNS, F.concat(store_label(F.col("store_id")), F.lit(" — "),
                                               item_label(F.col("item_id"))).alias("label"))


def weekday_profile(fct: DataFrame) -> DataFrame:
    """Mean sales per weekday, Monday = 0 first."""
    return fct.groupBy(F.weekday("date").alias("weekday"),
                       F.date_format("date", "EEEE").alias("day_name")) \
        .agg(F.avg("sales").alias("mean_sales"))


def history_with_predictions(history: DataFrame, forecast: DataFrame, accuracy: DataFrame) -> DataFrame:
    """History points ∪ next-day forecast point, each with its backtest prediction.

    history: date, store_id, item_id, sales; forecast: date, store_id, item_id,
    predicted_sales; accuracy: date, store_id, item_id, predicted_sales.
    """
    pts = (history.select(*GRAIN, F.col("sales").cast("double").alias("value"),
                          F.lit(False).alias("is_forecast"))
           .unionByName(forecast.select(*GRAIN, F.col("predicted_sales").cast("double").alias("value"),
                                        F.lit(True).alias("is_forecast"))))
    acc = accuracy.select(*GRAIN, F.col("predicted_sales").alias("backtest_prediction"))
    return pts.join(acc, GRAIN, "left")
