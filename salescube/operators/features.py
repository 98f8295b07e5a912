"""Leak-free per-series features with one shared window spec.

All features come from ONE ``Window.partitionBy(store_id, item_id).orderBy(date)``
so Catalyst plans a single exchange + sort for lags, rolling stats and
recency together. A series holds at most one row per day, so a window
partition is bounded by the day span whatever the table size; skew across
series cannot exceed that bound.

Offsets are rows, not days (the application's semantics): run on a dense
panel, or densify first (see ``densify``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.operators.marts import snap_for_state
from salescube.schemas import (BASE_NUMERIC_FEATURES, CATEGORICAL_FEATURES, GRAIN, ID_COLUMNS,
                               LAGS, OPTIONAL_NUMERIC_FEATURES, ROLLING_WINDOWS)


def series_window() -> Window:
    return Window.partitionBy(*ID_COLUMNS).orderBy("date")


def lag_columns(lags=LAGS, col: str = "sales") -> list[Column]:
    w = series_window()
    return [F.lag(F.col(col).cast("double"), k).over(w).alias(f"{col}_lag_{k}") for k in lags]


EXACT = float(1 << 53)   # whole doubles below are exact


def rolling_columns(windows=ROLLING_WINDOWS, col: str = "sales", whole: bool = False) -> list[Column]:
    """Mean (min 1 row) and sample std (min 2 rows) over the n strictly prior rows.

    Of `whole` numbers the deviation comes from exact sums, so that every
    engine gets the same bits; where the sums could be inexact, and for other
    numbers, it is Spark's running one.
    """
    out = []
    for n in windows:
        frame = series_window().rowsBetween(-n, -1)
        x = F.col(col).cast("double")
        out.append(F.avg(x).over(frame).alias(f"{col}_roll_mean_{n}"))
        std = F.stddev_samp(x).over(frame)
        if whole:
            c = F.count(x).over(frame).cast("double")
            scaled = c * F.sum(x * x).over(frame)
            total = F.sum(x).over(frame)
            exact = F.sqrt((scaled - total * total) / (c * (c - 1)))
            std = F.when((c >= 2) & (scaled < EXACT), exact).otherwise(std)
        out.append(std.alias(f"{col}_roll_std_{n}"))
    return out


def recency_column(col: str = "sales") -> Column:
    """Rows since the last row whose *previous* row sold (or since series start).

    A reset happens at the series' first row and on the row after any non-zero
    sale; the feature is the row distance to the latest reset. Reset row
    numbers increase, so a running max finds the latest one.
    """
    w = series_window()
    rn = F.row_number().over(w)
    prev = F.lag(F.col(col), 1).over(w)
    reset = F.when((rn == 1) | (F.coalesce(prev, F.lit(0)) > 0), rn)
    last_reset = F.max(reset).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (rn - last_reset).cast("double").alias("days_since_last_sale")


def calendar_columns(date: str = "date") -> list[Column]:
    """Monday=0 weekday, weekend flag, month (P5)."""
    dow = F.weekday(date)
    return [dow.alias("dayofweek"), dow.isin(5, 6).cast("int").alias("is_weekend"),
            F.month(date).alias("month")]


def build_features(df: DataFrame) -> DataFrame:
    """All features in one projection (W5). Optional columns are used when present."""
    cols = [F.col(c) for c in df.columns if c not in ("month",)]
    whole = isinstance(df.schema["sales"].dataType, T.IntegralType)
    feats = lag_columns() + rolling_columns(whole=whole) + [recency_column()] + calendar_columns()
    return optional_columns(df.select(*cols, *feats), df.columns)


def optional_columns(out: DataFrame, given: list[str]) -> DataFrame:
    """Null fill and flag of the optional columns that the input has."""
    if "snap_flag" in given:
        out = out.withColumn("snap_flag", F.coalesce(F.col("snap_flag"), F.lit(0)).cast("int"))
    if "event_type_1" in given:
        out = (out.withColumn("has_event", F.col("event_type_1").isNotNull().cast("int"))
               .withColumn("event_type_1", F.coalesce(F.col("event_type_1"), F.lit("none"))))
    return out


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(all feature columns, categorical feature columns) present in `df`."""
    numeric = [c for c in BASE_NUMERIC_FEATURES + OPTIONAL_NUMERIC_FEATURES if c in df.columns]
    categorical = [c for c in CATEGORICAL_FEATURES if c in df.columns]
    return numeric + categorical, categorical


def next_day_stub(history: DataFrame, calendar: DataFrame | None = None, stores: DataFrame | None = None) -> DataFrame:
    """History ∪ one stub row per series at global max(date)+1 with NULL sales.

    With ``calendar`` and ``stores`` the stub has the next day's event and SNAP
    flag, as the fact has them; days past the calendar leave them null.
    """
    next_day = F.date_add(history.agg(F.max("date")).scalar(), 1)
    stub = (history.select(*ID_COLUMNS).distinct()
            .select(next_day.alias("date"), *ID_COLUMNS, F.lit(None).cast("long").alias("sales")))
    if calendar is not None:
        stub = (stub.join(calendar.where(F.col("date") == next_day), "date", "left")
                .join(stores.select("store_id", "state_id"), "store_id", "left")
                .select(*GRAIN, "sales", "event_type_1", snap_for_state().alias("snap_flag")))
    return history.unionByName(stub, allowMissingColumns=True)


def densify(df: DataFrame, fill: dict | None = None) -> DataFrame:
    """Give every series a row on every day between the global first and last date.

    Union + aggregate instead of a join: the per-series day skeleton has
    length bounded by the day span; observed rows win over skeleton rows.
    """
    lo, hi = df.agg(F.min("date")).scalar(), df.agg(F.max("date")).scalar()
    skeleton = df.select(*ID_COLUMNS).distinct().select(
        *ID_COLUMNS, F.explode(F.sequence(lo, hi)).alias("date"), F.lit(1).alias("_skel"))
    observed = df.withColumn("_skel", F.lit(0))
    others = [c for c in df.columns if c not in GRAIN]
    merged = (observed.unionByName(skeleton, allowMissingColumns=True)
              .groupBy(*GRAIN)
              .agg(*[F.min_by(c, "_skel").alias(c) for c in others]))
    for c, v in (fill or {}).items():
        merged = merged.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return merged.select(*df.columns)
