"""Features and baselines of series that hold only their days with sales.

The dense panel has a row for each series and day, so its offsets are rows. Here
a missing day means that nothing was sold, and the same features come from
frames over day numbers and arithmetic over the span of days behind a row:

* a lag is the value at exactly d - k, or 0 if the series had begun by then;
* a rolling mean is the sum of the last n days over min(n, days since the start);
* a rolling deviation comes from the sums of sales and of their squares and that
  same count, so silent days enter as zeros without a row;
* recency is the distance to the day after the last sale.

So rows are what was sold and nothing else: a hundred rows over six years cost a
hundred rows. All frames share one partitioning and order, one exchange and one
sort. A series holds at most one row a day, which bounds its window partition by
the span of days.

A series begins at its own first row, or at ``start`` for all series, as in a
panel that begins for all of them on one day. Rows of one series and day must be
summed before. Null ids are left out; null sales count as no sale and don't begin
a series that has no row before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.operators.features import calendar_columns, optional_columns
from salescube.schemas import ID_COLUMNS, LAGS, ROLLING_WINDOWS

PHASE_WEEKS = 8


def _day_window() -> Window:
    return Window.partitionBy(*ID_COLUMNS).orderBy("_day")


def _prepared(df: DataFrame, start: Column | None, col: str) -> DataFrame:
    """Rows with their day number and ``_age``, the days of their series before them."""
    days = (df.where(F.col("store_id").isNotNull() & F.col("item_id").isNotNull() & F.col("date").isNotNull())
            .withColumn("_day", F.unix_date("date")).withColumn("_x", F.col(col).cast("double")))
    first = (F.unix_date(start) if start is not None
             else F.min("_day").over(_day_window().rangeBetween(Window.unboundedPreceding, 0)))
    return days.withColumn("_age", F.col("_day") - first)


def lag_columns(lags=LAGS, col: str = "sales") -> list[Column]:
    """The value at exactly ``k`` days before; null before the series began."""
    return [F.when(F.col("_age") >= k, F.coalesce(F.sum("_x").over(_day_window().rangeBetween(-k, -k)), F.lit(0.0)))
            .alias(f"{col}_lag_{k}") for k in lags]


def rolling_columns(windows=ROLLING_WINDOWS, col: str = "sales") -> list[Column]:
    """Mean (from 1 day) and sample deviation (from 2 days) of the n days before."""
    out = []
    for n in windows:
        frame = _day_window().rangeBetween(-n, -1)
        c = F.least(F.col("_age"), F.lit(n)).cast("double")
        s = F.coalesce(F.sum("_x").over(frame), F.lit(0.0))
        ss = F.coalesce(F.sum(F.col("_x") * F.col("_x")).over(frame), F.lit(0.0))
        # Whole sales make both sums exact; below zero is rounding of other ones.
        spread = F.greatest((c * ss - s * s) / (c * (c - 1)), F.lit(0.0))
        out.append(F.when(c >= 1, s / c).alias(f"{col}_roll_mean_{n}"))
        out.append(F.when(c >= 2, F.sqrt(spread)).alias(f"{col}_roll_std_{n}"))
    return out


def recency_column() -> Column:
    """Days since the day after the last sale before, or since the series began."""
    sold = F.max(F.when(F.col("_x") > 0, F.col("_day"))).over(_day_window().rangeBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.col("_day") - sold - 1, F.col("_age")).cast("double").alias("days_since_last_sale")


def build_features(df: DataFrame, start: Column | None = None, col: str = "sales") -> DataFrame:
    """All features of ``operators.features.build_features``, from the days with sales.

    Rows may carry null sales, as the next day's row does. Rows before ``start``
    must not be there.
    """
    cols = [F.col(c) for c in df.columns if c != "month"]
    out = _prepared(df, start, col).select(
        *cols, *lag_columns(col=col), *rolling_columns(col=col), recency_column(), *calendar_columns())
    return optional_columns(out, df.columns)


def _last_days(df: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Rows of the ``days`` days up to ``as_of`` with ``_back``, the days from theirs to it."""
    back = F.datediff(as_of, F.col("date"))
    return df.where((back >= 0) & (back < days)).withColumn("_back", back)


def forecasts(df: DataFrame, as_of: Column, horizon: int, season: int = 7, weeks: int = PHASE_WEEKS) -> DataFrame:
    """The three baselines of the days after ``as_of`` (W6, W7, W8), one row for each series and day.

    ``naive``: the value of ``as_of``; ``seasonal``: the last ``season`` days over
    and over; ``phase_mean``: the mean of the same weekday of the last ``weeks``
    weeks, of those since the series' first row. Silent days are zeros. Series
    without a sale in these weeks have no rows: their forecasts are all zero.
    """
    recent = _last_days(df.select("date", *ID_COLUMNS, "sales"), as_of, 7 * weeks)
    begun = df.where(F.col("date") <= as_of).groupBy(*ID_COLUMNS).agg(F.datediff(as_of, F.min("date")).alias("age"))
    # At most one row a day: maps of at most 7 * weeks, season and 7 entries.
    by_day = recent.where(F.col("_back") < season).groupBy(*ID_COLUMNS).agg(
        F.map_from_entries(F.collect_list(F.struct("_back", F.col("sales").cast("double")))).alias("day"))
    by_phase = (recent.groupBy(*ID_COLUMNS, F.pmod("_back", F.lit(7)).alias("p")).agg(F.sum("sales").cast("double").alias("s"))
                .groupBy(*ID_COLUMNS).agg(F.map_from_entries(F.collect_list(F.struct("p", "s"))).alias("phase")))
    rows = (by_phase.join(begun, ID_COLUMNS).join(by_day, ID_COLUMNS, "left")
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))))

    def at(values: str, key: Column) -> Column:
        return F.coalesce(F.try_element_at(values, key), F.lit(0.0))

    # Days of the target's weekday lie 7 - (step - 1) % 7 - 1 days back and every seven before.
    phase = F.pmod(-F.col("step"), F.lit(7))
    seen = F.least(F.lit(weeks), F.floor((F.col("age") - phase) / 7) + 1)
    return rows.select(
        F.date_add(as_of, F.col("step")).alias("date"), *ID_COLUMNS,
        at("day", F.lit(0)).alias("naive"),
        at("day", F.lit(season - 1) - F.pmod(F.col("step") - 1, F.lit(season))).alias("seasonal"),
        F.when(seen >= 1, at("phase", phase) / seen).alias("phase_mean"))
