"""Staging layer: casts, date shift and the history ∪ feed union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.functions.dates import shift_days
from salescube.schemas import DATE_OFFSET_DAYS, WIDE_ID_COLUMNS


def melt_sales(sales_wide: DataFrame, calendar: DataFrame) -> DataFrame:
    """Wide d_1..d_n matrix -> long rows, the day's number mapped to a calendar date.

    One generator over an array of the day columns: a day's place gives its
    number, which joins the calendar (its size is bounded by the day span;
    Spark broadcasts it when its measured size is under the broadcast
    threshold). Days that the calendar lacks go; null sales stay null.
    """
    numbers = sorted(int(c[2:]) for c in sales_wide.columns if c.startswith("d_"))
    ids = [c for c in WIDE_ID_COLUMNS if c in sales_wide.columns]
    days = F.array(*[F.col(f"d_{n}").cast("long") for n in numbers])
    place = F.col("place")
    if numbers and numbers[-1] - numbers[0] + 1 == len(numbers):
        number = place + numbers[0]
    else:
        number = F.get(F.array(*[F.lit(n) for n in numbers]).cast("array<int>"), place)
    long = sales_wide.select(*ids, F.posexplode(days).alias("place", "sales")).withColumn("day", number)
    return (long.join(calendar.select(F.substring("d", 3, 10).cast("int").alias("day"), "date"), "day", "inner")
            .select("date", "store_id", "item_id", "dept_id", "cat_id", "state_id", "sales"))


def stg_sales_history(raw: DataFrame, offset: int = DATE_OFFSET_DAYS) -> DataFrame:
    return raw.select(shift_days(F.col("date").cast("date"), offset).alias("date"),
                      "store_id", "item_id", "dept_id", "cat_id", "state_id",
                      F.col("sales").cast("long").alias("sales"))


def stg_sales_daily_feed(raw: DataFrame, offset: int = DATE_OFFSET_DAYS) -> DataFrame:
    """Feed rows: shifted date, hard-cast sales, *safe* cast of the price."""
    price = (F.col("sell_price").try_cast("double") if "sell_price" in raw.columns
             else F.lit(None).cast("double"))
    return raw.select(shift_days(F.col("date").cast("date"), offset).alias("date"),
                      "store_id", "item_id", F.col("sales").cast("long").alias("sales"),
                      price.alias("sell_price"))


def stg_sales(history: DataFrame, feed: DataFrame) -> DataFrame:
    """UNION ALL of history (NULL price) and feed."""
    hist = history.select("date", "store_id", "item_id", "sales",
                          F.lit(None).cast("double").alias("sell_price"))
    return hist.unionByName(feed.select("date", "store_id", "item_id", "sales", "sell_price"))


def stg_calendar(raw: DataFrame, offset: int = DATE_OFFSET_DAYS) -> DataFrame:
    """Shifted calendar; month/year re-derived from the shifted date."""
    shifted = shift_days(F.col("date").cast("date"), offset)
    return (raw.select(shifted.alias("date"), "wm_yr_wk", "weekday",
                       F.col("wday").cast("long").alias("wday"),
                       "event_name_1", "event_type_1", "event_name_2", "event_type_2",
                       *[F.col(c).cast("long").alias(c) for c in ("snap_ca", "snap_tx", "snap_wi")])
            .select("date", "wm_yr_wk", "weekday", "wday",
                    F.month("date").alias("month"), F.year("date").alias("year"),
                    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
                    "snap_ca", "snap_tx", "snap_wi"))


def stg_prices(raw: DataFrame) -> DataFrame:
    return raw.select("store_id", "item_id", "wm_yr_wk",
                      F.col("sell_price").cast("double").alias("sell_price"))
