"""Date helpers as Column expressions and small date-list DataFrames.

The date lists are generated from a scalar bound (`max(date)` of a table) with
``sequence``: the list length is bounded by its day span, never by row count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.schemas import BACKFILL_DAYS, DATE_OFFSET_DAYS, MAX_CATCHUP_DAYS, TRAINING_LOOKBACK_DAYS


def shift_days(date: Column, offset: int = DATE_OFFSET_DAYS) -> Column:
    """Raw ("relative") time -> real time. The offset must keep weekdays."""
    if offset % 7:
        raise ValueError(f"date offset {offset} is not a multiple of 7")
    return F.date_add(date, offset)


def unshift_days(date: Column, offset: int = DATE_OFFSET_DAYS) -> Column:
    if offset % 7:
        raise ValueError(f"date offset {offset} is not a multiple of 7")
    return F.date_sub(date, offset)


def latest_date(df: DataFrame, col: str = "date") -> Column:
    """Latest loaded date as a scalar subquery column."""
    return df.agg(F.max(col)).scalar()


def as_date_column(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def missing_days(spark: SparkSession, latest, target, max_days: int = MAX_CATCHUP_DAYS) -> DataFrame:
    """Days after `latest` up to `target`, oldest first, capped at `max_days`.

    Empty when `target <= latest`. One row per day: `date`.
    """
    latest, target = as_date_column(latest), as_date_column(target)
    days = F.when(target > latest, F.slice(F.sequence(F.date_add(latest, 1), target), 1, max_days)) \
        .otherwise(F.array().cast("array<date>"))
    return spark.range(1).select(F.explode(days).alias("date"))


def backfill_targets(spark: SparkSession, latest, n_days: int = BACKFILL_DAYS) -> DataFrame:
    """The last `n_days` dates up to and including `latest`, oldest first."""
    latest = as_date_column(latest)
    if n_days <= 0:
        return spark.range(1).select(F.lit(None).cast("date").alias("date")).limit(0)
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(latest, n_days - 1), latest)).alias("date"))


def resolve_date_range(start=None, end=None, today: dt.date | None = None,
                       lookback_days: int = TRAINING_LOOKBACK_DAYS) -> tuple[dt.date, dt.date]:
    """Training extract range: end defaults to today (UTC), start to end - lookback."""
    def parse(v):
        return dt.date.fromisoformat(v) if isinstance(v, str) else v
    end_d = parse(end) or today or dt.datetime.now(dt.timezone.utc).date()
    start_d = parse(start) or end_d - dt.timedelta(days=lookback_days)
    return start_d, end_d
