"""Rebuild of the months that a delivery touches, and of no others.

Tables lie in ``month_start=`` folders. The days of what was delivered since
the last refresh, carried forward by the days that a table looks back, give
the months to rebuild; ``refresh_months`` replaces those folders alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.functions.dates import unshift_days
from salescube.schemas import GRAIN, ID_COLUMNS
from salescube.sources.io import replace_partitions

MONTH = "month_start"


def touched_months(changes: DataFrame, reach_days: int = 0) -> list[dt.date]:
    """First days of the months that hold a changed day or one up to `reach_days` after it.

    Null days touch nothing. The list is bounded by the months of the calendar.
    """
    months = F.sequence(F.trunc("date", "month"), F.trunc(F.date_add("date", reach_days), "month"),
                        F.expr("INTERVAL 1 MONTH"))
    rows = changes.select("date").where(F.col("date").isNotNull()).distinct().select(F.explode(months)).distinct()
    return sorted(r[0] for r in rows.collect())


def in_months(months: list[dt.date], date: str = "date") -> Column:
    return F.trunc(date, "month").isin(months)


def raw_days(months: list[dt.date], date: str = "date") -> Column:
    """Raw days between the first and the last of the months: a range that reaches the scan."""
    return F.col(date).between(unshift_days(F.lit(months[0])), unshift_days(F.last_day(F.lit(months[-1]))))


def refresh_months(path: str, months: list[dt.date], build: Callable[[list[dt.date]], DataFrame]) -> None:
    """Replace the folders of `months` by ``build(months)``, which has all their rows and no others.

    Rows are delivered or corrected, never withdrawn, so each of the months
    has rows. Doing it again gives the same folders.
    """
    if months:
        replace_partitions(build(months).withColumn(MONTH, F.trunc("date", "month")), path, MONTH)


def week_ago_predictions(fct: DataFrame) -> DataFrame:
    """Each sold day forecast by the sales of the same series seven days before, 0 if there were none.

    One frame over day numbers: a series needs no row for its silent days.
    """
    w = (Window.partitionBy(*ID_COLUMNS).orderBy(F.unix_date("date")).rangeBetween(-7, -7))
    return fct.select(*GRAIN, "sales", F.coalesce(F.sum("sales").over(w), F.lit(0)).cast("double").alias("predicted_sales"))
