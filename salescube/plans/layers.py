"""Raw -> staging -> marts over one input directory.

Layering follows the modelled application: raw inputs and marts are stored
tables (written once per application to the shared folder, see
``Warehouse``), staging is a set of lazy views. ``build_<mart>()`` returns the
lazy plan that computes a mart from the layer below (what the mart's own
query runs); the attribute of the same name is the stored table that
downstream jobs read, so they never recompute the whole lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescube.operators import marts, staging
from salescube.plans.warehouse import Warehouse
from salescube.schemas import GRAIN, ID_COLUMNS
from salescube.sources.mapping import DriverTables

PREDICTION_DAYS = 90     # trailing days covered by the derived predictions table
PREDICTION_LAG = 7       # predicted_sales = sales this many rows earlier


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = True, **mapping_kw):
        self.spark = spark
        ns = f"{sf_dir}|{sorted(mapping_kw.items())}"
        self.wh = Warehouse(spark, ns) if stored else None
        self.raw = DriverTables(spark, sf_dir, store=self.wh, **mapping_kw)

    def _keep(self, name: str, build, partition_by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
        return self.wh.table(name, build, partition_by, buckets, ID_COLUMNS) if self.wh is not None else build()

    # ---- staging (views) ----------------------------------------------------
    @cached_property
    def stg_sales_history(self) -> DataFrame:
        return staging.stg_sales_history(self.raw.sales_history)

    @cached_property
    def stg_sales_daily_feed(self) -> DataFrame:
        return staging.stg_sales_daily_feed(self.raw.sales_daily_feed)

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.stg_sales_history, self.stg_sales_daily_feed)

    @cached_property
    def stg_calendar(self) -> DataFrame:
        return staging.stg_calendar(self.raw.calendar)

    @cached_property
    def stg_prices(self) -> DataFrame:
        return staging.stg_prices(self.raw.sell_prices)

    # ---- marts: lazy builds ---------------------------------------------------
    def build_dim_item(self) -> DataFrame:
        return marts.dim_item(self.stg_sales_history)

    def build_dim_store(self) -> DataFrame:
        return marts.dim_store(self.stg_sales_history)

    def build_dim_calendar(self) -> DataFrame:
        return marts.dim_calendar(self.stg_calendar)

    def build_fct_sales(self) -> DataFrame:
        return self.fct_of(self.stg_sales_history, self.stg_sales_daily_feed)

    def fct_of(self, history: DataFrame, feed: DataFrame) -> DataFrame:
        """The fact of these rows. Where tables lie by series, history and feed meet their prices
        in place and then come together: a union would hide where its rows lie."""
        sides = self.dim_calendar, self.dim_store, self.stg_prices
        if not self.raw.buckets:
            return marts.fct_sales(staging.stg_sales(history, feed), *sides)
        rows = (history.withColumn("sell_price", F.lit(None).cast("double")), feed)
        old, new = (marts.fct_sales(r.select(*GRAIN, "sales", "sell_price"), *sides, by_series=True) for r in rows)
        return old.unionByName(new)

    def build_fct_sales_predictions(self) -> DataFrame:
        """Deterministic stand-in for model output: sales 7 rows earlier, last 90 days."""
        # The panel has a row for each series and day, so as many rows back are as many days.
        w = Window.partitionBy(*ID_COLUMNS).orderBy("date")
        since = F.date_sub(self.last_date, PREDICTION_DAYS + PREDICTION_LAG)
        return (self.fct_window(since).select(*GRAIN, "sales")
                .withColumn("predicted_sales", F.lag("sales", PREDICTION_LAG).over(w).cast("double"))
                .filter(F.col("date") > F.date_sub(self.last_date, PREDICTION_DAYS))
                .select(*GRAIN, "predicted_sales"))

    def build_prediction_accuracy(self) -> DataFrame:
        days = self.fct_sales_predictions.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        actual = self.fct_window(days.select("lo").scalar(), days.select("hi").scalar())
        return marts.prediction_accuracy(self.fct_sales_predictions, actual)

    def build_accuracy_daily(self) -> DataFrame:
        return marts.accuracy_daily(self.prediction_accuracy)

    # ---- marts: stored tables -----------------------------------------------
    @cached_property
    def dim_item(self) -> DataFrame:
        return self._keep("dim_item", self.build_dim_item)

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._keep("dim_store", self.build_dim_store)

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return self._keep("dim_calendar", self.build_dim_calendar)

    @cached_property
    def fct_sales(self) -> DataFrame:
        """Stored fact, partitioned by month: trailing-window reads prune folders
        (see ``fct_window``). Rows are range-partitioned by date before the write,
        so each task covers a contiguous date range: few files per month, and no
        task ever holds a whole month. Where tables lie by series, the fact does too."""
        def build():
            fct = self.build_fct_sales().withColumn("month_start", F.trunc("date", "month"))
            return fct if self.raw.buckets else fct.repartitionByRange("date", "store_id", "item_id")
        if self.raw.buckets:
            return self._keep("fct_sales", build, buckets=self.raw.buckets)
        return self._keep("fct_sales", build, partition_by=["month_start"])

    def fct_window(self, lo, hi=None) -> DataFrame:
        """Fact rows with lo <= date [<= hi]; the matching month bound prunes
        partitions at runtime even when lo / hi are scalar subqueries."""
        df = self.fct_sales
        cond = (F.col("date") >= lo) & (F.col("month_start") >= F.trunc(lo, "month"))
        if hi is not None:
            cond = cond & (F.col("date") <= hi) & (F.col("month_start") <= F.trunc(hi, "month"))
        return df.filter(cond)

    @property
    def last_date(self):
        """Latest fact date (shifted time) as a scalar subquery column. The newest month
        comes from the folder names, so dates are read of that month only."""
        newest = self.fct_sales.agg(F.max("month_start")).scalar()
        return self.fct_sales.filter(F.col("month_start") == newest).agg(F.max("date")).scalar()

    @cached_property
    def fct_sales_predictions(self) -> DataFrame:
        return self._keep("fct_sales_predictions", self.build_fct_sales_predictions)

    @cached_property
    def prediction_accuracy(self) -> DataFrame:
        return self._keep("fct_prediction_accuracy", self.build_prediction_accuracy)

    @cached_property
    def accuracy_daily(self) -> DataFrame:
        return self._keep("agg_prediction_accuracy_daily", self.build_accuracy_daily)
