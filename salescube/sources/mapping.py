"""Raw-layer tables derived from the TPC-H-style inputs.

The modelled application consumes five raw tables (long sales history, a
daily feed, a calendar, weekly sell prices and a wide sales matrix). Here
they are derived from ``lineitem ⋈ part ⋈ supplier ⋈ nation ⋈ region``:

* series key: ``store_id`` = region name, ``item_id`` = part brand
  (``store_level="nation"`` / ``item_level="part"`` give the scale-out
  mapping whose series count grows with the data);
* ``date`` = ship date, ``sales`` = summed quantity (raw, unshifted time);
* a dense panel fills every day between the global first and last ship day
  with 0; the history keeps all but the last 14 days, the feed the last 14;
* the calendar ends 7 days before the panel end, so feed rows past it keep
  NULL calendar attributes (as in the application).

Global bounds are scalar subqueries (``DataFrame.scalar``): they are
evaluated once and inlined as literals, so no cross join is planned.
"""

from __future__ import annotations

from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.schemas import GRAIN, ID_COLUMNS, WIDE_ID_COLUMNS
from salescube.sources.tables import read_table

# --- fixed values of the mapping ------------------------------------------
FEED_DAYS = 14            # trailing panel days that arrive through the feed
CALENDAR_GAP_DAYS = 7     # calendar stops this many days before the panel end
WEEK_BASE = 11101         # wm_yr_wk of calendar day 0
STATE_BY_REGION = {"AFRICA": "CA", "AMERICA": "TX", "ASIA": "WI"}
EVENTS = {  # month-day -> (event_name_1, event_type_1)
    "12-25": ("Christmas", "National"),
    "02-14": ("ValentinesDay", "Cultural"),
}
FEED_PRICE_ODD_DAY = "n/a"   # even days: the series' median weekly price, whole units
BUCKET_LINES = 500_000    # lines of a bucket where tables lie by series
# ---------------------------------------------------------------------------


def item_number(item_id: Column) -> Column:
    """Trailing integer of an item code ('Brand#13' -> 13)."""
    return F.regexp_extract(item_id, r"([0-9]+)$", 1).cast("int")


def item_dept(item_id: Column) -> Column:
    return F.concat(F.lit("D"), F.floor((item_number(item_id) - 1) / 5).cast("int").cast("string"))


def item_cat(item_id: Column) -> Column:
    return F.concat(F.lit("C"), F.floor((item_number(item_id) - 1) / 10).cast("int").cast("string"))


def store_state(store_id: Column) -> Column:
    expr = None
    for region, state in STATE_BY_REGION.items():
        expr = (F.when(store_id == region, F.lit(state)) if expr is None
                else expr.when(store_id == region, F.lit(state)))
    return expr.otherwise(store_id)


class DriverTables:
    """Lazily built raw tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, store_level: str = "region",
                 item_level: str = "brand", store=None, sparse: bool = False):
        """`store`: optional ``Warehouse``; when given, the raw tables are written
        once and read back (the application's raw layer is stored tables).
        `sparse`: series hold only their days with sales; no panel is built.
        Stored sparse series of parts lie in buckets by series, as many as the lines
        ask for: after the one shuffle of the lines, what goes by series stays in place."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.store_level = store_level
        self.item_level = item_level
        self.store = store
        self.sparse = sparse

    @cached_property
    def buckets(self) -> int | None:
        """Buckets of the tables by series; None where tables don't lie by series."""
        if self.store is None or not self.sparse or self.item_level != "part":
            return None
        return max(self.spark.sparkContext.defaultParallelism, ceil(self.read("lineitem").count() / BUCKET_LINES))

    def by_series(self, df: DataFrame) -> DataFrame:
        """Rows where the stored tables have those of the same series."""
        return df.repartition(self.buckets, *ID_COLUMNS) if self.buckets else df

    def _keep(self, name: str, df: DataFrame, buckets: int | None = None) -> DataFrame:
        if self.store is None:
            return df
        return self.store.table(name, lambda: df, buckets=buckets, by=ID_COLUMNS)

    def read(self, name: str, *cols: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, *cols)

    # -- line facts -----------------------------------------------------------
    @cached_property
    def line_facts(self) -> DataFrame:
        """(date, store_id, item_id, quantity, unit_price) per line item.

        Dimension joins are equi-joins on keys; Catalyst/AQE choose broadcast
        for the small dimension sides by measured size, sort-merge otherwise.
        """
        li = self.read("lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       "l_shipdate")
        part = self.read("part", "p_partkey", *(["p_brand"] if self.item_level == "brand" else []))
        supp = self.read("supplier", "s_suppkey", "s_nationkey")
        nation = self.read("nation", "n_nationkey", "n_name", "n_regionkey")
        region = self.read("region", "r_regionkey", "r_name")
        store = F.col("r_name") if self.store_level == "region" else F.col("n_name")
        item = F.col("p_brand") if self.item_level == "brand" else F.col("l_partkey").cast("string")
        # One table after the other: each is measured by its file, the product of the small ones is not.
        return (li.join(supp, li.l_suppkey == supp.s_suppkey)
                .join(nation, supp.s_nationkey == nation.n_nationkey)
                .join(region, nation.n_regionkey == region.r_regionkey)
                .join(part, li.l_partkey == part.p_partkey)
                .select(F.col("l_shipdate").cast("date").alias("date"),
                        store.alias("store_id"), item.alias("item_id"),
                        F.col("l_quantity").alias("quantity"),
                        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price")))

    @cached_property
    def grain_facts(self) -> DataFrame:
        """The ONE pass over the line table: per (date, store, item) the summed
        quantity and the minimum unit price (partial aggregation map-side).
        Sales, weekly prices, the series list and the day bounds all derive
        from this table; a min of daily mins is the weekly min."""
        return self._keep("grain_facts", self.by_series(self.line_facts).groupBy(*GRAIN).agg(
            F.sum("quantity").cast("long").alias("sales"),
            F.min("unit_price").alias("min_unit_price")), self.buckets)

    @cached_property
    def sales_base(self) -> DataFrame:
        """One row per (date, store, item) with sales."""
        return self.grain_facts.select(*GRAIN, "sales")

    # -- global bounds (scalar subqueries) ------------------------------------
    def _day_source(self) -> DataFrame:
        # Once the grain table is stored, its date column is the cheaper source.
        if self.store is not None:
            return self.grain_facts.select("date")
        return self.read("lineitem", "l_shipdate").select(F.col("l_shipdate").cast("date").alias("date"))

    @property
    def first_day(self) -> Column:
        return self._day_source().agg(F.min("date")).scalar()

    @property
    def last_day(self) -> Column:
        return self._day_source().agg(F.max("date")).scalar()

    def day_number(self, date: Column) -> Column:
        """1-based position of `date` in the panel (calendar `d_n`)."""
        return F.datediff(date, self.first_day) + 1

    # -- dense panel ----------------------------------------------------------
    @cached_property
    def series(self) -> DataFrame:
        return self.sales_base.select(*ID_COLUMNS).distinct()

    @cached_property
    def panel(self) -> DataFrame:
        """Every series × every day in [first, last], 0-filled.

        Built as union + aggregate (no join): the day skeleton is generated
        per series with ``sequence`` (length bounded by the day span) and
        merged with the observed rows in one hash aggregate. Sparse series have
        no rows but the observed ones.
        """
        if self.sparse:
            return self.sales_base
        skeleton = self.series.select(
            *ID_COLUMNS, F.explode(F.sequence(self.first_day, self.last_day)).alias("date"),
            F.lit(0).cast("long").alias("sales"))
        return self._keep("panel", self.sales_base.unionByName(skeleton)
                          .groupBy(*GRAIN).agg(F.sum("sales").cast("long").alias("sales")))

    def with_ids(self, df: DataFrame) -> DataFrame:
        return df.select("date", "store_id", "item_id",
                         item_dept(F.col("item_id")).alias("dept_id"),
                         item_cat(F.col("item_id")).alias("cat_id"),
                         store_state(F.col("store_id")).alias("state_id"), "sales")

    # -- raw tables -----------------------------------------------------------
    @cached_property
    def sales_history(self) -> DataFrame:
        cutoff = F.date_sub(self.last_day, FEED_DAYS)
        return self.with_ids(self.panel.filter(F.col("date") <= cutoff))

    @cached_property
    def sales_daily_feed(self) -> DataFrame:
        cutoff = F.date_sub(self.last_day, FEED_DAYS)
        # A series has one price a week, so the median's group is bounded by the day span.
        arrived = self.panel.filter(F.col("date") > cutoff)
        prices = self.sell_prices
        if self.buckets:  # most series have no day in the feed
            prices = prices.join(arrived.select(*ID_COLUMNS).hint("shuffle_hash"), ID_COLUMNS, "left_semi")
        usual = prices.groupBy(*ID_COLUMNS).agg(
            F.floor(F.round(F.median("sell_price"), 6)).cast("long").cast("string").alias("usual"))
        price = F.when(F.dayofmonth("date") % 2 == 0, F.col("usual")).otherwise(F.lit(FEED_PRICE_ODD_DAY))
        return (arrived.join(usual, ID_COLUMNS)
                .select("date", "store_id", "item_id", "sales", price.alias("sell_price")))

    @cached_property
    def calendar(self) -> DataFrame:
        days = self.spark.range(1).select(F.explode(F.sequence(
            self.first_day, F.date_sub(self.last_day, CALENDAR_GAP_DAYS))).alias("date"))
        n = self.day_number(F.col("date"))
        md = F.date_format("date", "MM-dd")
        name = type_ = None
        for key, (ev_name, ev_type) in EVENTS.items():
            name = F.when(md == key, F.lit(ev_name)) if name is None else name.when(md == key, F.lit(ev_name))
            type_ = F.when(md == key, F.lit(ev_type)) if type_ is None else type_.when(md == key, F.lit(ev_type))
        dom = F.dayofmonth("date")
        return self._keep("calendar", days.select(
            F.concat(F.lit("d_"), n.cast("string")).alias("d"),
            "date",
            (F.lit(WEEK_BASE) + F.floor(n / 7)).cast("int").alias("wm_yr_wk"),
            F.date_format("date", "EEEE").alias("weekday"),
            (F.dayofweek("date") % 7 + 1).cast("long").alias("wday"),
            F.month("date").alias("month"), F.year("date").alias("year"),
            name.alias("event_name_1"), type_.alias("event_type_1"),
            F.lit(None).cast("string").alias("event_name_2"),
            F.lit(None).cast("string").alias("event_type_2"),
            (dom <= 10).cast("long").alias("snap_ca"),
            (dom % 3 == 0).cast("long").alias("snap_tx"),
            (dom >= 20).cast("long").alias("snap_wi")))

    @cached_property
    def sell_prices(self) -> DataFrame:
        week = (F.lit(WEEK_BASE) + F.floor(self.day_number(F.col("date")) / 7)).cast("int")
        return self._keep("sell_prices", self.grain_facts.withColumn("wm_yr_wk", week)
                          .groupBy("store_id", "item_id", "wm_yr_wk")
                          .agg(F.min("min_unit_price").alias("sell_price")), self.buckets)

    @cached_property
    def sales_wide(self) -> DataFrame:
        """All panel days as columns d_1..d_N (one row per series); N is the day span."""
        span = self.spark.range(1).select(self.day_number(self.last_day)).first()[0]
        days = [f"d_{i}" for i in range(1, (span or 0) + 1)]
        d = F.concat(F.lit("d_"), self.day_number(F.col("date")).cast("string"))
        return self._keep("sales_wide", self.with_ids(self.panel).withColumn("d", d)
                          .groupBy(*WIDE_ID_COLUMNS).pivot("d", days).agg(F.max("sales")))
