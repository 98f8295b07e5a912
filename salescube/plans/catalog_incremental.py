"""Registered queries of incremental steps: levelled landing, touched months, waiting predictions,
checked writes. Series are one for each nation and part, so that rows grow with the line table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from salescube.operators import marts, quality, refresh, staging
from salescube.plans.catalog import r6, register
from salescube.plans.catalog_io import scratch
from salescube.plans.catalog_sparse import PART_COLS, PART_PRELUDE, part_layers
from salescube.schemas import GRAIN, ID_COLUMNS, SALES_DAILY_FEED_RAW
from salescube.sources.io import replace_partitions
from salescube.streaming.accuracy import paired, run_accuracy_stream
from salescube.streaming.levelled import LevelledLanding

# --------------------------------------------------------------------------- levelled landing


@register("levelled_landing", PART_PRELUDE + """
SELECT date, store_id, item_id, sales + CASE WHEN year(date) = year(d1) THEN 1 ELSE 0 END AS sales,
  CASE WHEN year(date) = year(d1) THEN 'n/a' ELSE '1' END AS sell_price FROM sales_base, bounds""")
def levelled_landing(spark, sf_dir):
    """Every sold day delivered year by year, the last year again with corrections; settled
    batches lie in levelled runs, and the read merges those with the last batch."""
    days = part_layers(spark, sf_dir).raw.grain_facts.select(*GRAIN, "sales", F.lit("1").alias("sell_price"))
    year = F.year("date")
    years = [r[0] for r in days.select(year).distinct().orderBy(year).collect()]   # bounded by the calendar
    src = scratch(spark, "levelled_src")
    landing = LevelledLanding(spark, scratch(spark, "levelled"), SALES_DAILY_FEED_RAW, fan_in=2)
    for y in years:
        days.where(year == y).write.mode("append").parquet(src)
        landing.ingest(src)
    if years:
        fix = days.where(year == years[-1]).withColumns({"sales": F.col("sales") + 1, "sell_price": F.lit("n/a")})
        fix.write.mode("append").parquet(src)
        landing.ingest(src)
    return landing.current()


# --------------------------------------------------------------------------- touched months

# The first feed day is delivered again, with one more sold in each of its rows.
CORRECTED_PRELUDE = PART_PRELUDE.replace(
    "SELECT date + 3731 AS date, store_id, item_id, CAST(sales AS BIGINT) AS sales,\n         TRY_CAST",
    "SELECT date + 3731 AS date, store_id, item_id,\n"
    "         CAST(sales AS BIGINT) + CASE WHEN date = (SELECT MIN(date) FROM raw_sales_daily_feed) THEN 1 ELSE 0 END AS sales,\n"
    "         TRY_CAST")
if CORRECTED_PRELUDE == PART_PRELUDE:
    raise AssertionError("the oracle's feed staging has changed")

WEEK_REACH = 7


def refreshed(spark, sf_dir) -> tuple[str, str]:
    """Fact and daily accuracy by month, after a correction that came when both were stored."""
    L = part_layers(spark, sf_dir)
    feed, src = L.raw.sales_daily_feed, scratch(spark, "refresh_src")
    landing = LevelledLanding(spark, scratch(spark, "refresh_feed"), SALES_DAILY_FEED_RAW)
    fact, daily = scratch(spark, "refresh_fact"), scratch(spark, "refresh_daily")

    def fct_of(history, feed_rows):
        # The feed's rows go where the stored prices of their series are.
        return L.fct_of(history, staging.stg_sales_daily_feed(L.raw.by_series(feed_rows)))

    def fact_of(months):
        inside = refresh.raw_days(months) & F.trunc(F.date_add("date", staging.DATE_OFFSET_DAYS), "month").isin(months)
        history = staging.stg_sales_history(L.raw.sales_history.where(inside))
        return fct_of(history, landing.current().where(inside))

    def daily_of(months):
        # The month before holds the days that the first week looks back on.
        wanted = refresh.in_months(months)
        back = F.trunc(F.add_months(F.col(refresh.MONTH), 1), "month").isin(months)
        rows = spark.read.parquet(fact).where(F.col(refresh.MONTH).isin(months) | back)
        rows = refresh.week_ago_predictions(rows.select(*GRAIN, "sales")).where(wanted)
        made = rows.withColumnRenamed("sales", "actual_sales")
        err = F.abs(F.col("predicted_sales") - F.col("actual_sales"))
        return marts.accuracy_daily(made.withColumns({
            "abs_error": err, "pct_error": F.when(F.col("actual_sales") > 0, err / F.col("actual_sales"))}))

    def follow(after: int) -> None:
        changes = landing.changes(after).select(F.date_add("date", staging.DATE_OFFSET_DAYS).alias("date"))
        refresh.refresh_months(fact, refresh.touched_months(changes), fact_of)
        refresh.refresh_months(daily, refresh.touched_months(changes, WEEK_REACH), daily_of)

    feed.write.parquet(src)
    landing.ingest(src)
    replace_partitions(fct_of(L.stg_sales_history, landing.current())
                       .withColumn(refresh.MONTH, F.trunc("date", "month")), fact, refresh.MONTH)
    every = refresh.touched_months(spark.read.parquet(fact))
    refresh.refresh_months(daily, every, daily_of)
    done = landing.last_batch()
    first = feed.agg(F.min("date")).scalar()
    feed.where(F.col("date") == first).withColumn("sales", F.col("sales") + 1).write.mode("append").parquet(src)
    landing.ingest(src)
    follow(done)
    return fact, daily


@register("refreshed_fct_sales", CORRECTED_PRELUDE + f"SELECT {', '.join(PART_COLS)}, month FROM fct_sales")
def refreshed_fct_sales(spark, sf_dir):
    """The stored fact after a late correction; only the months it touches were rebuilt."""
    return spark.read.parquet(refreshed(spark, sf_dir)[0]).select(*PART_COLS, "month")


@register("refreshed_accuracy_daily", CORRECTED_PRELUDE + """,
week_ago AS (
  SELECT a.date, a.sales, CAST(COALESCE(b.sales, 0) AS DOUBLE) AS predicted
  FROM fct_sales a LEFT JOIN fct_sales b
    ON b.store_id = a.store_id AND b.item_id = a.item_id AND b.date = a.date - 7)
SELECT date, CAST(COUNT(*) AS BIGINT) AS n_predictions, ROUND(AVG(ABS(predicted - sales)), 6) AS mae,
  ROUND(AVG(CASE WHEN sales > 0 THEN ABS(predicted - sales) / sales END), 6) AS mape,
  ROUND(SQRT(AVG(POWER(predicted - sales, 2))), 6) AS rmse
FROM week_ago GROUP BY date""")
def refreshed_accuracy_daily(spark, sf_dir):
    """A2 of week-ago forecasts after the same correction, months of the following week included."""
    daily = spark.read.parquet(refreshed(spark, sf_dir)[1])
    return daily.select("date", "n_predictions", *r6("mae", "mape", "rmse"))


# --------------------------------------------------------------------------- waiting predictions


@register("prediction_accuracy_stream", PART_PRELUDE + """,
made AS (
  SELECT date, store_id, item_id, sales AS actual_sales,
    CAST(LAG(sales) OVER (PARTITION BY store_id, item_id ORDER BY date) AS DOUBLE) AS predicted_sales FROM fct_sales)
SELECT date, store_id, item_id, predicted_sales, actual_sales, ABS(predicted_sales - actual_sales) AS abs_error,
  CASE WHEN actual_sales > 0 THEN ABS(predicted_sales - actual_sales) / actual_sales END AS pct_error
FROM made WHERE predicted_sales IS NOT NULL""")
def prediction_accuracy_stream(spark, sf_dir):
    """J2 as an incremental join: all predictions (a series' last sale) are there first, the actuals
    come in two deliveries, and each run pairs what came; the second run goes on from the first's state."""
    fct = part_layers(spark, sf_dir).fct_sales
    series = Window.partitionBy(*ID_COLUMNS).orderBy("date")
    made = fct.select(*GRAIN, F.lag("sales").over(series).cast("double").alias("predicted_sales"))
    preds, actuals = scratch(spark, "waiting_preds"), scratch(spark, "waiting_actuals")
    out, ckpt = scratch(spark, "waiting_pairs"), scratch(spark, "waiting_ckpt")
    made.where(F.col("predicted_sales").isNotNull()).write.parquet(preds)
    span = fct.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    middle = span.select(F.date_add("lo", F.floor(F.datediff("hi", "lo") / 2).cast("int"))).scalar()
    rows = fct.select(*GRAIN, "sales")
    rows.where(F.col("date") <= middle).write.parquet(actuals)
    run_accuracy_stream(spark, preds, actuals, out, ckpt)
    rows.where(F.col("date") > middle).write.mode("append").parquet(actuals)
    run_accuracy_stream(spark, preds, actuals, out, ckpt)
    return paired(spark, out)


# --------------------------------------------------------------------------- checked writes


@register("checked_write", PART_PRELUDE + """,
feed_twice AS (
  SELECT date, store_id, item_id, sales FROM sales_base, bounds
  UNION ALL SELECT date, store_id, item_id, sales FROM sales_base, bounds WHERE year(date) = year(d1)
  UNION ALL SELECT date, store_id, NULL, sales FROM sales_base, bounds WHERE year(date) = year(d0)),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, store_id, item_id) AS nth FROM feed_twice),
judged AS (
  SELECT *, CASE WHEN item_id IS NULL THEN 'not_null:item_id'
                 WHEN nth > 1 THEN 'unique:date,store_id,item_id' ELSE 'none' END AS violation FROM numbered)
SELECT CASE violation WHEN 'none' THEN 'clean' ELSE 'quarantine' END AS status, violation,
  CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(sales) AS BIGINT) AS sales, CAST(COUNT(*) AS BIGINT) AS observed
FROM judged GROUP BY ALL""")
def checked_write(spark, sf_dir):
    """Q1-Q3 during the write: sold days, the last year's delivered twice and the first year's also
    without an item; the counts observed in the write stand beside those of the stored rows."""
    days = part_layers(spark, sf_dir).raw.grain_facts.select(*GRAIN, "sales")
    year = F.year("date")
    first, last = (days.agg(f(year)).scalar() for f in (F.min, F.max))
    rows = (days.unionByName(days.where(year == last))
            .unionByName(days.where(year == first).withColumn("item_id", F.lit(None).cast("string"))))
    path = scratch(spark, "checked")
    seen = quality.write_checked(rows, path, GRAIN, unique=GRAIN)
    clean = seen["rows"] - sum(n for rule, n in seen.items() if rule != "rows")
    observed = F.create_map(*[F.lit(x) for rule, n in (seen | {"none": clean}).items() for x in (rule, n)])
    back = spark.read.parquet(path)
    violation = F.coalesce(F.try_element_at("violations", F.lit(1)), F.lit("none")).alias("violation")
    return (back.groupBy("status", violation).agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"))
            .withColumn("observed", F.try_element_at(observed, F.col("violation")).cast("long")))
