"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole
input tables. Oracle SQL mirrors the same semantics in DuckDB over the
driver's tables (see ``salescube.plans.oracle``). Float columns whose value
depends on summation order are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.functions import dates
from salescube.operators import baselines, features, metrics, reads, staging
from salescube.operators.quality import quality_report
from salescube.plans.layers import Layers
from salescube.plans.oracle import q
from salescube.schemas import (GRAIN, ID_COLUMNS, LAGS, MAX_CATCHUP_DAYS, RAW_SOURCE_COLUMNS,
                               RECENT_ACTIVITY_DAYS, ROLLING_WINDOWS)

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Series mapping used by the registered queries; the benchmark's scale-out
# pass switches to {"store_level": "nation"} (series grow with the data).
MAPPING: dict = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(spark, sf_dir, **MAPPING)


def r6(*cols: str):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


HOLDOUT_DAYS = 14
MISSING_DAYS_CAP = MAX_CATCHUP_DAYS
HALF = "half"

# --------------------------------------------------------------------------- staging / marts


@register("melt_wide_sales", q("""
SELECT c.date, p.store_id, p.item_id, i.dept_id, i.cat_id, i.state_id, p.sales
FROM panel p JOIN (SELECT DISTINCT store_id, item_id, dept_id, cat_id, state_id FROM raw_sales_history) i
  ON p.store_id = i.store_id AND p.item_id = i.item_id
JOIN raw_calendar c ON p.date = c.date
"""))
def melt_wide_sales(spark, sf_dir):
    """I2 + J5: the wide matrix of all panel days back to rows; days past the calendar go."""
    L = layers(spark, sf_dir)
    return staging.melt_sales(L.raw.sales_wide, L.raw.calendar)


@register("stg_sales", q("SELECT * FROM stg_sales"))
def stg_sales(spark, sf_dir):
    return layers(spark, sf_dir).stg_sales


@register("stg_calendar", q("SELECT * FROM stg_calendar"))
def stg_calendar(spark, sf_dir):
    return layers(spark, sf_dir).stg_calendar


@register("stg_prices", q("SELECT store_id, item_id, wm_yr_wk, sell_price FROM stg_prices"))
def stg_prices(spark, sf_dir):
    return layers(spark, sf_dir).stg_prices.select("store_id", "item_id", "wm_yr_wk", "sell_price")


@register("dim_item", q("SELECT * FROM dim_item"))
def dim_item(spark, sf_dir):
    return layers(spark, sf_dir).build_dim_item()


@register("dim_store", q("SELECT * FROM dim_store"))
def dim_store(spark, sf_dir):
    return layers(spark, sf_dir).build_dim_store()


@register("dim_calendar", q("SELECT * FROM dim_calendar"))
def dim_calendar(spark, sf_dir):
    return layers(spark, sf_dir).build_dim_calendar()


FCT_COLS = ["date", "store_id", "item_id", "sales", "wday", "month", "year", "event_name_1",
            "event_type_1", "snap_flag"]


@register("fct_sales", q("""
SELECT date, store_id, item_id, sales, sell_price, wday, month, year,
       event_name_1, event_type_1, snap_flag FROM fct_sales"""))
def fct_sales(spark, sf_dir):
    return layers(spark, sf_dir).build_fct_sales().select(*FCT_COLS, "sell_price")


def training_extract(L: Layers) -> DataFrame:
    """The training columns of the range that ends with the latest fact date."""
    latest = L.spark.range(1).select(L.last_date.alias("date")).first()["date"]
    start, end = dates.resolve_date_range(today=latest)
    return L.fct_window(F.lit(start), F.lit(end)).select(*RAW_SOURCE_COLUMNS)


@register("extract_range", q("""
SELECT date, store_id, item_id, sales, sell_price, snap_flag, event_type_1
FROM fct_sales, fct_last WHERE date BETWEEN last_date - 730 AND last_date"""))
def extract_range(spark, sf_dir):
    """I4 + I14 + S1: fixed column list over [end - 730, end], end = latest fact date, in series order."""
    return training_extract(layers(spark, sf_dir)).orderBy("store_id", "item_id", "date")


@register("recent_history", q("""
SELECT date, store_id, item_id, sales, sell_price
FROM fct_sales, fct_last WHERE date >= last_date - 90"""))
def recent_history(spark, sf_dir):
    """Trailing 90-day window of the five ingest columns, as_of = latest date."""
    L = layers(spark, sf_dir)
    return (L.fct_window(F.date_sub(L.last_date, 90))
            .select("date", "store_id", "item_id", "sales", "sell_price"))


@register("missing_days", q(f"""
SELECT CAST(UNNEST(generate_series(h + 1, LEAST(t, h + {MISSING_DAYS_CAP}), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT (SELECT MAX(date) FROM stg_sales_history) AS h, (SELECT MAX(date) FROM fct_sales) AS t)
WHERE t > h"""))
def missing_days(spark, sf_dir):
    """I11 + I12: days the frozen history lacks up to the latest fact day, capped."""
    L = layers(spark, sf_dir)
    return dates.missing_days(spark, dates.latest_date(L.stg_sales_history),
                              dates.latest_date(L.fct_sales), max_days=MISSING_DAYS_CAP)


@register("backfill_targets", q("""
SELECT CAST(UNNEST(generate_series(last_date - 89, last_date, INTERVAL 1 DAY)) AS DATE) AS date FROM fct_last"""))
def backfill_targets(spark, sf_dir):
    """Last 90 dates up to the latest actual date."""
    return dates.backfill_targets(spark, layers(spark, sf_dir).last_date, 90)


# --------------------------------------------------------------------------- features

LAG_COLS = [f"sales_lag_{k}" for k in LAGS]
ROLL_COLS = [f"sales_roll_{s}_{n}" for n in ROLLING_WINDOWS for s in ("mean", "std")]


def _featured(spark, sf_dir):
    return features.build_features(layers(spark, sf_dir).fct_sales)


@register("feature_lags", q(f"SELECT date, store_id, item_id, sales, {', '.join(LAG_COLS)} FROM features_full"))
def feature_lags(spark, sf_dir):
    return layers(spark, sf_dir).fct_sales.select(*GRAIN, "sales", *features.lag_columns())


@register("feature_rolling", q(
    f"SELECT date, store_id, item_id, {', '.join(f'ROUND({c}, 6) AS {c}' for c in ROLL_COLS)} FROM features_full"))
def feature_rolling(spark, sf_dir):
    df = layers(spark, sf_dir).fct_sales.select(*GRAIN, *features.rolling_columns())
    return df.select(*GRAIN, *r6(*ROLL_COLS))


@register("feature_recency", q("SELECT date, store_id, item_id, sales, days_since_last_sale FROM features_full"))
def feature_recency(spark, sf_dir):
    return layers(spark, sf_dir).fct_sales.select(*GRAIN, "sales", features.recency_column())


@register("feature_calendar", q("""
SELECT date, store_id, item_id, dayofweek, is_weekend, month, snap_flag, has_event, event_type_1
FROM features_full"""))
def feature_calendar(spark, sf_dir):
    f = _featured(spark, sf_dir)
    return f.select(*GRAIN, "dayofweek", "is_weekend", "month", "snap_flag", "has_event", "event_type_1")


FULL_PLAIN = ["date", "store_id", "item_id", "sales", "wday", "year", "event_name_1", "event_type_1",
              "snap_flag", "has_event", *LAG_COLS, "days_since_last_sale", "dayofweek", "is_weekend",
              "month"]


@register("feature_full", q(f"""
SELECT {', '.join(FULL_PLAIN)}, sell_price,
  {', '.join(f'ROUND({c}, 6) AS {c}' for c in ROLL_COLS)} FROM features_full"""))
def feature_full(spark, sf_dir):
    return _featured(spark, sf_dir).select(*FULL_PLAIN, "sell_price", *r6(*ROLL_COLS))


# --------------------------------------------------------------------------- baselines

def _holdout(spark, sf_dir, days=HOLDOUT_DAYS):
    L = layers(spark, sf_dir)
    hist = L.fct_sales.select(*GRAIN, "sales")
    return baselines.time_split(hist, days)


@register("naive_forecast", q("""
SELECT CAST(last_date + CAST(s AS INTEGER) AS DATE) AS date, store_id, item_id, last_value AS sales
FROM (SELECT store_id, item_id, MAX(date) AS last_date, arg_max(sales, date) AS last_value
      FROM holdout_train GROUP BY store_id, item_id), range(1, 15) t(s)"""))
def naive_forecast(spark, sf_dir):
    train, _ = _holdout(spark, sf_dir)
    return baselines.naive_forecast(train, HOLDOUT_DAYS)


SEASONAL_SQL = """
tail AS (
  SELECT store_id, item_id, date, sales,
    ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd,
    LEAST(COUNT(*) OVER (PARTITION BY store_id, item_id), 7) AS m,
    MAX(date) OVER (PARTITION BY store_id, item_id) AS last_date
  FROM holdout_train),
seasonal AS (
  SELECT CAST(t.last_date + CAST(s.step AS INTEGER) AS DATE) AS date, t.store_id, t.item_id, t.sales
  FROM tail t, (SELECT UNNEST(range(1, 15)) AS step) s
  WHERE t.rd <= t.m AND t.rd = t.m - ((s.step - 1) % t.m))
"""


@register("seasonal_naive_forecast", q("," + SEASONAL_SQL + "SELECT * FROM seasonal"))
def seasonal_naive_forecast(spark, sf_dir):
    train, _ = _holdout(spark, sf_dir)
    return baselines.seasonal_naive_forecast(train, HOLDOUT_DAYS)


def _same_phase_sql(phase_cond: str) -> str:
    return f"""
SELECT store_id, item_id, MAX(date) AS last_date,
  ROUND(COALESCE(AVG(CASE WHEN {phase_cond} THEN CAST(sales AS DOUBLE) END),
                 AVG(CASE WHEN rd <= 7 THEN CAST(sales AS DOUBLE) END)), 6) AS baseline
FROM (SELECT store_id, item_id, date, sales,
        ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM fct_sales)
WHERE rd <= 56 GROUP BY store_id, item_id"""


@register("same_phase_mean", q(_same_phase_sql("rd % 7 = 0")))
def same_phase_mean(spark, sf_dir):
    df = baselines.same_phase_mean(layers(spark, sf_dir).fct_sales, phase="target")
    return df.select(*ID_COLUMNS, "last_date", *r6("baseline"))


@register("same_phase_mean_last", q(_same_phase_sql("(rd - 1) % 7 = 0")))
def same_phase_mean_last(spark, sf_dir):
    df = baselines.same_phase_mean(layers(spark, sf_dir).fct_sales, phase="last")
    return df.select(*ID_COLUMNS, "last_date", *r6("baseline"))


@register("next_day_table", q("""
SELECT CAST(fl.last_date + 1 AS DATE) AS date, b.store_id, b.item_id,
  CAST(round_even(GREATEST(COALESCE(b.baseline, 0.0), 0.0), 0) AS BIGINT) AS sales,
  p.sell_price
FROM (SELECT store_id, item_id,
        COALESCE(AVG(CASE WHEN rd % 7 = 0 THEN CAST(sales AS DOUBLE) END),
                 AVG(CASE WHEN rd <= 7 THEN CAST(sales AS DOUBLE) END)) AS baseline
      FROM (SELECT store_id, item_id, sales,
              ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM fct_sales)
      WHERE rd <= 56 GROUP BY store_id, item_id) b
LEFT JOIN (SELECT store_id, item_id, arg_max(sell_price, date) AS sell_price FROM fct_sales
           WHERE sell_price IS NOT NULL GROUP BY store_id, item_id) p
  ON b.store_id = p.store_id AND b.item_id = p.item_id
CROSS JOIN fct_last fl"""))
def next_day_table(spark, sf_dir):
    hist = layers(spark, sf_dir).fct_sales.select(*GRAIN, "sales", "sell_price")
    df = baselines.next_day_table(hist, phase="target")
    return df.select("date", *ID_COLUMNS, "sales", "sell_price")


@register("next_day_stub", q("""
SELECT date, store_id, item_id, sales FROM fct_sales
UNION ALL
SELECT DISTINCT CAST(fl.last_date + 1 AS DATE), store_id, item_id, CAST(NULL AS BIGINT) FROM fct_sales, fct_last fl"""))
def next_day_stub(spark, sf_dir):
    return features.next_day_stub(layers(spark, sf_dir).fct_sales.select(*GRAIN, "sales"))


def _score_sql(forecast_cte: str, model: str) -> str:
    return f"""
SELECT '{model}' AS model,
  ROUND(AVG(ABS(a.sales - f.sales) / GREATEST(ABS(a.sales), 1.0)), 6) AS mape,
  ROUND(SQRT(AVG(POWER(a.sales - f.sales, 2))), 6) AS rmse, CAST(COUNT(*) AS BIGINT) AS n
FROM holdout_valid a JOIN {forecast_cte} f
  ON a.date = f.date AND a.store_id = f.store_id AND a.item_id = f.item_id"""


@register("holdout_scores", q("," + SEASONAL_SQL + """,
naive AS (
  SELECT CAST(last_date + CAST(s AS INTEGER) AS DATE) AS date, store_id, item_id, last_value AS sales
  FROM (SELECT store_id, item_id, MAX(date) AS last_date, arg_max(sales, date) AS last_value
        FROM holdout_train GROUP BY store_id, item_id), range(1, 15) t(s))
""" + _score_sql("naive", "naive") + " UNION ALL " + _score_sql("seasonal", "seasonal_naive")))
def holdout_scores(spark, sf_dir):
    """Both baselines scored on the last 14 days, side by side."""
    train, valid = _holdout(spark, sf_dir)
    out = None
    for name, fc in (("naive", baselines.naive_forecast(train, HOLDOUT_DAYS)),
                     ("seasonal_naive", baselines.seasonal_naive_forecast(train, HOLDOUT_DAYS))):
        s = metrics.score_forecast(valid, fc).select(F.lit(name).alias("model"), *r6("mape", "rmse"), "n")
        out = s if out is None else out.unionByName(s)
    return out


# --------------------------------------------------------------------------- metrics

RMSSE_SQL = "," + SEASONAL_SQL + """,
merged AS (
  SELECT a.store_id, a.item_id, CAST(a.sales AS DOUBLE) AS y, CAST(f.sales AS DOUBLE) AS p
  FROM holdout_valid a JOIN seasonal f
    ON a.date = f.date AND a.store_id = f.store_id AND a.item_id = f.item_id),
per AS (
  SELECT store_id, item_id, COUNT(*) AS n, SUM(POWER(y - p, 2)) AS sse,
         SUM(ABS(y - p) / GREATEST(ABS(y), 1.0)) AS spe
  FROM merged GROUP BY store_id, item_id),
diffs AS (
  SELECT store_id, item_id, CAST(sales AS DOUBLE) AS sales,
    CAST(sales AS DOUBLE) - LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_id, item_id ORDER BY date) AS diff
  FROM holdout_train),
scale AS (
  SELECT store_id, item_id,
    CASE WHEN AVG(POWER(diff, 2)) > 0 THEN AVG(POWER(diff, 2)) ELSE 1.0 END AS scale,
    SUM(sales) AS total_sales
  FROM diffs GROUP BY store_id, item_id),
per_series AS (
  SELECT per.store_id, per.item_id, per.n, per.sse, per.spe,
    SQRT(per.sse / per.n / COALESCE(scale.scale, 1.0)) AS rmsse,
    COALESCE(scale.total_sales, 0.0) AS total_sales
  FROM per LEFT JOIN scale ON per.store_id = scale.store_id AND per.item_id = scale.item_id)
"""


def _rmsse_inputs(spark, sf_dir):
    train, valid = _holdout(spark, sf_dir)
    return valid, baselines.seasonal_naive_forecast(train, HOLDOUT_DAYS), train


@register("rmsse_per_series", q(RMSSE_SQL + """
SELECT store_id, item_id, ROUND(rmsse, 6) AS rmsse, ROUND(total_sales, 6) AS total_sales FROM per_series"""))
def rmsse_per_series(spark, sf_dir):
    return metrics.rmsse_per_series(*_rmsse_inputs(spark, sf_dir)).select(
        *ID_COLUMNS, *r6("rmsse", "total_sales"))


@register("weighted_rmsse", q(RMSSE_SQL + """
SELECT ROUND(CASE WHEN SUM(total_sales) = 0 THEN AVG(rmsse)
                  ELSE SUM(rmsse * total_sales) / SUM(total_sales) END, 6) AS wrmsse FROM per_series"""))
def weighted_rmsse(spark, sf_dir):
    per = metrics.rmsse_per_series(*_rmsse_inputs(spark, sf_dir))
    return metrics.weighted_rmsse(per).select(*r6("wrmsse"))


@register("evaluate_predictions", q(RMSSE_SQL + """
SELECT ROUND(SUM(spe) / SUM(n), 6) AS mape, ROUND(SQRT(SUM(sse) / SUM(n)), 6) AS rmse,
  ROUND(CASE WHEN SUM(total_sales) = 0 THEN AVG(rmsse)
             ELSE SUM(rmsse * total_sales) / SUM(total_sales) END, 6) AS wrmsse,
  CAST(SUM(n) AS BIGINT) AS n, CAST(COUNT(*) AS BIGINT) AS n_series FROM per_series"""))
def evaluate_predictions(spark, sf_dir):
    ev = metrics.evaluate_predictions(*_rmsse_inputs(spark, sf_dir))
    return ev.select(*r6("mape", "rmse", "wrmsse"), "n", "n_series")


@register("series_weights", q("""
SELECT date, store_id, item_id, sales,
  ROUND(SUM(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_id, item_id), 6) AS total_sales,
  ROUND(SQRT(SUM(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_id, item_id)), 6) AS weight
FROM model_train"""))
def series_weights(spark, sf_dir):
    train, _ = _holdout(spark, sf_dir, 28)
    return metrics.series_weights(train, "sqrt").select(*GRAIN, "sales", *r6("total_sales", "weight"))


# --------------------------------------------------------------------------- accuracy marts / reads

@register("fct_sales_predictions", q("SELECT * FROM fct_sales_predictions"))
def fct_sales_predictions(spark, sf_dir):
    return layers(spark, sf_dir).build_fct_sales_predictions()


@register("prediction_accuracy", q("""
SELECT date, store_id, item_id, predicted_sales, actual_sales, abs_error, ROUND(pct_error, 6) AS pct_error
FROM fct_prediction_accuracy"""))
def prediction_accuracy(spark, sf_dir):
    acc = layers(spark, sf_dir).build_prediction_accuracy()
    return acc.select(*GRAIN, "predicted_sales", "actual_sales", "abs_error", *r6("pct_error"))


@register("accuracy_daily", q("""
SELECT date, n_predictions, ROUND(mae, 6) AS mae, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse
FROM agg_prediction_accuracy_daily"""))
def accuracy_daily(spark, sf_dir):
    d = layers(spark, sf_dir).build_accuracy_daily()
    return d.select("date", "n_predictions", *r6("mae", "mape", "rmse"))


@register("accuracy_points", q("""
SELECT date, n_predictions, ROUND(mae, 6) AS mae, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse
FROM agg_prediction_accuracy_daily WHERE mape IS NOT NULL"""))
def accuracy_points(spark, sf_dir):
    d = reads.accuracy_points(layers(spark, sf_dir).accuracy_daily)
    return d.select("date", "n_predictions", *r6("mae", "mape", "rmse")).orderBy("date")


@register("series_accuracy", q("""
SELECT date, store_id, item_id, predicted_sales, actual_sales FROM fct_prediction_accuracy
WHERE date > (SELECT MAX(date) FROM fct_prediction_accuracy) - 90"""))
def series_accuracy(spark, sf_dir):
    return reads.series_accuracy(layers(spark, sf_dir).prediction_accuracy, 90).orderBy(*GRAIN)


@register("series_accuracy_summary", q("""
SELECT store_id, item_id, ROUND(AVG(ABS(predicted_sales - actual_sales)), 6) AS mae,
  ROUND(AVG(CASE WHEN actual_sales > 0 THEN ABS(predicted_sales - actual_sales) / actual_sales END), 6) AS mape,
  CAST(COUNT(*) AS BIGINT) AS n
FROM fct_prediction_accuracy WHERE date > (SELECT MAX(date) FROM fct_prediction_accuracy) - 90
GROUP BY store_id, item_id"""))
def series_accuracy_summary(spark, sf_dir):
    acc = reads.series_accuracy(layers(spark, sf_dir).prediction_accuracy, 90)
    return metrics.series_accuracy_summary(acc).select(*ID_COLUMNS, *r6("mae", "mape"), "n")


def recently_active(L):
    return reads.active_series(L.fct_window(F.date_sub(L.last_date, RECENT_ACTIVITY_DAYS)), RECENT_ACTIVITY_DAYS)


@register("active_series", q("""
SELECT store_id, item_id FROM fct_sales, fct_last WHERE date > last_date - 30
GROUP BY store_id, item_id HAVING SUM(sales) > 0"""))
def active_series(spark, sf_dir):
    """A3 + R1: only the months of the window are read."""
    return recently_active(layers(spark, sf_dir))


@register("series_history", q("""
SELECT store_id, item_id, strftime(date, '%Y-%m-%d') AS date, CAST(sales AS DOUBLE) AS sales
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM fct_sales)
WHERE rd <= 90"""))
def series_history(spark, sf_dir):
    return reads.series_history(layers(spark, sf_dir).fct_sales, 90)


POINT_STORE, POINT_ITEM = "AMERICA", "Brand#7"


@register("series_point_lookup", q(f"""
SELECT date, store_id, item_id, sales, sell_price, snap_flag, event_type_1
FROM fct_sales WHERE store_id = '{POINT_STORE}' AND item_id = '{POINT_ITEM}'"""))
def series_point_lookup(spark, sf_dir):
    """Bound-parameter lookup of one series over a view of the fact."""
    view = "fct_sales_lookup_view"
    layers(spark, sf_dir).fct_sales.createOrReplaceTempView(view)
    df = reads.series_point_lookup(spark, view, POINT_STORE, POINT_ITEM, RAW_SOURCE_COLUMNS)
    return df.select(*[c for c in RAW_SOURCE_COLUMNS if c != "sell_price"], "sell_price")


@register("series_labels", q("""
SELECT store_id, item_id,
  CASE WHEN len(string_split(store_id, '_')) < 2 OR string_split(store_id, '_')[2] = '' THEN store_id
       ELSE COALESCE(CASE string_split(store_id, '_')[1] WHEN 'CA' THEN 'California' WHEN 'TX' THEN 'Texas'
                     WHEN 'WI' THEN 'Wisconsin' END, string_split(store_id, '_')[1])
            || ' · Store ' || string_split(store_id, '_')[2] END
  || ' — ' ||
  CASE WHEN len(string_split(item_id, '_')) < 3 THEN item_id
       ELSE COALESCE(CASE string_split(item_id, '_')[1] WHEN 'FOODS' THEN 'Foods' WHEN 'HOUSEHOLD' THEN 'Household'
                     WHEN 'HOBBIES' THEN 'Hobbies' END, string_split(item_id, '_')[1])
            || ' · Dept ' || string_split(item_id, '_')[2] || ' · Item ' || string_split(item_id, '_')[3] END
  AS label
FROM (SELECT store_id, item_id FROM fct_sales, fct_last WHERE date > last_date - 30
      GROUP BY store_id, item_id HAVING SUM(sales) > 0)"""))
def series_labels(spark, sf_dir):
    """P20 + S5: display labels of the active series (ordered by label)."""
    return reads.series_labels(recently_active(layers(spark, sf_dir))).orderBy("label")


@register("weekday_profile", q("""
SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday, dayname(date) AS day_name,
  ROUND(AVG(sales), 6) AS mean_sales FROM fct_sales GROUP BY 1, 2"""))
def weekday_profile(spark, sf_dir):
    return reads.weekday_profile(layers(spark, sf_dir).fct_sales).select(
        "weekday", "day_name", *r6("mean_sales")).orderBy("weekday")


@register("history_with_predictions", q("""
, hist AS (
  SELECT date, store_id, item_id, CAST(sales AS DOUBLE) AS value, FALSE AS is_forecast
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM fct_sales)
  WHERE rd <= 90),
fc AS (
  SELECT CAST(fl.last_date + 1 AS DATE) AS date, b.store_id, b.item_id,
    round_even(GREATEST(COALESCE(b.baseline, 0.0), 0.0), 0) AS value, TRUE AS is_forecast
  FROM (SELECT store_id, item_id,
          COALESCE(AVG(CASE WHEN rd % 7 = 0 THEN CAST(sales AS DOUBLE) END),
                   AVG(CASE WHEN rd <= 7 THEN CAST(sales AS DOUBLE) END)) AS baseline
        FROM (SELECT store_id, item_id, sales,
                ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM fct_sales)
        WHERE rd <= 56 GROUP BY store_id, item_id) b CROSS JOIN fct_last fl),
pts AS (SELECT * FROM hist UNION ALL SELECT * FROM fc)
SELECT pts.*, a.predicted_sales AS backtest_prediction
FROM pts LEFT JOIN fct_prediction_accuracy a
  ON pts.date = a.date AND pts.store_id = a.store_id AND pts.item_id = a.item_id"""))
def history_with_predictions(spark, sf_dir):
    """Last 90 days of history ∪ next-day forecast, with backtest predictions."""
    L = layers(spark, sf_dir)
    from pyspark.sql import Window
    w = Window.partitionBy(*ID_COLUMNS).orderBy(F.col("date").desc())
    hist = (L.fct_sales.select(*GRAIN, "sales").withColumn("rd", F.row_number().over(w))
            .filter("rd <= 90").drop("rd"))
    fc = baselines.next_day_table(L.fct_sales.select(*GRAIN, "sales")).select(
        *GRAIN, F.col("sales").alias("predicted_sales"))
    return reads.history_with_predictions(hist, fc, L.prediction_accuracy)


# --------------------------------------------------------------------------- quality

@register("quality_checks", q("""
SELECT 'dim_item' AS "table", 'not_null' AS "check", 'item_id' AS "column", CAST(COUNT(*) FILTER (WHERE item_id IS NULL) AS BIGINT) AS failures FROM dim_item
UNION ALL SELECT 'dim_item', 'unique', 'item_id', CAST(COUNT(*) AS BIGINT) FROM (SELECT item_id FROM dim_item GROUP BY item_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'dim_store', 'not_null', 'store_id', CAST(COUNT(*) FILTER (WHERE store_id IS NULL) AS BIGINT) FROM dim_store
UNION ALL SELECT 'dim_store', 'unique', 'store_id', CAST(COUNT(*) AS BIGINT) FROM (SELECT store_id FROM dim_store GROUP BY store_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'dim_calendar', 'not_null', 'date', CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) FROM dim_calendar
UNION ALL SELECT 'dim_calendar', 'unique', 'date', CAST(COUNT(*) AS BIGINT) FROM (SELECT date FROM dim_calendar GROUP BY date HAVING COUNT(*) > 1)
UNION ALL SELECT 'fct_sales', 'not_null', 'date', CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) FROM fct_sales
UNION ALL SELECT 'fct_sales', 'not_null', 'store_id', CAST(COUNT(*) FILTER (WHERE store_id IS NULL) AS BIGINT) FROM fct_sales
UNION ALL SELECT 'fct_sales', 'not_null', 'item_id', CAST(COUNT(*) FILTER (WHERE item_id IS NULL) AS BIGINT) FROM fct_sales
UNION ALL SELECT 'fct_sales', 'not_null', 'sales', CAST(COUNT(*) FILTER (WHERE sales IS NULL) AS BIGINT) FROM fct_sales
UNION ALL SELECT 'fct_sales', 'unique', 'date,store_id,item_id', CAST(COUNT(*) AS BIGINT) FROM (SELECT date FROM fct_sales GROUP BY date, store_id, item_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'fct_prediction_accuracy', 'not_null', 'date', CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) FROM fct_prediction_accuracy
UNION ALL SELECT 'fct_prediction_accuracy', 'not_null', 'store_id', CAST(COUNT(*) FILTER (WHERE store_id IS NULL) AS BIGINT) FROM fct_prediction_accuracy
UNION ALL SELECT 'fct_prediction_accuracy', 'not_null', 'item_id', CAST(COUNT(*) FILTER (WHERE item_id IS NULL) AS BIGINT) FROM fct_prediction_accuracy
UNION ALL SELECT 'agg_prediction_accuracy_daily', 'not_null', 'date', CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) FROM agg_prediction_accuracy_daily
UNION ALL SELECT 'agg_prediction_accuracy_daily', 'unique', 'date', CAST(COUNT(*) AS BIGINT) FROM (SELECT date FROM agg_prediction_accuracy_daily GROUP BY date HAVING COUNT(*) > 1)
"""))
def quality_checks(spark, sf_dir):
    L = layers(spark, sf_dir)
    return quality_report({"dim_item": L.dim_item, "dim_store": L.dim_store,
                           "dim_calendar": L.dim_calendar, "fct_sales": L.fct_sales,
                           "fct_prediction_accuracy": L.prediction_accuracy,
                           "agg_prediction_accuracy_daily": L.accuracy_daily})
