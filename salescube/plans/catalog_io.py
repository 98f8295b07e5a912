"""Registered queries for sinks, the feed stream and the model.

Sink queries perform their writes into fresh folders under the shared
checkpoint directory and return the table read back, so the oracle checks
the rows that landed. Model queries have no SQL oracle (rows-only check).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from salescube.functions import dates
from salescube.operators import model as mdl
from salescube.plans.catalog import MAPPING, layers, r6, register, training_extract
from salescube.plans.catalog_jobs import DRIFT_FEATURES, RUNS_SQL, build_model_runs, model_monitoring, model_runs
from salescube.plans.oracle import features_sql, q
from salescube.schemas import (BACKFILL_DAYS, GRAIN, RAW_SOURCE_COLUMNS, RUN_LOG, SALES_DAILY_FEED_RAW, VALID_DAYS,
                               TRAINING_LOOKBACK_DAYS)
from salescube.session import shared_path
from salescube.sources import io
from salescube.streaming.feed import latest_feed, run_feed_stream
from salescube.operators import baselines, boosting, drift, features, marts, quality, staging

LEGACY_FEED_DAYS = 7     # first feed days were written before the price column existed
REPLACE_DAYS = 14        # trailing prediction days a backfill rewrites
SERVING_HISTORY_DAYS = 60   # what a target day's features look back on


def scratch(spark, name: str) -> str:
    return shared_path(spark, "sinks", f"{name}-{uuid.uuid4().hex[:10]}")


@register("append_evolve", q("""
SELECT date, store_id, item_id, sales,
  CASE WHEN date <= (SELECT MIN(date) FROM stg_sales_daily_feed) + 6 THEN NULL ELSE sell_price END AS sell_price
FROM stg_sales_daily_feed"""))
def append_evolve(spark, sf_dir):
    """Legacy feed rows appended without `sell_price`, later rows with it;
    the reader merges the schemas (older rows read NULL)."""
    feed = layers(spark, sf_dir).stg_sales_daily_feed
    first = F.date_add(feed.agg(F.min("date")).scalar(), LEGACY_FEED_DAYS - 1)
    path = scratch(spark, "feed_evolving")
    io.append_evolve(feed.filter(F.col("date") <= first).drop("sell_price"), path)
    io.append_evolve(feed.filter(F.col("date") > first), path)
    return io.read_evolving(spark, path).select("date", "store_id", "item_id", "sales", "sell_price")


@register("replace_predictions", q(f"""
SELECT date, store_id, item_id,
  CASE WHEN date > (SELECT MAX(date) FROM fct_sales_predictions) - {REPLACE_DAYS}
       THEN predicted_sales + 1 ELSE predicted_sales END AS predicted_sales
FROM fct_sales_predictions"""))
def replace_predictions(spark, sf_dir):
    """I8 + I9: write the prediction table by date, then replace the trailing
    days twice (idempotent): only those date partitions change."""
    preds = layers(spark, sf_dir).fct_sales_predictions
    path = scratch(spark, "predictions")
    io.replace_partitions(preds, path)
    last = preds.agg(F.max("date")).scalar()
    redo = (preds.filter(F.col("date") > F.date_sub(last, REPLACE_DAYS))
            .withColumn("predicted_sales", F.col("predicted_sales") + 1))
    io.replace_partitions(redo, path)
    io.replace_partitions(redo, path)
    return spark.read.parquet(path).select(*GRAIN, "predicted_sales")


@register("run_log", q(RUNS_SQL + f"""
SELECT trained_at AS timestamp, CAST(28 AS BIGINT) AS valid_days, 'none' AS weight_dampening,
  CAST({len(DRIFT_FEATURES)} AS INTEGER) AS n_features, ROUND(wrmsse, 6) AS wrmsse, ROUND(mape, 6) AS mape,
  ROUND(rmse, 6) AS rmse, n_train_rows FROM model_runs"""))
def run_log(spark, sf_dir):
    """Run records (nested array + struct) appended as JSON lines, read back by schema."""
    runs = model_runs(spark, sf_dir)
    rec = runs.select(
        F.col("trained_at").alias("timestamp"), F.lit(sf_dir).alias("data"),
        F.lit(28).cast("long").alias("valid_days"), F.lit("none").alias("weight_dampening"),
        F.array(*[F.lit(c) for c in DRIFT_FEATURES]).alias("features"),
        F.struct("mape", "rmse", "wrmsse", "n_train_rows", "n_valid_rows").alias("metrics"),
        F.lit("model").alias("model_out"))
    path = scratch(spark, "run_log")
    io.append_json_lines(rec, path)
    back = io.read_json(spark, path, RUN_LOG)
    return back.select("timestamp", "valid_days", "weight_dampening",
                       F.size("features").alias("n_features"),
                       *[F.round(F.col(f"metrics.{m}"), 6).alias(m) for m in ("wrmsse", "mape", "rmse")],
                       F.col("metrics.n_train_rows").alias("n_train_rows"))


@register("append_runs", q(RUNS_SQL + """
SELECT trained_at, ROUND(wrmsse, 6) AS wrmsse, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse,
  n_train_rows, n_valid_rows FROM model_runs"""))
def append_runs(spark, sf_dir):
    """I8: run rows appended as they come, earlier runs first; the table is read back."""
    runs = model_runs(spark, sf_dir)
    last = runs.agg(F.max("trained_at")).scalar()
    path = scratch(spark, "model_runs")
    io.append(runs.filter(F.col("trained_at") < last), path)
    io.append(runs.filter(F.col("trained_at") == last), path)
    return spark.read.parquet(path).select("trained_at", *r6("wrmsse", "mape", "rmse"), "n_train_rows", "n_valid_rows")


@register("append_feed", q("SELECT date, store_id, item_id, sales, sell_price FROM raw_sales_daily_feed"))
def append_feed(spark, sf_dir):
    """I8 + I15: staged feed days go back to raw time and are appended to the raw feed, day
    before last day; a declared schema is checked before each append (Q4)."""
    L = layers(spark, sf_dir)
    # The raw price text comes from the feed; all else from the staged rows.
    text = L.raw.sales_daily_feed.select(*GRAIN, "sell_price")
    raw = (L.stg_sales_daily_feed.select(dates.unshift_days(F.col("date")).alias("date"), "store_id", "item_id", "sales")
           .join(text, GRAIN, "left"))
    problems = quality.schema_problems(raw, SALES_DAILY_FEED_RAW)
    if problems:
        raise ValueError(f"feed rows: {problems}")
    last = raw.agg(F.max("date")).scalar()
    path = scratch(spark, "raw_feed")
    io.append(raw.filter(F.col("date") < last), path)
    io.append(raw.filter(F.col("date") == last), path)
    return spark.read.schema(SALES_DAILY_FEED_RAW).parquet(path)


@register("feed_stream", q("""
SELECT date, store_id, item_id,
  CASE WHEN date = (SELECT MAX(date) FROM stg_sales_daily_feed) THEN sales + 1 ELSE sales END AS sales,
  sell_price
FROM stg_sales_daily_feed"""))
def feed_stream(spark, sf_dir):
    """Feed files consumed incrementally (availableNow), one landing folder
    per micro-batch; a late corrected delivery of the last day lands in a later
    batch and wins per grain."""
    raw = layers(spark, sf_dir).raw.sales_daily_feed
    src, landing, ckpt = (scratch(spark, "feed_src"), scratch(spark, "feed_landing"),
                          scratch(spark, "feed_ckpt"))
    raw.write.mode("append").partitionBy("date").parquet(src)
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    last = raw.agg(F.max("date")).scalar()
    fix = raw.filter(F.col("date") == last).withColumn("sales", F.col("sales") + 1)
    fix.write.mode("append").partitionBy("date").parquet(src)
    run_feed_stream(spark, src, SALES_DAILY_FEED_RAW, landing, ckpt)
    merged = latest_feed(spark, landing).select("date", "store_id", "item_id", "sales", "sell_price")
    return staging.stg_sales_daily_feed(merged)


# --------------------------------------------------------------------------- model (rows-only)

_TRAINED: dict = {}


def trained(spark, sf_dir):
    """M3 on the training extract (last 730 days, I14), fitted once per application;
    the pipeline is saved to the shared folder and reloaded (I18)."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(MAPPING.items())))
    if key not in _TRAINED:
        L = layers(spark, sf_dir)
        end = L.last_date
        extract = L.fct_window(F.date_sub(end, TRAINING_LOOKBACK_DAYS), end)
        res = mdl.train(extract.select(*RAW_SOURCE_COLUMNS), keep=L._keep)
        path = scratch(spark, "model")
        mdl.save(res.model, path)
        metrics_row = L._keep("train_metrics", lambda: mdl.training_metrics(res))
        _TRAINED[key] = (mdl.load(path), metrics_row, res.features)
    return _TRAINED[key]


@register("train_metrics", None)
def train_metrics(spark, sf_dir):
    """M1-M3: validation metrics of the boosted-tree model."""
    return trained(spark, sf_dir)[1].select(*r6("wrmsse", "mape", "rmse"), "n", "n_series",
                                            "best_iteration", "n_train_rows", "n_valid_rows")


_LEAFWISE: dict = {}
# A short fit: each round is some eight passes over the rows. The operator's defaults are those of the
# application, up to 500 rounds of 63 leaves with patience 20.
LEAFWISE = boosting.Settings(rounds=3, leaves=31)


def leafwise(spark, sf_dir):
    """The leaf-wise booster on the training extract, sqrt-weighted, fitted once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted(MAPPING.items())))
    if key not in _LEAFWISE:
        L = layers(spark, sf_dir)
        extract = training_extract(L)
        _LEAFWISE[key] = mdl.train_leafwise(extract, weight_dampening="sqrt", settings=LEAFWISE, keep=L._keep)
    return _LEAFWISE[key]


@register("leafwise_metrics", None)
def leafwise_metrics(spark, sf_dir):
    """Validation metrics of the leaf-wise booster; missing prices and keys go into its splits."""
    res = leafwise(spark, sf_dir)
    return mdl.training_metrics(res).select(*r6("wrmsse", "mape", "rmse"), "n", "n_series", "best_iteration",
                                            F.lit(res.rounds).alias("rounds"), "n_train_rows", "n_valid_rows")


@register("leafwise_scores", q(f"""
SELECT f.date, f.store_id, f.item_id, f.sales, true AS whole_and_not_negative
FROM fct_sales f, fct_last WHERE f.date > last_date - {VALID_DAYS}"""))
def leafwise_scores(spark, sf_dir):
    """M5: the booster's score of every validation row; each must be a whole number of at least 0."""
    res = leafwise(spark, sf_dir)
    p = F.col("predicted_sales")
    return (res.scored_valid.join(res.valid.select(*GRAIN, "sales"), GRAIN)
            .select(*GRAIN, "sales", ((p >= 0) & (p == F.rint(p))).alias("whole_and_not_negative")))


# The rows that the model is fitted and validated on, from the driver's tables.
MODEL_ROWS_SQL = """,
model_extract AS (
  SELECT f.date, store_id, item_id, sales, wday, year, event_name_1, event_type_1, snap_flag,
    LAST_VALUE(sell_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY f.date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price
  FROM fct_sales f, fct_last WHERE f.date BETWEEN last_date - 730 AND last_date),
""" + features_sql("model_extract", "model_features") + """
model_rows AS (
  SELECT f.*, f.date > m.cutoff AS valid FROM model_features f, model_split m
  WHERE sales_lag_28 IS NOT NULL AND sales_roll_std_7 IS NOT NULL AND sales_roll_std_28 IS NOT NULL
    AND sell_price IS NOT NULL),
prior AS (SELECT AVG(CAST(sales AS DOUBLE)) AS prior FROM model_rows WHERE NOT valid)
"""


def _encoding_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS key_column, {col} AS key,
  ROUND((COUNT(*) * AVG(CAST(sales AS DOUBLE)) + {mdl.ENCODING_SMOOTHING} * MAX(prior)) / (COUNT(*) + {mdl.ENCODING_SMOOTHING}), 6) AS enc
FROM model_rows, prior WHERE NOT valid GROUP BY {col}
UNION ALL SELECT '{col}', NULL, ROUND(prior, 6) FROM prior"""


@register("target_encodings", q(MODEL_ROWS_SQL + " UNION ALL ".join(map(_encoding_sql, mdl.TARGET_ENCODED))))
def target_encodings(spark, sf_dir):
    """M1: the store and item encodings that the model scores with; the null key holds the prior."""
    parts = [enc.select(F.lit(col).alias("key_column"), F.col(col).alias("key"), *r6("enc"))
             for col, enc in trained(spark, sf_dir)[0].encodings.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("model_split_counts", q(MODEL_ROWS_SQL + """
SELECT CAST(COUNT(*) FILTER (WHERE NOT valid) AS BIGINT) AS n_train_rows,
  CAST(COUNT(*) FILTER (WHERE valid) AS BIGINT) AS n_valid_rows FROM model_rows"""))
def model_split_counts(spark, sf_dir):
    """P13 + W12 + A17: rows the model was fitted and validated on."""
    return trained(spark, sf_dir)[1].select("n_train_rows", "n_valid_rows")


def _backtest(spark, sf_dir):
    L = layers(spark, sf_dir)
    targets = dates.backfill_targets(spark, L.last_date, BACKFILL_DAYS)
    hist = L.fct_window(F.date_sub(L.last_date, BACKFILL_DAYS + SERVING_HISTORY_DAYS))
    return mdl.backtest(hist.select(*RAW_SOURCE_COLUMNS), targets, trained(spark, sf_dir)[0])


@register("model_accuracy_daily", None)
def model_accuracy_daily(spark, sf_dir):
    """M5 -> I9 -> J2 -> A2: the model's backtest replaces the days of a prediction table,
    whose daily accuracy against the fact is returned."""
    L = layers(spark, sf_dir)
    path = scratch(spark, "model_predictions")
    io.replace_partitions(_backtest(spark, sf_dir), path)
    preds = spark.read.parquet(path)
    days = preds.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    actual = L.fct_window(days.select("lo").scalar(), days.select("hi").scalar())
    return marts.accuracy_daily(marts.prediction_accuracy(preds, actual))


@register("model_retrain_decision", None)
def model_retrain_decision(spark, sf_dir):
    """M3 -> I8 -> A15: the model's run and the drift checks are appended to their tables,
    and the decision reads the latest run, which is the model's."""
    metrics_row = trained(spark, sf_dir)[1]
    base = build_model_runs(spark, sf_dir)
    later = base.agg(F.max("trained_at")).scalar() + F.make_dt_interval(hours=F.lit(1))
    run = metrics_row.select(later.alias("trained_at"), "wrmsse", "mape", "rmse", "n_train_rows", "n_valid_rows")
    runs_path, checks_path = scratch(spark, "model_runs"), scratch(spark, "model_monitoring")
    io.append(base, runs_path)
    io.append(run, runs_path)
    io.append(model_monitoring(spark, sf_dir), checks_path)
    dec = drift.retrain_decision(drift.latest_batch(spark.read.parquet(checks_path)), spark.read.parquet(runs_path))
    return dec.select("n_drifted", "drift_trigger", *r6("latest_wrmsse"), "metric_trigger", "retrain")


@register("batch_scores", None)
def batch_scores(spark, sf_dir):
    """M4: one-step-ahead forecast of every series from the trailing 60 days."""
    L = layers(spark, sf_dir)
    recent = L.fct_window(F.date_sub(L.last_date, 60))
    # Q5: the table served from must carry every column training used.
    hist = quality.require_columns(recent, RAW_SOURCE_COLUMNS, "serving extract").select(*RAW_SOURCE_COLUMNS)
    return mdl.predict_next_day(hist, trained(spark, sf_dir)[0], calendar=L.dim_calendar, stores=L.dim_store)


@register("backtest_scores", None)
def backtest_scores(spark, sf_dir):
    """M5: backtest of the last 90 actual dates with features built once."""
    return _backtest(spark, sf_dir)


@register("score_rows", None)
def score_rows(spark, sf_dir):
    """M6: score caller-supplied feature rows (the last day's, prices carried);
    only the model's own feature columns are used (P17)."""
    L = layers(spark, sf_dir)
    recent = L.fct_window(F.date_sub(L.last_date, SERVING_HISTORY_DAYS)).select(*RAW_SOURCE_COLUMNS)
    rows = features.build_features(mdl.carry_price(recent)).filter(F.col("date") == L.last_date)
    model, _, cols = trained(spark, sf_dir)
    return mdl.score(model, rows.select(*GRAIN, *[c for c in cols if c not in GRAIN]))


@register("publish_gate", None)
def publish_gate(spark, sf_dir):
    """M7: publish iff validation wrmsse < 1.0; the model is copied to the
    serving path only when the gate passes."""
    model, metrics_row, _ = trained(spark, sf_dir)
    path = scratch(spark, "published_model")
    published = mdl.publish(model, metrics_row, path)
    return mdl.publish_gate(metrics_row).withColumn("published", F.lit(published))


@register("series_forecast", None)
def series_forecast(spark, sf_dir):
    """M9: one series' next-day forecast, a filter of the batch-score table."""
    from salescube.plans.catalog import POINT_ITEM, POINT_STORE
    L = layers(spark, sf_dir)
    one = (L.fct_window(F.date_sub(L.last_date, 60))
           .filter((F.col("store_id") == POINT_STORE) & (F.col("item_id") == POINT_ITEM))
           .select(*RAW_SOURCE_COLUMNS))
    # The point filter reaches the Parquet scan; the stub day is the series' own
    # last date + 1, as for a single-series request.
    return mdl.predict_next_day(one, trained(spark, sf_dir)[0], calendar=L.dim_calendar, stores=L.dim_store)


# --------------------------------------------------------------------------- CSV edge, daily catch-up

@register("csv_roundtrip", q("SELECT * FROM raw_sales_history"))
def csv_roundtrip(spark, sf_dir):
    """I3 + I1 + I17: long history written as month-partitioned CSV, append-loaded
    with a declared schema (no inference) into a raw Parquet table."""
    from salescube.schemas import SALES_HISTORY
    raw = layers(spark, sf_dir).raw.sales_history
    csv_path, table_path = scratch(spark, "history_csv"), scratch(spark, "raw_sales_history")
    io.write_long_history(raw, csv_path, fmt="csv")
    io.append_csv_to_table(spark, csv_path, SALES_HISTORY, table_path)
    return spark.read.parquet(table_path)


CATCH_UP_DAYS = 14


@register("catch_up_scores", q(f""",
ch_hist AS (SELECT date, store_id, item_id, sales FROM fct_sales WHERE date <= (SELECT MAX(date) FROM stg_sales_history)),
ch_last AS (SELECT MAX(date) AS d FROM ch_hist),
ch_tail AS (
  SELECT store_id, item_id, CAST(sales AS DOUBLE) AS x,
    ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM ch_hist),
ch_made AS (
  SELECT CAST(l.d + CAST(k.k AS INTEGER) AS DATE) AS date, t.store_id, t.item_id,
    round_even(GREATEST(COALESCE(AVG(CASE WHEN (t.rd - 1 + k.k) % 7 = 0 THEN t.x END),
      AVG(CASE WHEN t.rd <= 7 THEN t.x END), 0.0), 0.0), 0) AS p
  FROM ch_tail t, (SELECT UNNEST(range(1, {CATCH_UP_DAYS + 1})) AS k) k, ch_last l
  WHERE t.rd <= 56 GROUP BY 1, 2, 3)
SELECT m.store_id, m.item_id, CAST(COUNT(*) AS BIGINT) AS n_days, CAST(SUM(a.sales) AS BIGINT) AS actual_sales,
  CAST(SUM(p) AS BIGINT) AS predicted_sales, ROUND(AVG(ABS(p - a.sales)), 6) AS mae,
  ROUND(SQRT(AVG(POWER(p - a.sales, 2))), 6) AS rmse
FROM ch_made m JOIN stg_sales_daily_feed a ON a.date = m.date AND a.store_id = m.store_id AND a.item_id = m.item_id
GROUP BY m.store_id, m.item_id"""))
def catch_up_scores(spark, sf_dir):
    """W9 + H4: the days of the feed forecast from the frozen history and scored, series by series,
    against what the feed brought."""
    L = layers(spark, sf_dir)
    end = L.stg_sales_history.agg(F.max("date")).scalar()
    made = baselines.same_phase_forecast(L.fct_sales.filter(F.col("date") <= end), CATCH_UP_DAYS)
    err = F.col("predicted_sales") - F.col("sales")
    return (made.join(L.stg_sales_daily_feed.select(*GRAIN, "sales"), GRAIN).groupBy("store_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("sales").alias("actual_sales"),
        F.sum("predicted_sales").cast("long").alias("predicted_sales"), F.round(F.avg(F.abs(err)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse")))


def _catch_up_block_sql(name: str, src: str, offset: str) -> str:
    return f""",
{name}_tail AS (
  SELECT store_id, item_id, CAST(sales AS DOUBLE) AS x,
    ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM {src}),
{name} AS (
  SELECT CAST(l.d + {offset} + CAST(k.k AS INTEGER) AS DATE) AS date, t.store_id, t.item_id,
    CAST(round_even(GREATEST(COALESCE(
      AVG(CASE WHEN ((-t.rd) % 7 + 7) % 7 + 1 = k.k AND (t.rd + k.k - 1) / 7 BETWEEN 1 AND 8 THEN t.x END),
      AVG(CASE WHEN t.rd <= 7 THEN t.x END), 0.0), 0.0), 0) AS BIGINT) AS sales
  FROM {name}_tail t, (SELECT UNNEST(range(1, 8)) AS k) k, ch_last l
  WHERE t.rd <= 62 GROUP BY 1, 2, 3)"""


@register("daily_catch_up", q(""",
ch_hist AS (
  SELECT date, store_id, item_id, sales, sell_price FROM fct_sales
  WHERE date <= (SELECT MAX(date) FROM stg_sales_history)),
ch_last AS (SELECT MAX(date) AS d FROM ch_hist)""" + _catch_up_block_sql("b1", "ch_hist", "0") + """,
b2_src AS (SELECT date, store_id, item_id, sales FROM ch_hist UNION ALL SELECT date, store_id, item_id, sales FROM b1)"""
    + _catch_up_block_sql("b2", "b2_src", "7") + """
SELECT b.date, b.store_id, b.item_id, b.sales, p.sell_price
FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2) b
LEFT JOIN (SELECT store_id, item_id, arg_max(sell_price, date) AS sell_price FROM ch_hist
           WHERE sell_price IS NOT NULL GROUP BY store_id, item_id) p
  ON b.store_id = p.store_id AND b.item_id = p.item_id"""))
def daily_catch_up(spark, sf_dir):
    """I11 + I12 + W9 + H4 + U2: the daily ingest over a 14-day gap. The history
    is the fact up to the end of the frozen history; each generated week feeds
    the next; prices carry forward."""
    L = layers(spark, sf_dir)
    end = L.stg_sales_history.agg(F.max("date")).scalar()
    hist = L.fct_sales.filter(F.col("date") <= end).select("date", "store_id", "item_id", "sales", "sell_price")
    return baselines.catch_up(hist, CATCH_UP_DAYS)
