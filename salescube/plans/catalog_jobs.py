"""Registered queries for drift monitoring, run tracking and gates.

``model_monitoring`` and ``model_runs`` are derived from the data:

* monitoring holds two PSI batches over features built ONCE on the whole fact
  (the corrected window semantics): an older check comparing the first
  quarter of days with the second quarter, stamped at the mid day, and the
  latest check comparing the two halves, stamped at the last day;
* runs holds the holdout evaluation (last 28 days) of the naive and the
  seasonal-naive baseline, stamped at the split cutoff + 0 h / + 1 h.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.operators import baselines, drift, features, metrics, sketches
from salescube.plans.catalog import layers, r6, register
from salescube.plans.oracle import features_sql, q
from salescube.schemas import (BASE_NUMERIC_FEATURES, GRAIN, OPTIONAL_NUMERIC_FEATURES, PSI_THRESHOLD,
                               VALID_DAYS)

DRIFT_FEATURES = BASE_NUMERIC_FEATURES + OPTIONAL_NUMERIC_FEATURES


# --------------------------------------------------------------------------- spark side

def _day_marks(fct: DataFrame):
    lo, hi = fct.agg(F.min("date")).scalar(), fct.agg(F.max("date")).scalar()
    span = F.datediff(hi, lo)
    mid = F.date_add(lo, F.floor(span / 2).cast("int"))
    q1 = F.date_add(lo, F.floor(span / 4).cast("int"))
    return hi, mid, q1


def drift_features(spark, sf_dir) -> DataFrame:
    """The featured fact (W5), stored once; drift reads it instead of re-windowing."""
    L = layers(spark, sf_dir)
    feat = L._keep("features", lambda: features.build_features(L.fct_sales))
    keep = [F.col(c).cast("double").alias(c)
            for c in DRIFT_FEATURES if c in feat.columns]
    return feat.select("date", *keep)


def drift_batches(spark, sf_dir) -> DataFrame:
    L = layers(spark, sf_dir)
    feat = drift_features(spark, sf_dir)
    hi, mid, q1 = _day_marks(L.fct_sales)
    d = F.col("date")
    res = drift.check_feature_drift_batches(
        feat, {"old": (d <= q1, (d > q1) & (d <= mid)), "new": (d <= mid, d > mid)}, DRIFT_FEATURES)
    checked = F.when(F.col("batch") == "old", mid).otherwise(hi).cast("timestamp_ntz")
    return res.select("feature", "psi", "drifted", checked.alias("checked_at"))


def model_monitoring(spark, sf_dir) -> DataFrame:
    L = layers(spark, sf_dir)
    return L._keep("model_monitoring", lambda: drift_batches(spark, sf_dir))


def build_model_runs(spark, sf_dir) -> DataFrame:
    L = layers(spark, sf_dir)
    hist = L.fct_sales.select(*GRAIN, "sales")
    train, valid = baselines.time_split(hist, VALID_DAYS)
    cutoff = F.date_sub(hist.agg(F.max("date")).scalar(), VALID_DAYS).cast("timestamp_ntz")
    n_train = train.agg(F.count(F.lit(1))).scalar()
    n_valid = valid.agg(F.count(F.lit(1))).scalar()
    out = None
    for k, fc in enumerate((baselines.naive_forecast(train, VALID_DAYS),
                            baselines.seasonal_naive_forecast(train, VALID_DAYS))):
        ev = metrics.evaluate_predictions(valid, fc, train)
        row = ev.select((cutoff + F.make_dt_interval(hours=F.lit(k))).alias("trained_at"),
                        "wrmsse", "mape", "rmse", n_train.alias("n_train_rows"),
                        n_valid.alias("n_valid_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def model_runs(spark, sf_dir) -> DataFrame:
    return layers(spark, sf_dir)._keep("model_runs", lambda: build_model_runs(spark, sf_dir))


# --------------------------------------------------------------------------- oracle side

def _levels() -> str:
    return "[" + ", ".join(repr(x) for x in drift.quantile_levels(10)) + "]"


FEATS = ", ".join(DRIFT_FEATURES)
DRIFT_PRELUDE = f""",
feat_long AS (
  UNPIVOT (SELECT date, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_FEATURES)} FROM features_full)
  ON {FEATS} INTO NAME feature VALUE value),
marks AS (
  SELECT hi, lo + CAST(FLOOR((hi - lo) / 2) AS INTEGER) AS mid, lo + CAST(FLOOR((hi - lo) / 4) AS INTEGER) AS q1
  FROM (SELECT MIN(date) AS lo, MAX(date) AS hi FROM fct_sales))
"""


def psi_cte(tag: str, ref_where: str, cur_where: str) -> str:
    return f""",
ref_{tag} AS (SELECT feature, value FROM feat_long, marks WHERE {ref_where}),
cur_{tag} AS (SELECT feature, value FROM feat_long, marks WHERE {cur_where}),
edges_{tag} AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, {_levels()}))) AS edges, COUNT(*) AS n_ref
  FROM ref_{tag} GROUP BY feature),
refb_{tag} AS (
  SELECT r.feature, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x <= r.value)) AS bin, COUNT(*) AS c
  FROM ref_{tag} r JOIN edges_{tag} e ON r.feature = e.feature GROUP BY 1, 2),
curb_{tag} AS (
  SELECT r.feature, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x <= r.value)) AS bin, COUNT(*) AS c
  FROM cur_{tag} r JOIN edges_{tag} e ON r.feature = e.feature GROUP BY 1, 2),
curn_{tag} AS (SELECT feature, COUNT(*) AS n_cur FROM cur_{tag} GROUP BY feature),
grid_{tag} AS (
  SELECT feature, n_ref, UNNEST(range(0, len(edges) - 1)) AS bin FROM edges_{tag} WHERE len(edges) >= 3),
terms_{tag} AS (
  SELECT g.feature,
    COALESCE(cb.c, 0) / cn.n_cur + 1e-6 AS cp, COALESCE(rb.c, 0) / g.n_ref + 1e-6 AS rp
  FROM grid_{tag} g JOIN curn_{tag} cn ON g.feature = cn.feature
  LEFT JOIN refb_{tag} rb ON g.feature = rb.feature AND g.bin = rb.bin
  LEFT JOIN curb_{tag} cb ON g.feature = cb.feature AND g.bin = cb.bin),
psi_{tag} AS (
  SELECT e.feature, COALESCE(t.psi, 0.0) AS psi
  FROM edges_{tag} e LEFT JOIN (SELECT feature, SUM((cp - rp) * ln(cp / rp)) AS psi FROM terms_{tag} GROUP BY feature) t
    ON e.feature = t.feature)
"""


MONITORING_SQL = (DRIFT_PRELUDE + psi_cte("old", "date <= q1", "date > q1 AND date <= mid")
                  + psi_cte("new", "date <= mid", "date > mid") + f""",
model_monitoring AS (
  SELECT feature, psi, psi > {PSI_THRESHOLD} AS drifted, CAST((SELECT mid FROM marks) AS TIMESTAMP) AS checked_at FROM psi_old
  UNION ALL
  SELECT feature, psi, psi > {PSI_THRESHOLD} AS drifted, CAST((SELECT hi FROM marks) AS TIMESTAMP) AS checked_at FROM psi_new)
""")

RUNS_SQL = """,
valid_cut AS (SELECT last_date - 28 AS cutoff FROM fct_last),
r_train AS (SELECT f.date, f.store_id, f.item_id, f.sales FROM fct_sales f, valid_cut v WHERE f.date <= v.cutoff),
r_valid AS (SELECT f.date, f.store_id, f.item_id, f.sales FROM fct_sales f, valid_cut v WHERE f.date > v.cutoff),
r_naive AS (
  SELECT CAST(last_date + CAST(s AS INTEGER) AS DATE) AS date, store_id, item_id, last_value AS sales
  FROM (SELECT store_id, item_id, MAX(date) AS last_date, arg_max(sales, date) AS last_value
        FROM r_train GROUP BY store_id, item_id), range(1, 29) t(s)),
r_tail AS (
  SELECT store_id, item_id, date, sales,
    ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd,
    LEAST(COUNT(*) OVER (PARTITION BY store_id, item_id), 7) AS m,
    MAX(date) OVER (PARTITION BY store_id, item_id) AS last_date
  FROM r_train),
r_seasonal AS (
  SELECT CAST(t.last_date + CAST(s.step AS INTEGER) AS DATE) AS date, t.store_id, t.item_id, t.sales
  FROM r_tail t, (SELECT UNNEST(range(1, 29)) AS step) s
  WHERE t.rd <= t.m AND t.rd = t.m - ((s.step - 1) % t.m)),
r_scale AS (
  SELECT store_id, item_id,
    CASE WHEN AVG(POWER(diff, 2)) > 0 THEN AVG(POWER(diff, 2)) ELSE 1.0 END AS scale, SUM(sales) AS total_sales
  FROM (SELECT store_id, item_id, CAST(sales AS DOUBLE) AS sales,
          CAST(sales AS DOUBLE) - LAG(CAST(sales AS DOUBLE)) OVER (PARTITION BY store_id, item_id ORDER BY date) AS diff
        FROM r_train) GROUP BY store_id, item_id),
r_fc AS (SELECT 0 AS k, * FROM r_naive UNION ALL SELECT 1 AS k, * FROM r_seasonal),
r_per AS (
  SELECT f.k, a.store_id, a.item_id, COUNT(*) AS n, SUM(POWER(a.sales - f.sales, 2)) AS sse,
    SUM(ABS(a.sales - f.sales) / GREATEST(ABS(a.sales), 1.0)) AS spe
  FROM r_valid a JOIN r_fc f ON a.date = f.date AND a.store_id = f.store_id AND a.item_id = f.item_id
  GROUP BY 1, 2, 3),
r_series AS (
  SELECT p.k, p.n, p.sse, p.spe, SQRT(p.sse / p.n / COALESCE(s.scale, 1.0)) AS rmsse,
    COALESCE(s.total_sales, 0.0) AS total_sales
  FROM r_per p LEFT JOIN r_scale s ON p.store_id = s.store_id AND p.item_id = s.item_id),
model_runs AS (
  SELECT CAST((SELECT cutoff FROM valid_cut) AS TIMESTAMP) + k * INTERVAL 1 HOUR AS trained_at,
    CASE WHEN SUM(total_sales) = 0 THEN AVG(rmsse) ELSE SUM(rmsse * total_sales) / SUM(total_sales) END AS wrmsse,
    SUM(spe) / SUM(n) AS mape, SQRT(SUM(sse) / SUM(n)) AS rmse,
    (SELECT CAST(COUNT(*) AS BIGINT) FROM r_train) AS n_train_rows,
    (SELECT CAST(COUNT(*) AS BIGINT) FROM r_valid) AS n_valid_rows
  FROM r_series GROUP BY k)
"""


# --------------------------------------------------------------------------- registrations

@register("psi_drift", q(DRIFT_PRELUDE + psi_cte("new", "date <= mid", "date > mid") + f"""
SELECT feature, ROUND(psi, 6) AS psi, psi > {PSI_THRESHOLD} AS drifted FROM psi_new"""))
def psi_drift(spark, sf_dir):
    """A11 + A12: PSI per numeric feature, first half of days vs second half."""
    L = layers(spark, sf_dir)
    feat = drift_features(spark, sf_dir)
    hi, mid, _ = _day_marks(L.fct_sales)
    res = drift.check_feature_drift_split(feat, F.col("date") <= mid, F.col("date") > mid,
                                          DRIFT_FEATURES)
    return res.select("feature", *r6("psi"), "drifted")


@register("latest_drift_batch", q(MONITORING_SQL + """
SELECT feature, ROUND(psi, 6) AS psi, drifted, checked_at FROM model_monitoring
WHERE checked_at = (SELECT MAX(checked_at) FROM model_monitoring)"""))
def latest_drift_batch(spark, sf_dir):
    """Rows of the most recent drift check (uncorrelated scalar subquery)."""
    return drift.latest_batch(model_monitoring(spark, sf_dir)).select(
        "feature", *r6("psi"), "drifted", "checked_at")


@register("model_runs", q(RUNS_SQL + """
SELECT trained_at, ROUND(wrmsse, 6) AS wrmsse, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse,
  n_train_rows, n_valid_rows FROM model_runs"""))
def model_runs_query(spark, sf_dir):
    """A10 + A17 per evaluated model: the run table the gates read."""
    return build_model_runs(spark, sf_dir).select(
        "trained_at", *r6("wrmsse", "mape", "rmse"), "n_train_rows", "n_valid_rows")


@register("latest_run", q(RUNS_SQL + """
SELECT trained_at, ROUND(wrmsse, 6) AS wrmsse, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse, n_train_rows
FROM model_runs ORDER BY trained_at DESC LIMIT 1"""))
def latest_run(spark, sf_dir):
    """S3 + R6: latest run card."""
    return drift.latest_run(model_runs(spark, sf_dir)).select(
        "trained_at", *r6("wrmsse", "mape", "rmse"), "n_train_rows")


@register("retrain_decision", q(MONITORING_SQL + RUNS_SQL + """,
latest AS (SELECT * FROM model_monitoring WHERE checked_at = (SELECT MAX(checked_at) FROM model_monitoring)),
lw AS (SELECT wrmsse FROM model_runs ORDER BY trained_at DESC LIMIT 1)
SELECT n_drifted, n_drifted >= 1 AS drift_trigger, ROUND(w, 6) AS latest_wrmsse,
  COALESCE(w > 1.0, FALSE) AS metric_trigger,
  (n_drifted >= 1) OR COALESCE(w > 1.0, FALSE) AS retrain
FROM (SELECT CAST(COUNT(*) FILTER (WHERE drifted) AS BIGINT) AS n_drifted, (SELECT wrmsse FROM lw) AS w FROM latest)"""))
def retrain_decision(spark, sf_dir):
    """A15 + M8: drift on the latest batch OR latest wrmsse above threshold."""
    dec = drift.retrain_decision(drift.latest_batch(model_monitoring(spark, sf_dir)),
                                 model_runs(spark, sf_dir))
    return dec.select("n_drifted", "drift_trigger", *r6("latest_wrmsse"), "metric_trigger", "retrain")


SKETCH_TOLERANCE = 0.05     # what the sketches' rank error may change in a PSI


@register("psi_drift_sketches", q(MONITORING_SQL + """
SELECT p.feature, r.n AS n_ref, c.n AS n_cur, TRUE AS near_exact
FROM psi_new p
JOIN (SELECT feature, CAST(COUNT(*) AS BIGINT) AS n FROM ref_new GROUP BY feature) r ON r.feature = p.feature
JOIN (SELECT feature, CAST(COUNT(*) AS BIGINT) AS n FROM cur_new GROUP BY feature) c ON c.feature = p.feature"""))
def psi_drift_sketches(spark, sf_dir):
    """A11 + I6: the drift check from stored day sketches alone; beside it, whether each PSI is
    that of the stored exact check of the same windows."""
    L = layers(spark, sf_dir)
    days = L._keep("day_sketches", lambda: sketches.day_sketches(drift_features(spark, sf_dir), DRIFT_FEATURES))
    _, mid, _ = _day_marks(L.fct_sales)
    made = sketches.sketch_drift(days, F.col("date") <= mid, F.col("date") > mid)
    exact = drift.latest_batch(model_monitoring(spark, sf_dir)).select("feature", F.col("psi").alias("exact"))
    return made.join(exact, "feature").select(
        "feature", "n_ref", "n_cur", (F.abs(F.col("psi") - F.col("exact")) <= SKETCH_TOLERANCE).alias("near_exact"))


# --------------------------------------------------------------------------- reference-window drift

REFERENCE_DAYS, CURRENT_DAYS = 365, 30


def _unpivot_sql(src: str, side: str) -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_FEATURES)
    return (f"SELECT '{side}' AS side, feature, value FROM "
            f"(UNPIVOT (SELECT {cols} FROM {src}) ON {FEATS} INTO NAME feature VALUE value)")


@register("psi_drift_reference_windows", q(f""",
dr_bounds AS (SELECT last_date AS today, last_date - {CURRENT_DAYS} AS cs,
                     last_date - {CURRENT_DAYS} - {REFERENCE_DAYS} AS rs FROM fct_last),
dr_ref_src AS (SELECT f.* FROM fct_sales f, dr_bounds b WHERE f.date BETWEEN b.rs AND b.cs),
dr_cur_src AS (SELECT f.* FROM fct_sales f, dr_bounds b WHERE f.date BETWEEN b.cs AND b.today),
""" + features_sql("dr_ref_src", "dr_ref") + features_sql("dr_cur_src", "dr_cur") + f"""
feat_long AS ({_unpivot_sql("dr_ref", "ref")} UNION ALL {_unpivot_sql("dr_cur", "cur")}),
marks AS (SELECT 1 AS one)""" + psi_cte("rw", "side = 'ref'", "side = 'cur'") + f"""
SELECT feature, ROUND(psi, 6) AS psi, psi > {PSI_THRESHOLD} AS drifted FROM psi_rw"""))
def psi_drift_reference_windows(spark, sf_dir):
    """I6 + A12 with the application's own windows: reference = [today-395, today-30]
    and current = [today-30, today], both inclusive (one shared day), features
    rebuilt inside each window (so lag 28 is mostly NULL on the current side)."""
    from salescube.schemas import RAW_SOURCE_COLUMNS
    L = layers(spark, sf_dir)
    today = L.last_date
    cs = F.date_sub(today, CURRENT_DAYS)
    rs = F.date_sub(cs, REFERENCE_DAYS)

    def feats(lo, hi):
        f = features.build_features(L.fct_window(lo, hi).select(*RAW_SOURCE_COLUMNS))
        return f.select(*[F.col(c).cast("double").alias(c)
                          for c in DRIFT_FEATURES if c in f.columns])

    res = drift.check_feature_drift(feats(rs, cs), feats(cs, today), DRIFT_FEATURES)
    return res.select("feature", *r6("psi"), "drifted")
