"""Registered queries over series that hold only their days with sales, and the next day's features.

``part_*`` queries take a series for each nation and part: their rows grow with
the line table, from 60 thousand at sf0.01 to ten times that at sf0.1, where a
panel of the same series would have a row for each of 2,500 days.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salescube.operators import metrics, sparse
from salescube.operators import model as mdl
from salescube.plans.catalog import FULL_PLAIN, LAG_COLS, MAPPING, ROLL_COLS, layers, r6, register
from salescube.plans.layers import Layers
from salescube.plans.oracle import PRELUDE_T, features_sql, q
from salescube.schemas import GRAIN, ID_COLUMNS, LAGS, RAW_SOURCE_COLUMNS, ROLLING_WINDOWS

HORIZON = 14
PARTS = {"store_level": "nation", "item_level": "part", "sparse": True}


def part_layers(spark, sf_dir) -> Layers:
    return Layers(spark, sf_dir, **PARTS)


def _part_prelude() -> str:
    """The prelude of the oracles with a series for each nation and part, and no panel."""
    text = PRELUDE_T.replace("r.r_name AS store_id, p.p_brand AS item_id",
                             "n.n_name AS store_id, CAST(l.l_partkey AS VARCHAR) AS item_id")
    a, b = text.index("panel AS MATERIALIZED ("), text.index("raw_sales_history AS (")
    text = text[:a] + "panel AS MATERIALIZED (SELECT date, store_id, item_id, sales FROM sales_base),\n" + text[b:]
    return text.replace("@@FEATURES_FULL@@", "")


PART_PRELUDE = _part_prelude()

# --------------------------------------------------------------------------- features


@register("feature_full_sold", q(f"""
SELECT {', '.join(FULL_PLAIN)}, sell_price,
  {', '.join(f'ROUND({c}, 6) AS {c}' for c in ROLL_COLS)} FROM features_full WHERE sales > 0"""))
def feature_full_sold(spark, sf_dir):
    """W1-W5 of the days with sales without a panel, equal to those of the panel's rows."""
    fct = Layers(spark, sf_dir, **MAPPING, sparse=True).fct_sales
    out = sparse.build_features(fct, start=fct.agg(F.min("date")).scalar())
    return out.select(*FULL_PLAIN, "sell_price", *r6(*ROLL_COLS))


PART_COLS = ["date", "store_id", "item_id", "sales", "sell_price", "wday", "year", "event_name_1", "event_type_1", "snap_flag"]


@register("part_sales", PART_PRELUDE + f"SELECT {', '.join(PART_COLS)}, month FROM fct_sales")
def part_sales(spark, sf_dir):
    """J1 with a series for each nation and part: as many rows as days with sales."""
    return part_layers(spark, sf_dir).build_fct_sales().select(*PART_COLS, "month")


def _frame(n: int, m: int) -> str:
    return f"OVER (PARTITION BY store_id, item_id ORDER BY day RANGE BETWEEN {n} PRECEDING AND {m} PRECEDING)"


def _rolling_sql(n: int) -> str:
    c = f"CAST(LEAST(age, {n}) AS DOUBLE)"
    s, ss = f"COALESCE(SUM(sales) {_frame(n, 1)}, 0)", f"COALESCE(SUM(sales * sales) {_frame(n, 1)}, 0)"
    return (f"ROUND(CASE WHEN age >= 1 THEN {s} / {c} END, 6) AS sales_roll_mean_{n}, "
            f"ROUND(CASE WHEN age >= 2 THEN SQRT(({c} * {ss} - {s} * {s}) / ({c} * ({c} - 1))) END, 6) AS sales_roll_std_{n}")


PART_FEATURES_SQL = PART_PRELUDE + f""",
aged AS (
  SELECT f.*, f.date - DATE '1970-01-01' AS day,
    f.date - MIN(f.date) OVER (PARTITION BY store_id, item_id) AS age FROM fct_sales f)
SELECT date, store_id, item_id, sales, sell_price,
  {', '.join(f"CASE WHEN age >= {k} THEN CAST(COALESCE(SUM(sales) {_frame(k, k)}, 0) AS DOUBLE) END AS sales_lag_{k}" for k in LAGS)},
  {', '.join(_rolling_sql(n) for n in ROLLING_WINDOWS)},
  CAST(COALESCE(day - 1 - MAX(CASE WHEN sales > 0 THEN day END) OVER (
    PARTITION BY store_id, item_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), age) AS DOUBLE) AS days_since_last_sale,
  CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(isodow(date) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
  CAST(month(date) AS INTEGER) AS month, CAST(COALESCE(snap_flag, 0) AS INTEGER) AS snap_flag,
  CAST(event_type_1 IS NOT NULL AS INTEGER) AS has_event, COALESCE(event_type_1, 'none') AS event_type_1
FROM aged"""


@register("part_features", PART_FEATURES_SQL)
def part_features(spark, sf_dir):
    """W1-W5 of a series for each nation and part, each from its own first sale on."""
    out = sparse.build_features(part_layers(spark, sf_dir).fct_sales)
    return out.select(*GRAIN, "sales", "sell_price", *LAG_COLS, *r6(*ROLL_COLS), "days_since_last_sale", "dayofweek",
                      "is_weekend", "month", "snap_flag", "has_event", "event_type_1")


# --------------------------------------------------------------------------- baselines

# The last eight weeks of the series that sold in them, day by day, from each series' first sale on.
def _forecast_sql(as_of: str) -> str:
    return f""",
cut AS (SELECT CAST({as_of} AS DATE) AS as_of FROM fct_last),
begun AS (SELECT store_id, item_id, MIN(date) AS first FROM fct_sales, cut WHERE date <= as_of GROUP BY ALL),
active AS (SELECT DISTINCT store_id, item_id FROM fct_sales, cut WHERE date <= as_of AND date > as_of - 56),
recent AS (
  SELECT a.store_id, a.item_id, b AS back, CAST(COALESCE(f.sales, 0) AS DOUBLE) AS sales, as_of - CAST(b AS INTEGER) >= g.first AS begun
  FROM active a CROSS JOIN range(0, 56) t(b) CROSS JOIN cut
  JOIN begun g ON g.store_id = a.store_id AND g.item_id = a.item_id
  LEFT JOIN fct_sales f ON f.store_id = a.store_id AND f.item_id = a.item_id AND f.date = as_of - CAST(b AS INTEGER)),
forecast AS (
  SELECT CAST(as_of + CAST(s AS INTEGER) AS DATE) AS date, r.store_id, r.item_id,
    MAX(CASE WHEN back = 0 THEN sales END) AS naive,
    MAX(CASE WHEN back = 6 - (s - 1) % 7 THEN sales END) AS seasonal,
    AVG(CASE WHEN (back + s) % 7 = 0 AND begun THEN sales END) AS phase_mean
  FROM recent r CROSS JOIN range(1, {HORIZON + 1}) t(s) CROSS JOIN cut GROUP BY as_of, s, r.store_id, r.item_id)
"""


@register("part_forecasts", PART_PRELUDE + _forecast_sql("last_date") + """
SELECT date, store_id, item_id, naive, seasonal, ROUND(phase_mean, 6) AS phase_mean FROM forecast""")
def part_forecasts(spark, sf_dir):
    """W6-W8 of the two weeks after the last day, for a series for each nation and part."""
    L = part_layers(spark, sf_dir)
    return (sparse.forecasts(L.fct_sales, L.last_date, HORIZON)
            .select(*GRAIN, "naive", "seasonal", *r6("phase_mean")))


@register("part_forecast_scores", PART_PRELUDE + _forecast_sql(f"last_date - {HORIZON}") + """,
scored AS (
  SELECT model, value, CAST(COALESCE(a.sales, 0) AS DOUBLE) AS sales
  FROM (UNPIVOT forecast ON naive, seasonal, phase_mean INTO NAME model VALUE value) f
  LEFT JOIN fct_sales a ON a.date = f.date AND a.store_id = f.store_id AND a.item_id = f.item_id)
SELECT model, ROUND(AVG(ABS(sales - value) / GREATEST(ABS(sales), 1.0)), 6) AS mape,
  ROUND(SQRT(AVG(POWER(sales - value, 2))), 6) AS rmse, CAST(COUNT(*) AS BIGINT) AS n
FROM scored GROUP BY model""")
def part_forecast_scores(spark, sf_dir):
    """The baselines of the last two weeks scored against what was sold, silent days as zeros."""
    L = part_layers(spark, sf_dir)
    made = sparse.forecasts(L.fct_sales, F.date_sub(L.last_date, HORIZON), HORIZON)
    # What was sold on the forecast's days, joined before each row becomes three.
    actual = (L.fct_sales.where(F.col("date") > F.date_sub(L.last_date, HORIZON))
              .select(*GRAIN, F.col("sales").alias("sold")))
    rows = (made.join(actual, GRAIN, "left").withColumn("sold", F.coalesce("sold", F.lit(0)).cast("double"))
            .unpivot([*GRAIN, "sold"], ["naive", "seasonal", "phase_mean"], "model", "value").where("value IS NOT NULL"))
    err = F.abs(F.col("sold") - F.col("value"))
    return rows.groupBy("model").agg(
        F.round(F.avg(metrics.floored_pct_error(F.col("sold"), F.col("value"))), 6).alias("mape"),
        F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"), F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- the next day

NEXT_COLS = [*LAG_COLS, "days_since_last_sale", "dayofweek", "is_weekend", "month", "snap_flag", "has_event",
             "event_type_1", "sell_price"]


@register("next_day_features", q(""",
before_event AS (SELECT MAX(date) - 1 AS as_of FROM stg_calendar WHERE event_type_1 IS NOT NULL),
stub_rows AS (
  SELECT f.date, f.store_id, f.item_id, f.sales, f.sell_price, f.wday, f.year, f.event_name_1, f.event_type_1, f.snap_flag
  FROM fct_sales f, before_event WHERE f.date <= as_of
  UNION ALL
  SELECT c.date, s.store_id, s.item_id, NULL, NULL, NULL, NULL, NULL, c.event_type_1,
    CASE st.state_id WHEN 'CA' THEN c.snap_ca WHEN 'TX' THEN c.snap_tx WHEN 'WI' THEN c.snap_wi END
  FROM (SELECT DISTINCT store_id, item_id FROM fct_sales) s
  CROSS JOIN before_event e JOIN stg_calendar c ON c.date = e.as_of + 1
  LEFT JOIN dim_store st ON st.store_id = s.store_id),
carried AS (
  SELECT * EXCLUDE (sell_price), LAST_VALUE(sell_price IGNORE NULLS) OVER (
    PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price
  FROM stub_rows),
""" + features_sql("carried", "next_features").rstrip().rstrip(",") + f"""
SELECT date, store_id, item_id, {', '.join(NEXT_COLS)},
  {', '.join(f'ROUND({c}, 6) AS {c}' for c in ROLL_COLS)}
FROM next_features, before_event WHERE date = as_of + 1"""))
def next_day_features(spark, sf_dir):
    """The rows that a next-day score reads, on the eve of the calendar's last event: price
    carried, the day's event and SNAP flag from the calendar."""
    L = layers(spark, sf_dir)
    eve = F.date_sub(L.dim_calendar.where(F.col("event_type_1").isNotNull()).agg(F.max("date")).scalar(), 1)
    hist = L.fct_sales.where(F.col("date") <= eve).select(*RAW_SOURCE_COLUMNS)
    out = mdl.next_day_features(hist, L.dim_calendar, L.dim_store)
    return out.select("date", *ID_COLUMNS, *NEXT_COLS, *r6(*ROLL_COLS))
