"""DuckDB oracle SQL for every registered query.

Each oracle is self-contained over the driver's tables: a shared CTE prelude
re-derives the raw layer (the same mapping as ``salescube.sources.mapping``),
staging and marts, and a final SELECT states the query. Computed columns carry
the same aliases as the Spark side; floating results that depend on
summation order are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from salescube.schemas import DATE_OFFSET_DAYS as OFF

FEATURES_T = """{name}_w AS (
  SELECT f.*,
    CAST(LAG(sales, 1) OVER w AS DOUBLE) AS sales_lag_1,
    CAST(LAG(sales, 2) OVER w AS DOUBLE) AS sales_lag_2,
    CAST(LAG(sales, 3) OVER w AS DOUBLE) AS sales_lag_3,
    CAST(LAG(sales, 7) OVER w AS DOUBLE) AS sales_lag_7,
    CAST(LAG(sales, 14) OVER w AS DOUBLE) AS sales_lag_14,
    CAST(LAG(sales, 28) OVER w AS DOUBLE) AS sales_lag_28,
    AVG(CAST(sales AS DOUBLE)) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_7,
    CASE WHEN COUNT(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 2 THEN SQRT((CAST(COUNT(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) * CAST(SUM(sales * sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      - CAST(SUM(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) * CAST(SUM(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE))
      / (CAST(COUNT(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) * (CAST(COUNT(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) - 1))) END AS sales_roll_std_7,
    AVG(CAST(sales AS DOUBLE)) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS sales_roll_mean_28,
    CASE WHEN COUNT(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 2 THEN SQRT((CAST(COUNT(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE) * CAST(SUM(sales * sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      - CAST(SUM(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE) * CAST(SUM(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE))
      / (CAST(COUNT(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE) * (CAST(COUNT(sales) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE) - 1))) END AS sales_roll_std_28,
    ROW_NUMBER() OVER w AS rn,
    CASE WHEN ROW_NUMBER() OVER w = 1 OR COALESCE(LAG(sales, 1) OVER w, 0) > 0
         THEN ROW_NUMBER() OVER w END AS reset_rn
  FROM {src} f
  WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)),
{name} AS (
  SELECT date, store_id, item_id, sales, sell_price, wday, year, event_name_1,
    COALESCE(event_type_1, 'none') AS event_type_1,
    CAST(COALESCE(snap_flag, 0) AS INTEGER) AS snap_flag,
    CAST(event_type_1 IS NOT NULL AS INTEGER) AS has_event,
    sales_lag_1, sales_lag_2, sales_lag_3, sales_lag_7, sales_lag_14, sales_lag_28,
    sales_roll_mean_7, sales_roll_std_7, sales_roll_mean_28, sales_roll_std_28,
    CAST(rn - MAX(reset_rn) OVER (PARTITION BY store_id, item_id ORDER BY date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS days_since_last_sale,
    CAST(isodow(date) - 1 AS INTEGER) AS dayofweek,
    CAST(isodow(date) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
    CAST(month(date) AS INTEGER) AS month
  FROM {name}_w),
"""


PRELUDE_T = f"""
WITH
line_facts AS MATERIALIZED (
  SELECT CAST(l.l_shipdate AS DATE) AS date, r.r_name AS store_id, p.p_brand AS item_id,
         l.l_quantity AS quantity, l.l_extendedprice / l.l_quantity AS unit_price
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
bounds AS (
  SELECT MIN(CAST(l_shipdate AS DATE)) AS d0, MAX(CAST(l_shipdate AS DATE)) AS d1 FROM lineitem),
sales_base AS MATERIALIZED (
  SELECT date, store_id, item_id, CAST(SUM(quantity) AS BIGINT) AS sales
  FROM line_facts GROUP BY date, store_id, item_id),
series AS (SELECT DISTINCT store_id, item_id FROM sales_base),
days AS (
  SELECT CAST(UNNEST(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
panel AS MATERIALIZED (
  SELECT d.date, s.store_id, s.item_id, CAST(COALESCE(b.sales, 0) AS BIGINT) AS sales
  FROM series s CROSS JOIN days d
  LEFT JOIN sales_base b ON b.store_id = s.store_id AND b.item_id = s.item_id AND b.date = d.date),
raw_sales_history AS (
  SELECT p.date, p.store_id, p.item_id,
    'D' || CAST(CAST(FLOOR((CAST(regexp_extract(p.item_id, '([0-9]+)$', 1) AS INTEGER) - 1) / 5) AS INTEGER) AS VARCHAR) AS dept_id,
    'C' || CAST(CAST(FLOOR((CAST(regexp_extract(p.item_id, '([0-9]+)$', 1) AS INTEGER) - 1) / 10) AS INTEGER) AS VARCHAR) AS cat_id,
    CASE p.store_id WHEN 'AFRICA' THEN 'CA' WHEN 'AMERICA' THEN 'TX' WHEN 'ASIA' THEN 'WI'
         ELSE p.store_id END AS state_id,
    p.sales
  FROM panel p, bounds WHERE p.date <= bounds.d1 - 14),
raw_sell_prices AS (
  SELECT f.store_id, f.item_id,
    CAST(11101 + FLOOR(((f.date - b.d0) + 1) / 7) AS INTEGER) AS wm_yr_wk,
    MIN(f.unit_price) AS sell_price
  FROM line_facts f, bounds b GROUP BY 1, 2, 3),
raw_sales_daily_feed AS (
  SELECT p.date, p.store_id, p.item_id, p.sales,
    CASE WHEN day(p.date) % 2 = 0 THEN CAST(CAST(FLOOR(ROUND(m.usual, 6)) AS BIGINT) AS VARCHAR) ELSE 'n/a' END AS sell_price
  FROM panel p
  JOIN (SELECT store_id, item_id, MEDIAN(sell_price) AS usual FROM raw_sell_prices GROUP BY store_id, item_id) m
    ON p.store_id = m.store_id AND p.item_id = m.item_id
  CROSS JOIN bounds WHERE p.date > bounds.d1 - 14),
raw_calendar AS MATERIALIZED (
  SELECT 'd_' || CAST((d.date - b.d0) + 1 AS VARCHAR) AS d, d.date,
    CAST(11101 + FLOOR(((d.date - b.d0) + 1) / 7) AS INTEGER) AS wm_yr_wk,
    dayname(d.date) AS weekday,
    CAST(((dayofweek(d.date) + 1) % 7) + 1 AS BIGINT) AS wday,
    CAST(month(d.date) AS INTEGER) AS month, CAST(year(d.date) AS INTEGER) AS year,
    CASE strftime(d.date, '%m-%d') WHEN '12-25' THEN 'Christmas' WHEN '02-14' THEN 'ValentinesDay' END AS event_name_1,
    CASE strftime(d.date, '%m-%d') WHEN '12-25' THEN 'National' WHEN '02-14' THEN 'Cultural' END AS event_type_1,
    CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
    CAST(day(d.date) <= 10 AS BIGINT) AS snap_ca,
    CAST(day(d.date) % 3 = 0 AS BIGINT) AS snap_tx,
    CAST(day(d.date) >= 20 AS BIGINT) AS snap_wi
  FROM days d, bounds b WHERE d.date <= b.d1 - 7),
stg_sales_history AS (
  SELECT date + {OFF} AS date, store_id, item_id, dept_id, cat_id, state_id,
         CAST(sales AS BIGINT) AS sales FROM raw_sales_history),
stg_sales_daily_feed AS (
  SELECT date + {OFF} AS date, store_id, item_id, CAST(sales AS BIGINT) AS sales,
         TRY_CAST(sell_price AS DOUBLE) AS sell_price FROM raw_sales_daily_feed),
stg_sales AS MATERIALIZED (
  SELECT date, store_id, item_id, sales, CAST(NULL AS DOUBLE) AS sell_price FROM stg_sales_history
  UNION ALL
  SELECT date, store_id, item_id, sales, sell_price FROM stg_sales_daily_feed),
stg_calendar AS (
  SELECT date + {OFF} AS date, wm_yr_wk, weekday, wday,
    CAST(month(date + {OFF}) AS INTEGER) AS month, CAST(year(date + {OFF}) AS INTEGER) AS year,
    event_name_1, event_type_1, event_name_2, event_type_2, snap_ca, snap_tx, snap_wi
  FROM raw_calendar),
stg_prices AS MATERIALIZED (
  SELECT store_id, item_id, wm_yr_wk, CAST(sell_price AS DOUBLE) AS sell_price FROM raw_sell_prices),
dim_item AS (SELECT DISTINCT item_id, dept_id, cat_id FROM stg_sales_history),
dim_store AS (SELECT DISTINCT store_id, state_id FROM stg_sales_history),
dim_calendar AS (SELECT * FROM stg_calendar),
fct_sales AS (
  SELECT s.date, s.store_id, s.item_id, s.sales,
    COALESCE(s.sell_price, pr.sell_price) AS sell_price,
    c.wday, c.month, c.year, c.event_name_1, c.event_type_1,
    CASE st.state_id WHEN 'CA' THEN c.snap_ca WHEN 'TX' THEN c.snap_tx WHEN 'WI' THEN c.snap_wi END AS snap_flag
  FROM stg_sales s
  LEFT JOIN dim_calendar c ON s.date = c.date
  LEFT JOIN dim_store st ON s.store_id = st.store_id
  LEFT JOIN stg_prices pr ON s.store_id = pr.store_id AND s.item_id = pr.item_id AND c.wm_yr_wk = pr.wm_yr_wk),
fct_last AS (SELECT MAX(date) AS last_date FROM fct_sales),
fct_sales_predictions AS (
  SELECT date, store_id, item_id, predicted_sales FROM (
    SELECT date, store_id, item_id,
      CAST(LAG(sales, 7) OVER (PARTITION BY store_id, item_id ORDER BY date) AS DOUBLE) AS predicted_sales
    FROM fct_sales) t, fct_last WHERE t.date > fct_last.last_date - 90),
fct_prediction_accuracy AS (
  SELECT p.date, p.store_id, p.item_id, p.predicted_sales, a.sales AS actual_sales,
    ABS(p.predicted_sales - a.sales) AS abs_error,
    CASE WHEN a.sales > 0 THEN ABS(p.predicted_sales - a.sales) / a.sales END AS pct_error
  FROM fct_sales_predictions p
  JOIN fct_sales a ON p.date = a.date AND p.store_id = a.store_id AND p.item_id = a.item_id),
agg_prediction_accuracy_daily AS (
  SELECT date, CAST(COUNT(*) AS BIGINT) AS n_predictions, AVG(abs_error) AS mae, AVG(pct_error) AS mape,
    SQRT(AVG(POWER(predicted_sales - actual_sales, 2))) AS rmse
  FROM fct_prediction_accuracy GROUP BY date),
@@FEATURES_FULL@@holdout_bounds AS (SELECT last_date - 14 AS cutoff FROM fct_last),
holdout_train AS (SELECT f.* FROM fct_sales f, holdout_bounds h WHERE f.date <= h.cutoff),
holdout_valid AS (SELECT f.* FROM fct_sales f, holdout_bounds h WHERE f.date > h.cutoff),
model_split AS (SELECT last_date - 28 AS cutoff FROM fct_last),
model_train AS (SELECT f.* FROM fct_sales f, model_split m WHERE f.date <= m.cutoff),
model_valid AS (SELECT f.* FROM fct_sales f, model_split m WHERE f.date > m.cutoff)
"""


def features_sql(src: str, name: str) -> str:
    """CTEs `<name>_w` and `<name>`: all features (W1-W5, P5, P11, P12) over the rows of `src`."""
    return FEATURES_T.format(src=src, name=name)


PRELUDE = PRELUDE_T.replace("@@FEATURES_FULL@@", features_sql("fct_sales", "features_full"))


def q(body: str) -> str:
    return PRELUDE + body
