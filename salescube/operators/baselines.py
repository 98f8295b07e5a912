"""Baseline forecasts and the holdout split.

Per-series "last value" / "last m values" are found with aggregates or a
descending row number on the series window; only a bounded tail (≤ m rows,
m = season length) is ever collected per series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescube.schemas import ID_COLUMNS, SAME_PHASE_WEEKS, SEASON_LENGTH, VALID_DAYS


def clip_round(c: Column) -> Column:
    """max(0, x) rounded half-to-even."""
    return F.rint(F.greatest(c, F.lit(0.0)))


def time_split(df: DataFrame, valid_days: int = VALID_DAYS) -> tuple[DataFrame, DataFrame]:
    """cutoff = global max(date) - valid_days; train <= cutoff < valid."""
    cutoff = F.date_sub(df.agg(F.max("date")).scalar(), valid_days)
    return df.filter(F.col("date") <= cutoff), df.filter(F.col("date") > cutoff)


def _steps(horizon: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(horizon)))


def naive_forecast(history: DataFrame, horizon: int) -> DataFrame:
    """Each series' last value repeated for `horizon` days after its own last date."""
    last = history.groupBy(*ID_COLUMNS).agg(F.max("date").alias("last_date"),
                                           F.max_by("sales", "date").alias("last_value"))
    return (last.select(*ID_COLUMNS, "last_date", "last_value", _steps(horizon).alias("step"))
            .select(F.date_add("last_date", F.col("step")).alias("date"), *ID_COLUMNS,
                    F.col("last_value").alias("sales")))


def _tail(history: DataFrame, m: int) -> DataFrame:
    """Last `m` rows of each series with rd = 1 for the latest row."""
    w = Window.partitionBy(*ID_COLUMNS).orderBy(F.col("date").desc())
    return history.withColumn("rd", F.row_number().over(w)).filter(F.col("rd") <= m)


def seasonal_naive_forecast(history: DataFrame, horizon: int,
                            season_length: int = SEASON_LENGTH) -> DataFrame:
    """Last `season_length` values cycled forward; short series cycle what they have."""
    tail = (_tail(history, season_length).groupBy(*ID_COLUMNS)
            .agg(F.max("date").alias("last_date"),
                 F.sort_array(F.collect_list(F.struct("date", "sales"))).alias("tail")))
    step = F.col("step")
    pick = F.element_at("tail", (F.pmod(step - 1, F.size("tail")) + 1).cast("int"))
    return (tail.select(*ID_COLUMNS, "last_date", "tail", _steps(horizon).alias("step"))
            .select(F.date_add("last_date", step).alias("date"), *ID_COLUMNS,
                    pick.getField("sales").alias("sales")))


def same_phase_mean(history: DataFrame, weeks: int = SAME_PHASE_WEEKS,
                    phase: str = "target") -> DataFrame:
    """Mean of every 7th row back over `weeks` weeks, per series.

    ``phase="last"`` starts at the last row (the application's behaviour);
    ``phase="target"`` starts 7 rows back, i.e. the weekday of the next day.
    Output: store_id, item_id, last_date, baseline.
    """
    if phase not in ("last", "target"):
        raise ValueError(f"unknown phase {phase!r}")
    t = _tail(history, weeks * 7)
    on_phase = ((F.col("rd") - 1) % 7 == 0) if phase == "last" else (F.col("rd") % 7 == 0)
    x = F.col("sales").cast("double")
    # Fallback when no row sits on the phase (series shorter than 7 rows):
    # the mean of the last 7 rows.
    return t.groupBy(*ID_COLUMNS).agg(
        F.max("date").alias("last_date"),
        F.coalesce(F.avg(F.when(on_phase, x)), F.avg(F.when(F.col("rd") <= 7, x))).alias("baseline"))


def next_day_table(history: DataFrame, phase: str = "target", as_of=None) -> DataFrame:
    """One row per series for the next day: rounded non-negative same-phase mean,
    plus the series' last known price carried forward (NULL if never known) (W9).

    `as_of` defaults to the global max(date) + 1.
    """
    base = same_phase_mean(history, phase=phase)
    day = (F.date_add(history.agg(F.max("date")).scalar(), 1) if as_of is None
           else F.lit(as_of).cast("date"))
    cols = [day.alias("date"), *ID_COLUMNS,
            clip_round(F.coalesce(F.col("baseline"), F.lit(0.0))).cast("long").alias("sales")]
    if "sell_price" in history.columns:
        price = (history.filter(F.col("sell_price").isNotNull()).groupBy(*ID_COLUMNS)
                 .agg(F.max_by("sell_price", "date").alias("sell_price")))
        base = base.join(price, ID_COLUMNS, "left")
        cols.append(F.col("sell_price"))
    return base.select(*cols)


def same_phase_forecast(history: DataFrame, n_days: int, weeks: int = SAME_PHASE_WEEKS) -> DataFrame:
    """The `n_days` days after the global last date, for every series (W9 over a gap of days, H4).

    A day's forecast is the mean of the series' last `weeks` rows that lie a
    whole number of weeks before it, rounded and not negative; only rows of
    the history count, so days a week apart have the same one. Each tail row
    belongs to one of seven phases: one grouped aggregate covers all days.
    Series shorter than a week take the mean of their last seven rows for the
    phases that they lack. Output: date, store_id, item_id, predicted_sales.
    """
    x = F.col("sales").cast("double")
    phase = F.pmod(-F.col("rd"), F.lit(7))          # 0: in phase with the first day after the last row
    means = [F.avg(F.when(phase == i, x)) for i in range(7)]
    agg = _tail(history.select("date", *ID_COLUMNS, "sales"), weeks * 7).groupBy(*ID_COLUMNS).agg(
        F.array(*means).alias("m"), F.avg(F.when(F.col("rd") <= 7, x)).alias("fallback"))
    ahead = agg.select(*ID_COLUMNS, "m", "fallback", F.explode(F.sequence(F.lit(1), F.lit(n_days))).alias("step"))
    base = F.get("m", F.pmod(F.col("step") - 1, F.lit(7)))
    last = history.agg(F.max("date")).scalar()
    return ahead.select(F.date_add(last, F.col("step")).alias("date"), *ID_COLUMNS,
                        clip_round(F.coalesce(base, "fallback", F.lit(0.0))).alias("predicted_sales"))


def _block(work: DataFrame, start_day, block: int, weeks: int) -> DataFrame:
    """Next `block` (≤ 7) days of every series from its trailing rows.

    Target k days after the series' last row averages the rows at row
    distance 7j - k + 1 (j = 1..weeks), i.e. the same weekday as the target,
    all at least 7 rows old. Each tail row feeds exactly one k, so one grouped
    aggregate with `block` conditional means covers the whole block.
    """
    t = _tail(work, weeks * 7 + 6)
    x = F.col("sales").cast("double")
    k = F.pmod(-F.col("rd"), F.lit(7)) + 1
    j = (F.col("rd") + k - 1) / 7
    means = [F.avg(F.when((k == i) & (j >= 1) & (j <= weeks), x)) for i in range(1, block + 1)]
    agg = t.groupBy(*ID_COLUMNS).agg(F.array(*means).alias("m"),
                                     F.avg(F.when(F.col("rd") <= 7, x)).alias("fallback"))
    out = agg.select(*ID_COLUMNS, "fallback", F.posexplode("m").alias("pos", "base"))
    return out.select(F.date_add(start_day, F.col("pos")).alias("date"), *ID_COLUMNS,
                      clip_round(F.coalesce("base", "fallback", F.lit(0.0))).cast("long").alias("sales"))


def catch_up(history: DataFrame, n_days: int, weeks: int = SAME_PHASE_WEEKS,
             cut=None) -> DataFrame:
    """Recursive forecast of the `n_days` days after the global last date for every series,
    each day fed by the days before it (W9 over a multi-day gap, H4).

    Blocks of ≤ 7 days need only rows ≥ 7 days old, so each block is one pass;
    blocks are chained over a bounded working set (≤ weeks·7+6 rows per
    series) whose lineage is cut between blocks with `cut` (a reliable
    checkpoint). The series' last known price is carried forward (NULL if
    never known). Output: date, store_id, item_id, sales[, sell_price].
    """
    from salescube.session import cut_lineage
    cut = cut or cut_lineage
    last = history.agg(F.max("date")).scalar()
    work = _tail(history.select("date", *ID_COLUMNS, "sales"), weeks * 7 + 6).drop("rd")
    generated = None
    done = 0
    while done < n_days:
        block = min(7, n_days - done)
        rows = _block(work, F.date_add(last, done + 1), block, weeks)
        rows = cut(rows)
        generated = rows if generated is None else generated.unionByName(rows)
        work = cut(_tail(work.unionByName(rows), weeks * 7 + 6).drop("rd"))
        done += block
    if "sell_price" in history.columns:
        price = (history.filter(F.col("sell_price").isNotNull()).groupBy(*ID_COLUMNS)
                 .agg(F.max_by("sell_price", "date").alias("sell_price")))
        generated = generated.join(price, ID_COLUMNS, "left")
    return generated
