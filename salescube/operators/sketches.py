"""Drift checks from stored day sketches.

Each day and feature has one mergeable KLL sketch, written once when the day is
in. A check merges the sketches of its two windows and reads nothing else, so
its cost goes by days and features, not by rows. The exact path of ``drift``
stays the default.

A sketch holds some K values (all of them while there are fewer) whatever the
rows of its day. With K = 1,024 the rank of a value is off by less than 0.5 %
of the rows at 99 % confidence, after merges too; so is each bin's edge, and a
bin's share by less than twice that. Features that are constant, or have fewer
than three distinct edges, get a PSI of 0, as in the exact path; so does a
feature without current rows. One without reference rows has no row. Nulls and
NaN are left out, rows without a date too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.operators.drift import numeric_features, quantile_levels
from salescube.schemas import PSI_BINS, PSI_EPSILON, PSI_THRESHOLD
from salescube.session import cut_lineage

K = 1024
RANK_ERROR = 0.005


def day_sketches(df: DataFrame, feature_cols: list[str], k: int = K, date: str = "date") -> DataFrame:
    """date, feature, sketch, n: sketches are built in the map tasks and merged in the shuffle."""
    feats = numeric_features(df, feature_cols)
    long = (df.where(F.col(date).isNotNull()).select(F.col(date).alias("date"), *[F.col(c).cast("double").alias(c) for c in feats])
            .unpivot(["date"], feats, "feature", "value").filter(F.col("value").isNotNull() & ~F.isnan("value")))
    return long.groupBy("date", "feature").agg(F.kll_sketch_agg_double("value", k).alias("sketch"),
                                               F.count(F.lit(1)).alias("n"))


def merged(days: DataFrame, inside: Column, k: int = K) -> DataFrame:
    """feature, sketch, n of the days for which `inside` is true."""
    return days.where(inside).groupBy("feature").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"),
                                                     F.sum("n").alias("n"))


def _shares(sketch: str, edges: dict[str, list[float]]) -> Column:
    """Share of the feature's values in each bin, the outer edges at infinity; null for features without bins.

    Ranks are asked for at fixed points only, so the edges, at most bins + 1
    numbers a feature, stand in the plan. A sketch counts values up to a point
    and a bin holds those from its edge on: the points lie just under the edges.
    """
    upto = F.lit(None).cast("array<double>")
    for feature, e in edges.items():
        points = F.array(*[F.lit(math.nextafter(x, -math.inf)) for x in e[1:-1]])
        upto = F.when(F.col("feature") == feature, F.kll_sketch_get_rank_double(sketch, points)).otherwise(upto)
    upto = F.concat(F.array(F.lit(0.0)), upto, F.array(F.lit(1.0)))
    return F.transform(F.sequence(F.lit(0), F.size(upto) - 2), lambda i: F.get(upto, i + 1) - F.get(upto, i))


def sketch_drift(days: DataFrame, is_reference: Column, is_current: Column, bins: int = PSI_BINS,
                 threshold: float = PSI_THRESHOLD) -> DataFrame:
    """feature, n_ref, n_cur, edges, psi, drifted of two windows of days."""
    levels = F.array(*[F.lit(x) for x in quantile_levels(bins)])
    ref = merged(days, is_reference).select(
        "feature", F.col("sketch").alias("ref"), F.col("n").alias("n_ref"),
        F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", levels))).alias("edges"))
    cur = merged(days, is_current).select("feature", F.col("sketch").alias("cur"), F.col("n").alias("n_cur"))
    both = cut_lineage(ref.join(cur, "feature", "left"))     # a row a feature
    edges = {r["feature"]: r["edges"] for r in both.select("feature", "edges").collect() if len(r["edges"]) >= 3}
    term = F.aggregate(
        F.zip_with(F.transform(_shares("ref", edges), lambda r: r + PSI_EPSILON),
                   F.transform(_shares("cur", edges), lambda c: c + PSI_EPSILON),
                   lambda r, c: (c - r) * F.log(c / r)), F.lit(0.0), lambda a, x: a + x)
    return (both.withColumn("psi", F.coalesce(F.when(F.col("cur").isNotNull(), term), F.lit(0.0)))
            .select("feature", "n_ref", F.coalesce("n_cur", F.lit(0)).alias("n_cur"), "edges", "psi",
                    (F.col("psi") > F.lit(threshold)).alias("drifted")))
