"""Population Stability Index drift checks and retrain gates.

Layout of the computation (all features at once, no per-feature loop):

1. unpivot the numeric feature columns to long ``(feature, value)``;
2. the long rows are counted per distinct value; reference decile edges come
   from a distributed running count over those values (``exact_edges``), equal
   to numpy's linear interpolation. ``method="approx"`` takes them from the
   bounded-memory ``percentile_approx`` sketch;
3. bin = number of inner edges <= value (np.histogram with ±inf outer edges);
4. counts per (feature, bin) on both sides, a bin grid from the edges
   (≤ bins rows per feature), shares + ε, Σ (c − r)·ln(c / r).

The edges table holds ≤ bins+1 numbers per feature, so its size is bounded
by the feature count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.schemas import MIN_DRIFTED_FEATURES, PSI_BINS, PSI_EPSILON, PSI_THRESHOLD, WRMSSE_THRESHOLD


def numeric_features(df: DataFrame, candidates: list[str]) -> list[str]:
    """Candidates that exist in `df` and are numeric (strings etc. are skipped)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return [c for c in candidates
            if c in types and isinstance(types[c], (T.NumericType, T.BooleanType))]


def to_long(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) rows, NULL/NaN values dropped."""
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, value double")
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    long = wide.unpivot([], features, "feature", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantile_levels(bins: int = PSI_BINS) -> list[float]:
    """Evenly spaced levels 0..1 computed as i * (1 / bins) with the last set to 1,
    bit-identical to numpy's linspace (e.g. level 3 of 10 is 0.30000000000000004)."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def reference_edges(ref_long: DataFrame, bins: int = PSI_BINS, method: str = "exact",
                    keys=("feature",), accuracy: int = 100000) -> DataFrame:
    """*keys, edges (deduplicated sorted quantile edges), n_ref."""
    qs = F.array(*[F.lit(x) for x in quantile_levels(bins)])
    if method == "exact":
        q = F.percentile("value", qs)
    elif method == "approx":
        q = F.percentile_approx("value", qs, accuracy)
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    return ref_long.groupBy(*keys).agg(F.array_distinct(F.array_sort(q)).alias("edges"),
                                       F.count(F.lit(1)).alias("n_ref"))


def exact_edges(vc_ref: DataFrame, keys: list[str], bins: int = PSI_BINS, cut=None) -> DataFrame:
    """Exact decile edges from distinct reference values ``(*keys, value, c)``,
    computed without ever holding one group in one task: *keys, edges, n_ref.

    Order statistics via a distributed running count: the distinct values are
    range-partitioned on (keys, value) (so a hot feature spans many tasks),
    each range partition's total gives its offset (a window over a table of
    one row per partition), and a running sum inside each range partition
    gives every value's cumulative count. The 2·(bins+1) needed ranks per
    group (a bounded table, broadcast) select the rows holding them; the
    edges interpolate linearly as Spark's ``percentile`` does:
    (higher - p)·x[lower] + (p - lower)·x[higher], p = (n - 1)·q.
    """
    n = vc_ref.groupBy(*keys).agg(F.sum("c").alias("n_ref"))
    levels = quantile_levels(bins)
    pos = [F.struct(F.lit(i).alias("i"), (F.lit(q) * (F.col("n_ref") - 1)).alias("p"))
           for i, q in enumerate(levels)]
    targets = (n.select(*keys, F.explode(F.array(*pos)).alias("t"))
               .select(*keys, "t.i", "t.p",
                       F.explode(F.array(F.floor("t.p"), F.ceil("t.p"))).alias("rank"))
               .distinct())
    # The range partition is stored with its number: both branches below read the
    # same numbers whether or not Spark reuses an exchange.
    from salescube.session import cut_lineage
    ranged = (cut or cut_lineage)(
        vc_ref.repartitionByRange(*keys, "value").withColumn("pid", F.spark_partition_id()))
    part_tot = ranged.groupBy(*keys, "pid").agg(F.sum("c").alias("pc"))
    before = Window.partitionBy(*keys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_tot.select(*keys, "pid", F.coalesce(F.sum("pc").over(before), F.lit(0)).alias("off"))
    upto = Window.partitionBy(*keys, "pid").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cum = (ranged.withColumn("cum_in", F.sum("c").over(upto))
           # one row per range partition and key group: a bounded side
           .join(F.broadcast(offsets), [*keys, "pid"])
           .select(*keys, "value", "c", (F.col("off") + F.col("cum_in")).alias("cum")))
    # Rank r (0-based) is held by the value whose cumulative interval covers it.
    hit = (cum.join(F.broadcast(targets), keys)
           .filter((F.col("cum") - F.col("c") <= F.col("rank")) & (F.col("rank") < F.col("cum")))
           .select(*keys, "i", "p", "rank", "value"))
    lo, hi = F.floor("p"), F.ceil("p")
    per_level = hit.groupBy(*keys, "i", "p").agg(
        F.max(F.when(F.col("rank") == lo, F.col("value"))).alias("x_lo"),
        F.max(F.when(F.col("rank") == hi, F.col("value"))).alias("x_hi"))
    edge = F.when((lo == hi) | (F.col("x_lo") == F.col("x_hi")), F.col("x_lo")).otherwise(
        (hi - F.col("p")) * F.col("x_lo") + (F.col("p") - lo) * F.col("x_hi"))
    edges = (per_level.groupBy(*keys)
             .agg(F.array_distinct(F.array_sort(F.collect_list(edge))).alias("edges")))
    return edges.join(n, keys)


def bin_index(value: Column, edges: Column, bins: int = PSI_BINS) -> Column:
    """Index of the histogram bin holding `value` with outer edges at ±inf:
    the number of inner edges <= value.

    There are at most bins - 1 inner edges (0-based positions 1..size-2), so
    the count is unrolled into a fixed sum of comparisons, which stays inside
    whole-stage codegen (a lambda over the array would not).
    """
    n_inner = F.size(edges) - 2
    terms = [F.when((F.lit(k) <= n_inner) & (F.get(edges, k) <= value), 1).otherwise(0)
             for k in range(1, bins)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def psi_sides(long: DataFrame, bins: int = PSI_BINS, method: str = "exact",
              keys: tuple[str, ...] = ("feature",), cut=None) -> DataFrame:
    """PSI per `keys` group from one long table ``(*keys, side, value)`` where side
    is 'ref' or 'cur': *keys, psi.

    One pass for the reference edges, one pass for the bin counts of BOTH
    sides (a single grouped aggregate keyed by keys + bin). Groups absent from
    the reference side are not reported; an empty current side or fewer than
    3 distinct edges gives 0.0.
    """
    from salescube.session import cut_lineage
    cut = cut or cut_lineage
    k = list(keys)
    if method == "exact":
        # One pass over the long rows: counts per distinct (keys, side, value).
        # The shuffle is keyed by the value too, so even a feature holding a
        # third of all rows spreads over many tasks; quantiles and bins then
        # work on distinct values only (weighted by their counts).
        vc = long.groupBy(*k, "side", "value").agg(F.count(F.lit(1)).alias("c"))
        if cut is not None:
            vc = cut(vc)
        ref_vc = vc.filter(F.col("side") == "ref").select(*k, "value", "c")
        edges = exact_edges(ref_vc, k, bins, cut)
        weight = F.col("c")
        rows = vc
    else:
        edges = reference_edges(long.filter(F.col("side") == "ref"), bins, method, k)
        weight = F.lit(1)
        rows = long
    # Broadcast with a proven bound: one row per key group, <= bins+1 numbers
    # each. A shuffle join on the feature key would instead send every row of
    # a feature to a single task.
    binned = (rows.join(F.broadcast(edges.select(*k, "edges")), k)
              .select(*k, "side", weight.alias("w"),
                      bin_index(F.col("value"), F.col("edges"), bins).alias("bin")))
    counts = binned.groupBy(*k, "bin").agg(
        F.sum(F.when(F.col("side") == "ref", F.col("w")).otherwise(0)).alias("ref_c"),
        F.sum(F.when(F.col("side") == "cur", F.col("w")).otherwise(0)).alias("cur_c"))
    n_cur = counts.groupBy(*k).agg(F.sum("cur_c").alias("n_cur"))
    grid = edges.filter(F.size("edges") >= 3).select(
        *k, "n_ref", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    ref_pct = F.coalesce(F.col("ref_c"), F.lit(0)) / F.col("n_ref") + PSI_EPSILON
    cur_pct = F.coalesce(F.col("cur_c"), F.lit(0)) / F.col("n_cur") + PSI_EPSILON
    per_bin = (grid.join(n_cur.filter(F.col("n_cur") > 0), k)
               .join(counts, [*k, "bin"], "left")
               .select(*k, ((cur_pct - ref_pct) * F.log(cur_pct / ref_pct)).alias("term")))
    psi = per_bin.groupBy(*k).agg(F.sum("term").alias("psi"))
    return (edges.select(*k).join(psi, k, "left")
            .select(*k, F.coalesce("psi", F.lit(0.0)).alias("psi")))


def psi_long(ref_long: DataFrame, cur_long: DataFrame, bins: int = PSI_BINS,
             method: str = "exact") -> DataFrame:
    """PSI per feature from two long samples (feature, value)."""
    both = (ref_long.select("feature", F.lit("ref").alias("side"), "value")
            .unionByName(cur_long.select("feature", F.lit("cur").alias("side"), "value")))
    return psi_sides(both, bins, method)


def check_feature_drift(reference: DataFrame, current: DataFrame, feature_cols: list[str],
                        bins: int = PSI_BINS, threshold: float = PSI_THRESHOLD,
                        method: str = "exact") -> DataFrame:
    """feature, psi, drifted (psi > threshold) for numeric features.

    A feature whose reference sample is empty still gets a row with PSI 0.
    """
    feats = numeric_features(reference, feature_cols)
    psi = psi_long(to_long(reference, feats), to_long(current, feats), bins, method)
    return _flag(reference, feats, psi, threshold)


def check_feature_drift_split(df: DataFrame, is_reference: Column, is_current: Column,
                              feature_cols: list[str], bins: int = PSI_BINS,
                              threshold: float = PSI_THRESHOLD, method: str = "exact") -> DataFrame:
    """Same as ``check_feature_drift`` for two row subsets of ONE frame: the
    features are unpivoted once with a side tag instead of once per side."""
    feats = numeric_features(df, feature_cols)
    side = F.when(is_reference, F.lit("ref")).when(is_current, F.lit("cur"))
    tagged = df.select(side.alias("side"), *[F.col(c).cast("double").alias(c) for c in feats]) \
        .filter(F.col("side").isNotNull())
    long = (tagged.unpivot(["side"], feats, "feature", "value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))
    return _flag(df, feats, psi_sides(long, bins, method), threshold)


def check_feature_drift_batches(df: DataFrame, batches: dict, feature_cols: list[str],
                                bins: int = PSI_BINS, threshold: float = PSI_THRESHOLD,
                                method: str = "exact") -> DataFrame:
    """Several drift checks over row subsets of ONE frame in a single pass:
    ``batches = {name: (is_reference, is_current)}`` -> batch, feature, psi, drifted.

    Each row is tagged with the (batch, side) pairs it belongs to (at most one
    per batch, so the explode is bounded by the batch count), unpivoted once,
    and the PSI groups by (batch, feature).
    """
    feats = numeric_features(df, feature_cols)
    tags = [F.when(r, F.struct(F.lit(b).alias("batch"), F.lit("ref").alias("side")))
            .when(c, F.struct(F.lit(b).alias("batch"), F.lit("cur").alias("side")))
            for b, (r, c) in batches.items()]
    tagged = (df.select(F.explode(F.array(*tags)).alias("t"),
                        *[F.col(c).cast("double").alias(c) for c in feats])
              .filter(F.col("t").isNotNull())
              .select("t.batch", "t.side", *feats))
    long = (tagged.unpivot(["batch", "side"], feats, "feature", "value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))
    psi = psi_sides(long, bins, method, keys=("batch", "feature"))
    names = df.sparkSession.createDataFrame([(b, f) for b in batches for f in feats],
                                            "batch string, feature string")
    out = names.join(psi, ["batch", "feature"], "left").select(
        "batch", "feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))
    return out.withColumn("drifted", F.col("psi") > F.lit(threshold))


def _flag(df: DataFrame, feats: list[str], psi: DataFrame, threshold: float) -> DataFrame:
    names = df.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    out = names.join(psi, "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))
    return out.withColumn("drifted", F.col("psi") > F.lit(threshold))


def latest_batch(monitoring: DataFrame, ts: str = "checked_at") -> DataFrame:
    """Rows of the latest check: checked_at = (select max(checked_at))."""
    return monitoring.filter(F.col(ts) == monitoring.agg(F.max(ts)).scalar())


def latest_run(runs: DataFrame, ts: str = "trained_at") -> DataFrame:
    """ORDER BY trained_at DESC LIMIT 1 (S3): a top-1, planned as TakeOrderedAndProject."""
    return runs.orderBy(F.col(ts).desc()).limit(1)


def retrain_decision(drift_batch: DataFrame, runs: DataFrame,
                     min_drifted_features: int = MIN_DRIFTED_FEATURES,
                     wrmsse_threshold: float = WRMSSE_THRESHOLD, force: bool = False) -> DataFrame:
    """One row: n_drifted, drift_trigger, latest_wrmsse, metric_trigger, retrain.

    Empty drift input -> no drift trigger; no run -> no metric trigger;
    `force` bypasses both. The latest wrmsse is a scalar subquery over the
    runs table, not a join.
    """
    latest_wrmsse = runs.orderBy(F.col("trained_at").desc()).limit(1).select("wrmsse").scalar()
    has_col = "drifted" in drift_batch.columns
    n_drifted = F.count_if(F.col("drifted")) if has_col else F.lit(0)
    agg = drift_batch.agg(F.coalesce(n_drifted, F.lit(0)).cast("long").alias("n_drifted"))
    drift_trig = F.col("n_drifted") >= F.lit(min_drifted_features)
    metric_trig = F.coalesce(F.col("latest_wrmsse") > F.lit(wrmsse_threshold), F.lit(False))
    return (agg.withColumn("latest_wrmsse", latest_wrmsse)
            .select("n_drifted", drift_trig.alias("drift_trigger"), "latest_wrmsse",
                    metric_trig.alias("metric_trigger"),
                    (F.lit(bool(force)) | drift_trig | metric_trig).alias("retrain")))
