import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescube.operators import drift, sketches


def psi_of(spark, ref, cur):
    r = spark.createDataFrame([(float(x),) for x in ref], "x double")
    c = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return drift.check_feature_drift(r, c, ["x"]).first()["psi"]


def test_psi_same_and_shifted(spark):
    rng = np.random.default_rng(0)
    ref, same, shifted = rng.normal(10, 2, 1000), rng.normal(10, 2, 1000), rng.normal(25, 2, 1000)
    assert psi_of(spark, ref, same) < 0.05
    assert psi_of(spark, ref, shifted) > 0.2


def test_psi_of_hand_counted_bins(spark):
    """1..100 gives ten bins of ten; the current sample has 20 in the first bin and 5 in each of four others."""
    ref = list(range(1, 101))
    cur = [1] * 20 + [15] * 5 + [35] * 5 + [55] * 5 + [75] * 5
    eps = 1e-6
    shares = [0.5] + [0.125] * 4 + [0.0] * 5
    want = sum((c + eps - (0.1 + eps)) * np.log((c + eps) / (0.1 + eps)) for c in shares)
    assert psi_of(spark, ref, cur) == pytest.approx(want, rel=1e-9)


def test_psi_empty_and_constant(spark):
    assert psi_of(spark, [], [1.0, 2.0]) == 0.0
    assert psi_of(spark, [1.0, 2.0, 3.0], []) == 0.0
    assert psi_of(spark, [5.0] * 50, [5.0, 6.0]) == 0.0


def test_drift_frame_flags_only_shifted_and_skips_strings(spark):
    rng = np.random.default_rng(2)
    rows_r = [(float(a), float(b), "S") for a, b in zip(rng.normal(10, 2, 1000), rng.normal(10, 2, 1000))]
    rows_c = [(float(a), float(b), "S") for a, b in zip(rng.normal(10, 2, 1000), rng.normal(25, 2, 1000))]
    schema = "stable double, shifted double, store_id string"
    out = drift.check_feature_drift(spark.createDataFrame(rows_r, schema), spark.createDataFrame(rows_c, schema),
                                    ["stable", "shifted", "store_id", "absent"])
    res = {r["feature"]: r["drifted"] for r in out.collect()}
    assert res == {"stable": False, "shifted": True}


def test_quantile_levels_match_numpy():
    assert drift.quantile_levels(10) == list(np.linspace(0, 1, 11))


def runs(spark, wrmsse):
    rows = [(dt.datetime(2024, 1, 1), 0.5), (dt.datetime(2024, 2, 1), wrmsse)] if wrmsse is not None else []
    return spark.createDataFrame(rows, "trained_at timestamp, wrmsse double")


def flags(spark, values):
    return spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(values)], "feature string, drifted boolean")


def test_retrain_truth_table(spark):
    d = drift.retrain_decision(flags(spark, [True, False, False]), runs(spark, 0.5)).first()
    assert d["drift_trigger"] and d["retrain"] and not d["metric_trigger"]
    d = drift.retrain_decision(flags(spark, [False, False]), runs(spark, 1.5)).first()
    assert d["metric_trigger"] and d["retrain"] and d["latest_wrmsse"] == 1.5
    d = drift.retrain_decision(flags(spark, []), runs(spark, None)).first()
    assert not d["retrain"] and d["n_drifted"] == 0 and d["latest_wrmsse"] is None
    d = drift.retrain_decision(flags(spark, []), runs(spark, None), force=True).first()
    assert d["retrain"]


def test_latest_batch_and_run(spark):
    mon = spark.createDataFrame([("a", 0.1, False, dt.datetime(2024, 1, 1)),
                                 ("a", 0.3, True, dt.datetime(2024, 1, 2)),
                                 ("b", 0.0, False, dt.datetime(2024, 1, 2))],
                                "feature string, psi double, drifted boolean, checked_at timestamp")
    assert drift.latest_batch(mon).count() == 2
    assert drift.latest_run(runs(spark, 0.7)).first()["wrmsse"] == 0.7


def test_batched_drift_equals_single(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.poisson(3, 900), rng.normal(0, 1, 900)))]
    df = spark.createDataFrame(rows, "t long, a double, b double")
    t = F.col("t")
    batched = drift.check_feature_drift_batches(
        df, {"early": (t < 300, (t >= 300) & (t < 600)), "late": (t < 600, t >= 600)}, ["a", "b"])
    got = {(r["batch"], r["feature"]): r["psi"] for r in batched.collect()}
    for name, (r, c) in {"early": (t < 300, (t >= 300) & (t < 600)), "late": (t < 600, t >= 600)}.items():
        single = drift.check_feature_drift(df.filter(r), df.filter(c), ["a", "b"]).collect()
        for row in single:
            assert got[(name, row["feature"])] == pytest.approx(row["psi"], rel=1e-12, abs=1e-15)


def test_psi_approx_close_to_exact(spark):
    rng = np.random.default_rng(4)
    r = spark.createDataFrame([(float(x),) for x in rng.normal(10, 2, 2000)], "x double")
    c = spark.createDataFrame([(float(x),) for x in rng.normal(11, 2, 2000)], "x double")
    exact = drift.check_feature_drift(r, c, ["x"]).first()["psi"]
    approx = drift.check_feature_drift(r, c, ["x"], method="approx").first()["psi"]
    assert approx == pytest.approx(exact, rel=0.1)
    with pytest.raises(ValueError):
        drift.reference_edges(r.selectExpr("'x' AS feature", "x AS value"), method="nope")


def test_distributed_exact_edges_equal_percentile(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.poisson(2, 3000), rng.normal(5, 3, 2000).round(2), np.full(500, 7.0)])
    rows = [("f" if i % 2 else "g", float(v)) for i, v in enumerate(vals)]
    long = spark.createDataFrame(rows, "feature string, value double").repartition(7)
    vc = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    got = {r["feature"]: (r["edges"], r["n_ref"]) for r in drift.exact_edges(vc, ["feature"]).collect()}
    want = {r["feature"]: (r["edges"], r["n_ref"]) for r in drift.reference_edges(long).collect()}
    assert got.keys() == want.keys()
    for f in got:
        assert got[f][1] == want[f][1]
        assert got[f][0] == pytest.approx(want[f][0], rel=0, abs=1e-12)
        ref = np.array([v for k, v in rows if k == f])
        edges_np = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
        assert got[f][0] == pytest.approx(list(edges_np), rel=1e-12, abs=1e-12)


def test_exact_edges_without_exchange_reuse(spark):
    """The edges don't depend on both branches sharing one exchange."""
    values = spark.range(200_000).selectExpr("'f' AS feature", "cast(pmod(id * 7919, 200000) as double) AS value", "1L AS c")
    want = [19999.9 * k for k in range(11)]
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            assert drift.exact_edges(values, ["feature"]).first()["edges"] == pytest.approx(want, rel=1e-12)
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")


def test_day_sketches_stay_within_their_rank_error(spark):
    rows = spark.range(40000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"),
        (F.rand(3) * F.when(F.col("id") % 40 < 20, 1.0).otherwise(1.5)).alias("x"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("zeros"),
        F.lit(7.0).alias("same"), F.lit(None).cast("double").alias("none"))
    first = F.col("date") < "2024-01-21"
    out = {r["feature"]: r for r in sketches.sketch_drift(
        sketches.day_sketches(rows, ["x", "zeros", "same", "none"]), first, ~first).collect()}
    exact = {r["feature"]: r["psi"] for r in drift.check_feature_drift_split(
        rows, first, ~first, ["x", "zeros", "same"]).collect()}
    assert set(out) == {"x", "zeros", "same"}
    assert out["x"]["n_ref"] == out["x"]["n_cur"] == 20000
    ref = sorted(r["x"] for r in rows.where(first).select("x").collect())
    for level, edge in zip(drift.quantile_levels(), out["x"]["edges"]):
        assert abs(sum(v <= edge for v in ref) / len(ref) - level) <= 2 * sketches.RANK_ERROR
    for name in exact:
        assert out[name]["psi"] == pytest.approx(exact[name], abs=0.05), name
    assert out["same"]["psi"] == 0.0 and out["x"]["drifted"]
    assert sketches.sketch_drift(sketches.day_sketches(rows.limit(0), ["x"]), first, ~first).count() == 0
    assert [r["psi"] for r in sketches.sketch_drift(sketches.day_sketches(rows.where(first), ["x"]), first, ~first).collect()] == [0.0]
