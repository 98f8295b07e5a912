"""Features and baselines of sparse series equal those of the dense panel's rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salescube.operators import baselines, features, sparse
from salescube.operators import model as mdl

DAY = dt.date(2024, 1, 1)


def gappy(seed=1, span=140):
    """Series that sell on few days, with gaps of every length up to months, one of a single sale."""
    rng = random.Random(seed)
    rows = []
    for k, chance in enumerate((0.9, 0.4, 0.1, 0.03)):
        for day in range(span):
            if rng.random() < chance or (k == 3 and day in (5, 120)):
                rows.append((DAY + dt.timedelta(days=day), f"S{k % 2}", f"I{k}", rng.randint(1, 9)))
    return rows + [(DAY + dt.timedelta(days=60), "S9", "I9", 4), (DAY + dt.timedelta(days=span - 1), "S0", "I0", 3)]


@pytest.fixture(scope="module")
def sold(spark):
    seen = {r[:3]: r for r in gappy()}
    return spark.createDataFrame(list(seen.values()), "date date, store_id string, item_id string, sales long")


def dense(sold, own_start):
    """A row for each day from the first one, of the series or of all, to the last of all."""
    last = sold.agg(F.max("date")).scalar()
    first = F.min("date") if own_start else F.lit(sold.agg(F.min("date")).first()[0])
    days = sold.groupBy("store_id", "item_id").agg(first.alias("first"))
    days = days.select("store_id", "item_id", F.explode(F.sequence("first", last)).alias("date"))
    return days.join(sold, ["date", "store_id", "item_id"], "left").withColumn("sales", F.coalesce("sales", F.lit(0)))


def rounded(df, cols):
    key = ["date", "store_id", "item_id"]
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*key, *cols).collect())


@pytest.mark.parametrize("own_start", [True, False])
def test_features_equal_the_panels(sold, own_start):
    start = None if own_start else sold.agg(F.min("date")).scalar()
    want = features.build_features(dense(sold, own_start)).where("sales > 0")
    got = sparse.build_features(sold, start=start)
    cols = [c for c in want.columns if c not in ("date", "store_id", "item_id")]
    assert set(cols) <= set(got.columns)
    assert rounded(got, cols) == rounded(want, cols)


def test_next_day_row_of_sparse_series(sold):
    last = sold.agg(F.max("date")).first()[0]
    aug = features.next_day_stub(sold)
    panel = features.next_day_stub(dense(sold, True))
    tomorrow = F.col("date") == F.lit(last + dt.timedelta(days=1))
    cols = [c for c in features.feature_columns(features.build_features(panel))[0] if c not in ("store_id", "item_id")]
    assert rounded(sparse.build_features(aug).where(tomorrow), cols) == rounded(
        features.build_features(panel).where(tomorrow), cols)


def test_forecasts_equal_the_panels_baselines(sold):
    last = sold.agg(F.max("date")).scalar()
    panel = dense(sold, True)
    got = {(r.date, r.store_id, r.item_id): r for r in sparse.forecasts(sold, last, 10).collect()}
    active = {(r.store_id, r.item_id) for r in sold.where(F.datediff(last, "date") < 56).collect()}
    assert {(s, i) for _, s, i in got} == active and len(got) == 10 * len(active)
    for name, want in (("naive", baselines.naive_forecast(panel, 10)),
                       ("seasonal", baselines.seasonal_naive_forecast(panel, 10))):
        values = {(r.date, r.store_id, r.item_id): r.sales for r in want.collect()}
        assert all(getattr(r, name) == values[k] for k, r in got.items()), name
    means = {(r.store_id, r.item_id): r.baseline for r in baselines.same_phase_mean(panel, phase="target").collect()}
    first = min(d for d, *_ in got)
    assert all(abs(r.phase_mean - means[k[1:]]) < 1e-9 for k, r in got.items() if k[0] == first)


def test_phase_mean_counts_the_weeks_since_the_start(spark):
    rows = [(DAY, "S", "I", 8), (DAY + dt.timedelta(days=7), "S", "I", 2)]
    sold = spark.createDataFrame(rows, "date date, store_id string, item_id string, sales long")
    as_of = F.lit(DAY + dt.timedelta(days=13))
    got = {(r.date - DAY).days: r.phase_mean for r in sparse.forecasts(sold, as_of, 7).collect()}
    assert got[14] == 5.0 and got[15] == 0.0 and got[20] == 0.0


def test_one_exchange_and_one_sort(sold):
    plan = sparse.build_features(sold)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_null_ids_and_empty_tables(spark, sold):
    odd = sold.unionByName(sold.limit(1).withColumn("store_id", F.lit(None).cast("string")))
    assert sparse.build_features(odd).count() == sold.count()
    nothing = sold.where("false")
    assert sparse.build_features(nothing).count() == 0
    assert sparse.forecasts(nothing, F.lit(DAY), 3).count() == 0


def test_next_day_takes_its_event_and_price(spark):
    hist = spark.createDataFrame(
        [(DAY + dt.timedelta(days=k), s, "I", 1, 2.5 if k < 20 else None, None, 0) for k in range(30) for s in ("S", "T")],
        "date date, store_id string, item_id string, sales long, sell_price double, event_type_1 string, snap_flag long")
    calendar = spark.createDataFrame([(DAY + dt.timedelta(days=30), "National", 1, 0, 0)],
                                     "date date, event_type_1 string, snap_ca long, snap_tx long, snap_wi long")
    stores = spark.createDataFrame([("S", "CA"), ("T", "TX")], "store_id string, state_id string")
    got = {r.store_id: r for r in mdl.next_day_features(hist, calendar, stores).collect()}
    assert len(got) == 2 and all((r.event_type_1, r.has_event, r.sell_price) == ("National", 1, 2.5) for r in got.values())
    assert (got["S"].snap_flag, got["T"].snap_flag) == (1, 0)
    bare = mdl.next_day_features(hist, calendar, stores, reference_stub=True).collect()
    assert all((r.event_type_1, r.has_event, r.sell_price, r.snap_flag) == ("none", 0, None, 0) for r in bare)
    past = mdl.next_day_features(hist, calendar.where("false"), stores).collect()
    assert all((r.event_type_1, r.has_event, r.snap_flag) == ("none", 0, 0) for r in past) and len(past) == 2


def line_tables(spark, path, n=400):
    """A small set of the line tables: repeated parts, a supplier without a nation, a nation without a name."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    rng = random.Random(3)
    put("region", [(0, "AFRICA"), (1, "ASIA")], "r_regionkey long, r_name string")
    put("nation", [(0, "KENYA", 0), (1, "JAPAN", 1), (2, None, 1)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(k, k % 4) for k in range(8)], "s_suppkey long, s_nationkey long")
    put("part", [(k, f"Brand#{k}") for k in [*range(20), 3]], "p_partkey long, p_brand string")
    put("lineitem", [(rng.choice([*range(20), None]), rng.randrange(8), float(rng.randint(1, 9)), rng.randint(10, 99) / 2,
                      dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(60))) for _ in range(n)],
        "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp")
    return str(path)


def test_part_fact_lies_by_series_after_one_shuffle(spark, tmp_path):
    from salescube.plans.catalog_sparse import PARTS, part_layers
    from salescube.plans.layers import Layers
    path = line_tables(spark, tmp_path)
    stored, plain = part_layers(spark, path), Layers(spark, path, stored=False, **PARTS)
    lines = stored.raw.by_series(stored.raw.line_facts).groupBy("date", "store_id", "item_id").count()
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(lines) == 1
    assert stored.raw.buckets and shuffles(stored.build_fct_sales()) == 0
    assert shuffles(sparse.build_features(stored.fct_sales)) == 0
    cols = stored.build_fct_sales().columns
    want = plain.build_fct_sales().select(cols)
    for got in (stored.build_fct_sales(), stored.fct_sales.select(cols)):
        assert got.count() == want.count() > 100
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
