"""Driver contract and end-to-end runs on the smallest scale factor."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@needs_data
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"date", "n_predictions", "mae", "mape", "rmse"}


@needs_data
@pytest.mark.parametrize("name", ["fct_sales", "feature_full", "psi_drift", "feed_stream",
                                  "replace_predictions", "append_evolve", "append_feed", "append_runs",
                                  "retrain_decision"])
def test_queries_run_on_smallest_scale(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


@needs_data
def test_oracle_parity_small(spark):
    """Spark vs DuckDB on a handful of queries at sf0.001."""
    import duckdb

    from check_oracle import digest
    from salescube.sources.tables import DRIVER_TABLES, table_path
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    for name in ["fct_sales", "feature_rolling", "seasonal_naive_forecast", "evaluate_predictions",
                 "accuracy_daily", "psi_drift"]:
        s = E.queries()[name](spark, SF).toPandas()
        o = con.execute(E.oracle_sql()[name]).df()
        assert digest(s) == digest(o), name


@needs_data
def test_no_cartesian_or_nested_loop_plans(spark):
    for name in ["fct_sales", "feature_full", "evaluate_predictions", "psi_drift", "missing_days"]:
        df = E.queries()[name](spark, SF)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


@needs_data
def test_trailing_reads_prune_month_folders(spark):
    for name in ["active_series", "prediction_accuracy", "fct_sales_predictions"]:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*month_start", plan), name


@needs_data
def test_workers_find_the_package_from_any_folder(spark):
    """The queries add this repository to the workers' path."""
    seen = []
    E.reachable(lambda s, d: seen.append(s.sparkContext.environment["PYTHONPATH"]))(spark, SF)
    assert E.HERE in seen[0].split(os.pathsep)
