import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from salescube.session import get_spark
    s = get_spark("salescube-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="salescube-test-ckpt-")})
    yield s
    s.stop()


def days(start: str, n: int):
    d0 = dt.date.fromisoformat(start)
    return [d0 + dt.timedelta(days=i) for i in range(n)]


def long_frame(spark, series: dict, start="2024-01-01", value_type="long"):
    """{(store, item): [sales...]} -> date, store_id, item_id, sales."""
    rows = []
    for (store, item), values in series.items():
        for d, v in zip(days(start, len(values)), values):
            rows.append((d, store, item, v))
    return spark.createDataFrame(rows, f"date date, store_id string, item_id string, sales {value_type}")
