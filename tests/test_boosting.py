"""The booster against a plain numpy version that splits one leaf at a time."""

import numpy as np
from pyspark.sql import functions as F

from salescube.operators import boosting as B


def plain_tree(bins, g, w, numeric, s):
    """Best-first growth by direct sums over the rows of each leaf, no passes, no subtraction."""
    def total(rows):
        return g[rows].sum() ** 2 / (w[rows].sum() + s.l2)

    def best(rows):
        found = None
        for f in range(bins.shape[1]):
            values = np.unique(bins[rows, f])
            if f < numeric:
                seen = [v for v in values if v > 0]
                orders = [[0, *seen], [*seen, 0]] if 0 in values else [seen]
            else:
                mean = {v: g[rows][bins[rows, f] == v].sum() / (w[rows][bins[rows, f] == v].sum() + s.l2) for v in values}
                orders = [sorted(values, key=lambda v: (mean[v], v))]
            for again, order in enumerate(orders):
                for k in range(1, len(order) - again):
                    goes = np.isin(bins[rows, f], order[:k])
                    left, right = rows[goes], rows[~goes]
                    if min(len(left), len(right)) < s.least_rows:
                        continue
                    gain = total(left) + total(right) - total(rows)
                    if gain > 1e-12 * max(1.0, total(rows)) and (found is None or gain > found[0] * (1 + 1e-9)):
                        found = (gain, f, sorted(int(v) for v in order[:k]))
        return found

    leaves, splits = [np.arange(len(bins))], []
    while len(leaves) < s.leaves:
        options = [(b[0], i, b) for i, rows in enumerate(leaves) if (b := best(rows))]
        if not options:
            break
        _, i, (_, f, left) = max(options, key=lambda o: o[0])
        rows = leaves.pop(i)
        goes = np.isin(bins[rows, f], left)
        leaves += [rows[goes], rows[~goes]]
        splits.append((f, left))
    value = np.zeros(len(bins))
    for rows in leaves:
        value[rows] = -s.rate * g[rows].sum() / (w[rows].sum() + s.l2)
    return splits, value


def sample(n=1200, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 2))
    shop = rng.integers(0, 9, n)
    y = 4.0 * (x[:, 0] > 0.37) + 2.0 * (x[:, 1] > 0.61) * (x[:, 0] > 0.37) + np.where(np.isin(shop, (2, 5, 7)), 3.0, 0.0)
    y += 0.05 * rng.standard_normal(n)
    missing = rng.random(n) < 0.2
    y[missing] += 1.5
    return [(None if m else float(a), float(b), f"s{c}", float(t), float(k % 3 + 1))
            for k, (a, b, c, t, m) in enumerate(zip(x[:, 0], x[:, 1], shop, y, missing))]


SCHEMA = "a double, b double, shop string, sales double, weight double"


def test_trees_equal_the_plain_version(spark):
    weight = "weight"
    s = B.Settings(rounds=2, patience=50, rate=0.3, leaves=9)
    df = spark.createDataFrame(sample(), SCHEMA).repartition(5)
    model = B.fit(df, df.where("false"), ["a", "b"], ["shop"], weight=weight, settings=s)
    rows = df.toArrow().combine_chunks().to_batches()[0]
    bins = model.binning.bins(rows)
    y = rows.column("sales").to_numpy()
    w = rows.column("weight").to_numpy()
    margin = np.full(len(y), (y * w).sum() / w.sum())
    assert abs(model.base - margin[0]) < 1e-9 and len(model.trees) == 2
    for tree in model.trees:
        splits, value = plain_tree(bins.astype(int), (margin - y) * w, w, 2, s)
        inner = [(f, left) for f, left in zip(tree.feature, tree.left_bins) if f >= 0]
        assert sorted(map(str, inner)) == sorted(map(str, splits))
        assert np.allclose(tree.margins(bins), value, atol=1e-9)
        margin += value


def test_missing_values_and_categories_need_no_fill(spark):
    """A planted effect of three of 300 stores, and one of a missing price, are found."""
    rows = spark.range(300 * 40).selectExpr(
        "concat('S', id % 300) AS store_id", "IF(id % 7 = 0, NULL, CAST(id % 5 AS double)) AS sell_price",
        "CAST(2 + IF(id % 300 IN (17, 101, 222), 6, 0) + IF(id % 7 = 0, 3, 0) AS double) AS sales")
    s = B.Settings(rounds=12, rate=0.5, leaves=8)
    model = B.fit(rows, rows, ["sell_price"], ["store_id"], settings=s)
    got = B.predict(rows, model).withColumn("e", F.abs(F.col("prediction") - F.col("sales")))
    assert got.agg(F.max("e")).first()[0] < 0.5   # the effects are 6 and 3
    new = spark.createDataFrame([("elsewhere", None), (None, 1.0)], "store_id string, sell_price double")
    assert B.predict(new, model).count() == 2


def test_patience_ends_the_rounds_and_each_is_fitted_once(spark, monkeypatch):
    calls = []
    grow = B.grow
    monkeypatch.setattr(B, "grow", lambda *a: calls.append(1) or grow(*a))
    monkeypatch.setattr(B, "STORE_EVERY", 3)
    df = spark.createDataFrame(sample(800), SCHEMA)
    noise = df.withColumn("sales", F.col("sales") + 8 * F.sin(F.col("b") * 9000))
    model = B.fit(noise, df, ["a", "b"], ["shop"], settings=B.Settings(rounds=40, patience=3, rate=0.5, leaves=6))
    assert len(calls) == len(model.curve) < 40
    best = int(np.argmin(model.curve))
    assert len(model.trees) == best + 1 and len(model.curve) == best + 4
    # The stored margins and the trees since give the model's own error.
    error = B.predict(df, model).agg(F.avg(F.pow(F.col("prediction") - F.col("sales"), 2))).first()[0]
    assert abs(error - model.curve[best]) < 1e-9


def test_saved_text_gives_the_same_predictions(spark):
    df = spark.createDataFrame(sample(500), SCHEMA).withColumn("prediction", F.lit("x"))
    model = B.fit(df, df, ["a", "b"], ["shop"], settings=B.Settings(rounds=4, rate=0.3))
    again = B.Booster.loads(model.dumps())
    a, b = (sorted(map(tuple, B.predict(df, m).collect()), key=str) for m in (model, again))
    assert a == b and df.columns[:-1] + ["prediction"] == B.predict(df, model).columns


def test_constant_label_and_no_rows(spark):
    df = spark.createDataFrame(sample(100), SCHEMA).withColumn("sales", F.lit(2.0))
    model = B.fit(df, df, ["a"], [], settings=B.Settings(rounds=9))
    assert {r.prediction for r in B.predict(df, model).collect()} == {2.0}
    none = B.fit(df.where("false"), df.where("false"), ["a", "b"], ["shop"], settings=B.Settings(rounds=3))
    assert {r.prediction for r in B.predict(df, none).collect()} == {0.0}
