"""Boosted-tree model: training, batch scoring, backtest, publish gate (M1-M9).

MLlib replaces the per-process booster. The event type, a small vocabulary, goes
through ``StringIndexer(handleInvalid="keep")`` fitted on train only, so unseen
categories at scoring time map to the extra index. The store and item keys,
whose vocabularies grow with the data, are target-encoded with a
*join*: smoothed per-key means of the training target are a table computed by
a distributed ``groupBy``, stored next to the pipeline and joined onto
validation and scoring rows (unseen items get the prior). A training row takes
the mean of the days outside its own fold, so its target is not in its feature. No vocabulary of the
growing key is ever held on the driver, which an indexer or MLlib's
TargetEncoder model would do.

Null prices take the series' last known one, in training as in scoring, so that a
price says nothing about the day's sales. Training drops rows with a null feature
(as the application does); scoring keeps them (``handleInvalid="keep"`` on the assembler). Early stopping is the
patience rule on ``evaluateEachIteration``, applied by a refit at the best count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescube.operators import baselines, boosting, features, metrics
from salescube.schemas import GRAIN, ID_COLUMNS, VALID_DAYS, WRMSSE_THRESHOLD

PATIENCE = 20
# Categoricals whose cardinality grows with the data.
TARGET_ENCODED = ["store_id", "item_id"]
MAX_ROUNDS = 500
LEARNING_RATE = 0.05
FIRST_ROUNDS = 40
ENCODING_SMOOTHING = 10.0   # pseudo-count pulling rare items toward the prior
ENCODING_FOLDS = 5          # training days are dealt to so many folds by a hash of the date


@dataclass
class Model:
    pipeline: PipelineModel
    encodings: dict[str, DataFrame] = field(default_factory=dict)  # col -> (col, enc) + prior row


@dataclass
class TrainResult:
    model: Model
    features: list[str]
    best_iteration: int
    scored_valid: DataFrame
    train: DataFrame
    valid: DataFrame


def fit_encoding(train: DataFrame, col: str, label: str = "sales",
                 smoothing: float = ENCODING_SMOOTHING) -> DataFrame:
    """(col, enc): (n·mean + m·prior) / (n + m) per category, plus one row with
    col = NULL holding the prior (the global training mean)."""
    y = F.col(label).cast("double")
    prior = train.agg(F.avg(y)).scalar()
    per = train.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("m"))
    enc = per.select(col, ((F.col("n") * F.col("m") + F.lit(smoothing) * prior)
                           / (F.col("n") + F.lit(smoothing))).alias("enc"))
    prior_row = train.agg(F.avg(y).alias("enc")).select(F.lit(None).cast("string").alias(col), "enc")
    return enc.filter(F.col(col).isNotNull()).unionByName(prior_row)


def out_of_fold(train: DataFrame, cols: list[str], label: str = "sales",
                smoothing: float = ENCODING_SMOOTHING) -> DataFrame:
    """The training rows with ``<col>_enc`` from the rows of the other folds only.

    Null keys, and keys that no other fold has, take the global mean.
    """
    y = F.col(label).cast("double")
    prior = train.agg(F.avg(y)).scalar()
    out = train.withColumn("_fold", F.pmod(F.xxhash64("date"), F.lit(ENCODING_FOLDS)))
    for col in cols:
        parts = out.groupBy(col, "_fold").agg(F.count(y).alias("n"), F.sum(y).alias("s"))
        key = Window.partitionBy(col)   # at most ENCODING_FOLDS rows
        n, s = F.sum("n").over(key) - F.col("n"), F.sum("s").over(key) - F.col("s")
        enc = parts.select(col, "_fold", ((s + F.lit(smoothing) * prior) / (n + F.lit(smoothing))).alias(f"{col}_enc"))
        out = (out.join(enc.filter(F.col(col).isNotNull()), [col, "_fold"], "left")
               .withColumn(f"{col}_enc", F.coalesce(F.col(f"{col}_enc"), prior)))
    return out.drop("_fold")


def apply_encodings(df: DataFrame, encodings: dict[str, DataFrame]) -> DataFrame:
    """Join each encoding table on its key; unseen keys take the prior."""
    for col, enc in encodings.items():
        prior = enc.filter(F.col(col).isNull()).select("enc").scalar()
        table = enc.filter(F.col(col).isNotNull()).withColumnRenamed("enc", f"{col}_enc")
        df = (df.join(table, col, "left")
              .withColumn(f"{col}_enc", F.coalesce(F.col(f"{col}_enc"), prior)))
    return df


def _stages(numeric: list[str], categorical: list[str], encoded: list[str],
            weight_col: str | None, seed: int, learning_rate: float):
    nominal = [c for c in categorical if c not in encoded]
    # One indexer over all small-vocabulary columns: a single pass to fit.
    idx = (StringIndexer(inputCols=nominal, outputCols=[f"{c}_idx" for c in nominal],
                         handleInvalid="keep") if nominal else None)
    inputs = numeric + [f"{c}_enc" for c in encoded] + [f"{c}_idx" for c in nominal]
    asm = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol="sales", predictionCol="prediction",
                       stepSize=learning_rate, maxDepth=6, minInstancesPerNode=20, maxBins=256,
                       seed=seed, lossType="squared")
    if weight_col:
        gbt.setWeightCol(weight_col)
    return idx, asm, gbt


def best_iteration(curve: list[float], patience: int = PATIENCE) -> int:
    """1-based tree count where validation error bottoms out, stopping after
    `patience` rounds without improvement."""
    best, best_i = float("inf"), 0
    for i, v in enumerate(curve):
        if v < best:
            best, best_i = v, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def boost(gbt: GBTRegressor, train: DataFrame, valid: DataFrame, max_iter: int = MAX_ROUNDS,
          patience: int = PATIENCE) -> tuple[GBTRegressionModel, int]:
    """Boosting with patience: the model of the round where the validation error is least.

    MLlib's own early stop ends at the first round that isn't better, so rounds
    are fitted in full. The count doubles until ``patience`` rounds pass without
    improvement or ``max_iter`` is reached; the best count is then fitted again,
    which with the same seed gives the same first trees.
    """
    rounds = min(FIRST_ROUNDS, max_iter)
    while True:
        model = gbt.setMaxIter(rounds).fit(train)
        best = best_iteration(model.evaluateEachIteration(valid, "squared"), patience)
        if best + patience <= rounds or rounds == max_iter:
            break
        rounds = min(2 * rounds, max_iter)
    return (model if best == rounds else gbt.setMaxIter(best).fit(train)), best


def train(history: DataFrame, valid_days: int = VALID_DAYS, weight_dampening: str | None = None,
          max_iter: int = MAX_ROUNDS, seed: int = 7, keep=None,
          learning_rate: float = LEARNING_RATE) -> TrainResult:
    """Carried prices -> W5 -> P18 -> W12 -> P13 -> M1 -> W11 -> M2 (M3).

    `keep(name, build)` stores intermediate tables (e.g. ``Layers._keep``): the
    featured train / valid sets and the encodings, so the fits, the boosting
    passes and the evaluation read Parquet instead of re-running windows.
    """
    keep = keep or (lambda name, build: build())
    featured = features.build_features(carry_price(history))
    feats, categorical = features.feature_columns(featured)
    numeric = [c for c in feats if c not in categorical]
    encoded = [c for c in categorical if c in TARGET_ENCODED]
    tr, va = baselines.time_split(featured, valid_days)
    tr = keep("train_set", lambda: tr.dropna(subset=feats))
    va = keep("valid_set", lambda: va.dropna(subset=feats))
    encodings = {c: keep(f"encoding_{c}", lambda c=c: fit_encoding(tr, c)) for c in encoded}
    tr_e, va_e = out_of_fold(tr, encoded), apply_encodings(va, encodings)
    weight_col = None
    if weight_dampening is not None:
        total = F.sum(F.col("sales").cast("double")).over(Window.partitionBy(*ID_COLUMNS))
        tr_e = tr_e.withColumn("weight", metrics.dampen(total, weight_dampening))
        va_e = va_e.withColumn("weight", F.lit(1.0))   # validation metric stays unweighted
        weight_col = "weight"
    tr_e = tr_e.withColumn("sales", F.col("sales").cast("double"))
    va_e = va_e.withColumn("sales", F.col("sales").cast("double"))
    idx, asm, gbt = _stages(numeric, categorical, encoded, weight_col, seed, learning_rate)
    # M1: categories are fixed on the training rows only.
    idx_model = idx.fit(tr_e) if idx is not None else None
    prep = PipelineModel(stages=[s for s in (idx_model, asm) if s is not None])
    fit_rows = keep("fit_rows", lambda: prep.transform(tr_e).select(
        "features", "sales", *([weight_col] if weight_col else [])))
    valid_rows = keep("valid_rows", lambda: prep.transform(va_e).select("features", "sales"))
    gbt_model, best = boost(gbt, fit_rows, valid_rows, max_iter)
    model = Model(PipelineModel(stages=[*prep.stages, gbt_model]), encodings)
    scored = score(model, va)
    return TrainResult(model, feats, best, scored, tr, va)


def score(model: Model, featured: DataFrame) -> DataFrame:
    """Predict, clip at 0, round half-to-even (P14): date, store_id, item_id, predicted_sales."""
    out = model.pipeline.transform(apply_encodings(featured, model.encodings))
    return out.select(*GRAIN, baselines.clip_round(F.col("prediction")).alias("predicted_sales"))


def training_metrics(res: TrainResult | LeafwiseResult) -> DataFrame:
    """One row: wrmsse, mape, rmse, n, n_series, best_iteration, n_train_rows, n_valid_rows."""
    actual = res.valid.select(*GRAIN, "sales")
    fc = res.scored_valid.select(*GRAIN, F.col("predicted_sales").alias("sales"))
    ev = metrics.evaluate_predictions(actual, fc, res.train.select(*GRAIN, "sales"))
    n_train = res.train.agg(F.count(F.lit(1))).scalar()
    n_valid = res.valid.agg(F.count(F.lit(1))).scalar()
    return ev.select("wrmsse", "mape", "rmse", "n", "n_series",
                     F.lit(res.best_iteration).alias("best_iteration"),
                     n_train.alias("n_train_rows"), n_valid.alias("n_valid_rows"))


@dataclass
class LeafwiseResult:
    booster: boosting.Booster
    best_iteration: int
    rounds: int
    scored_valid: DataFrame
    train: DataFrame
    valid: DataFrame


def train_leafwise(history: DataFrame, valid_days: int = VALID_DAYS, weight_dampening: str | None = None,
                   settings: boosting.Settings = boosting.Settings(), keep=None) -> LeafwiseResult:
    """W5 -> P18 -> W12 -> W11 -> M2 with the leaf-wise booster (M3).

    Missing features and categories go into the splits as they are: no row is
    dropped, no price filled, no key encoded. Training rows weigh as their
    series sold, dampened (P21); the validation error stays unweighted.
    """
    keep = keep or (lambda name, build: build().checkpoint())
    featured = features.build_features(history)
    feats, categorical = features.feature_columns(featured)
    numeric = [c for c in feats if c not in categorical]
    tr, va = baselines.time_split(featured, valid_days)
    if weight_dampening is not None:
        total = F.sum(F.col("sales").cast("double")).over(Window.partitionBy(*ID_COLUMNS))
        tr = tr.withColumn("weight", metrics.dampen(total, weight_dampening))
    tr, va = keep("leafwise_train", lambda: tr), keep("leafwise_valid", lambda: va)
    booster = boosting.fit(tr, va, numeric, categorical, weight="weight" if weight_dampening else None,
                           settings=settings, keep=keep)
    scored = score_leafwise(booster, va)
    return LeafwiseResult(booster, len(booster.trees), len(booster.curve), scored, tr, va)


def score_leafwise(booster: boosting.Booster, featured: DataFrame) -> DataFrame:
    """Predict, clip at 0, round half-to-even (P14): date, store_id, item_id, predicted_sales."""
    return boosting.predict(featured, booster).select(
        *GRAIN, baselines.clip_round(F.col("prediction")).alias("predicted_sales"))


def carry_price(history: DataFrame) -> DataFrame:
    """Null prices take the series' last known one."""
    if "sell_price" not in history.columns:
        return history
    upto = Window.partitionBy(*ID_COLUMNS).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return history.withColumn("sell_price", F.last("sell_price", ignorenulls=True).over(upto))


def next_day_features(history: DataFrame, calendar: DataFrame | None = None, stores: DataFrame | None = None,
                      reference_stub: bool = False) -> DataFrame:
    """The features of the day after the history's last, one row per series (W10 -> W5).

    The row has the last known price and the next day's event and SNAP flag from
    the calendar, where it is given; ``reference_stub`` leaves them null.
    """
    if reference_stub:
        aug = features.next_day_stub(history)
    else:
        aug = carry_price(features.next_day_stub(history, calendar, stores))
    target = F.date_add(history.agg(F.max("date")).scalar(), 1)
    return features.build_features(aug).filter(F.col("date") == target)


def predict_next_day(history: DataFrame, model: Model, reference_stub: bool = False,
                     calendar: DataFrame | None = None, stores: DataFrame | None = None) -> DataFrame:
    """One-step-ahead forecast of every series (M4): stub at global max+1 -> W5 -> score."""
    return score(model, next_day_features(history, calendar, stores, reference_stub))


def backtest(history: DataFrame, targets: DataFrame, model: Model) -> DataFrame:
    """Features once over the whole history, rows of the target dates, predict (M5)."""
    featured = features.build_features(carry_price(history))
    rows = featured.join(targets.select("date").distinct(), "date", "left_semi")
    return score(model, rows)


def publish_gate(metrics_row: DataFrame, threshold: float = WRMSSE_THRESHOLD) -> DataFrame:
    """M7: publish iff wrmsse < threshold (strict)."""
    return metrics_row.select("wrmsse", (F.col("wrmsse") < F.lit(threshold)).alias("publish"))


def publish(model: Model, metrics_row: DataFrame, path: str,
            threshold: float = WRMSSE_THRESHOLD) -> bool:
    """M7: write the model to the fixed serving path iff the gate passes.
    Only the one-row gate decision reaches the driver."""
    ok = bool(publish_gate(metrics_row, threshold).first()["publish"])
    if ok:
        save(model, path)
    return ok


def save(model: Model, path: str) -> None:
    """Pipeline under `path/pipeline`, each encoding table as Parquet."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    names = [(c,) for c in model.encodings]
    spark = SparkSession.getActiveSession()
    spark.createDataFrame(names, "name string").write.mode("overwrite").parquet(f"{path}/encodings")
    for col, enc in model.encodings.items():
        enc.write.mode("overwrite").parquet(f"{path}/encoding_{col}")


def load(path: str, spark=None) -> Model:
    """Inverse of ``save``; encoding tables are read back lazily as Parquet."""
    spark = spark or SparkSession.getActiveSession()
    pipe = PipelineModel.load(f"{path}/pipeline")
    names = [r["name"] for r in spark.read.parquet(f"{path}/encodings").collect()]
    return Model(pipe, {c: spark.read.parquet(f"{path}/encoding_{c}") for c in names})
