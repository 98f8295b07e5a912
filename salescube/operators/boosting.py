"""Leaf-wise histogram boosting for squared error (M1, M2 with missing values and categories).

Features are binned once: numbers by the quantiles of all rows, categories by a
code of their own; bin 0 is a missing value. The binned rows are a stored table.
A pass over it sums gradients and weights by (node, feature, bin) in each task,
Spark adds the sums up, and the driver, which holds a bounded table of nodes,
features and bins and never a row, chooses the splits:

* of two siblings only the smaller is summed, the other is the parent less it;
* a number's split tries missing values on both sides and learns the better one;
* a category's split orders the node's categories by their mean gradient;
* leaves wait in a queue by gain; the best one is split next until there are
  ``leaves``. A pass sums the children of the ``AHEAD`` most promising leaves, and
  of their children, before it is known which will be split; so a tree takes about
  as many passes as it has levels, and the result is that of one split at a time.

Margins are stored every ``STORE_EVERY`` rounds, and the few trees since are added
in the tasks, so every round is fitted once and goes on from the last one. Rounds
end when the validation error hasn't improved for ``patience`` of them.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 255               # of a number, beside the one for missing values
CATEGORIES = 1_023       # most frequent values with a bin of their own; the others share the last bin
STORE_EVERY = 10
AHEAD = 64               # leaves that are split on trial in one pass


@dataclass(frozen=True)
class Settings:
    rounds: int = 500
    patience: int = 20
    rate: float = 0.05
    leaves: int = 63
    least_rows: int = 20
    l2: float = 1e-9


@dataclass
class Binning:
    numeric: list[str]
    categorical: list[str]
    edges: list[list[float]]              # of each number, ascending
    codes: list[dict[str, int]]           # of each category, from 1

    @property
    def width(self) -> int:
        sizes = [len(e) + 2 for e in self.edges] + [len(c) + 2 for c in self.codes]
        return max(sizes, default=1)

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows x features."""
        out = []
        for name, edges in zip(self.numeric, self.edges):
            x = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            out.append(np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(edges), x, side="left")))
        for name, codes in zip(self.categorical, self.codes):
            values = batch.column(name).cast(pa.string()).dictionary_encode()
            known = np.array([codes.get(v, len(codes) + 1) for v in values.dictionary.to_pylist()] + [0])
            at = values.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)
            out.append(known[at])
        return np.column_stack(out).astype(np.int16) if out else np.zeros((len(batch), 0), np.int16)


@dataclass
class Tree:
    """Node k's split: rows whose bin of ``feature`` is in ``left_bins`` go to ``left``, the others to ``left + 1``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    left_bins: list[list[int]] = field(default_factory=lambda: [[]])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, left_bins: list[int]) -> int:
        self.feature[node], self.left[node], self.left_bins[node] = feature, len(self.feature), left_bins
        for _ in range(2):
            self.feature.append(-1)
            self.left.append(-1)
            self.left_bins.append([])
            self.value.append(0.0)
        return self.left[node]

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        node = np.zeros(len(bins), np.int64)
        for k, f in enumerate(self.feature):  # children come after their parent
            if f >= 0:
                here = np.flatnonzero(node == k)
                goes_left = np.isin(bins[here, f], self.left_bins[k])
                node[here] = np.where(goes_left, self.left[k], self.left[k] + 1)
        return node

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(bins)]


@dataclass
class Booster:
    binning: Binning
    base: float
    trees: list[Tree]
    curve: list[float]                     # the validation error after every round that was fitted

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return sum((t.margins(bins) for t in self.trees), np.full(len(bins), self.base))

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Booster:
        d = json.loads(text)
        return Booster(Binning(**d["binning"]), d["base"], [Tree(**t) for t in d["trees"]], d["curve"])


def fit_binning(rows: DataFrame, numeric: list[str], categorical: list[str], bins: int = BINS,
                categories: int = CATEGORIES) -> Binning:
    """Quantiles and codes over all rows; ties of frequency go by name."""
    levels = [k / bins for k in range(1, bins)]
    x = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numeric]
    got = rows.agg(*[F.percentile_approx(c, levels, 20_000).alias(f"q{i}") for i, c in enumerate(x)]).first() if x else ()
    edges = [sorted(set(q or ())) for q in got]
    codes = []
    for c in categorical:
        top = (rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
               .orderBy(F.desc("count"), "v").limit(categories).collect())
        codes.append({r["v"]: i + 1 for i, r in enumerate(top)})
    return Binning(list(numeric), list(categorical), edges, codes)


def binned(rows: DataFrame, binning: Binning, label: str, weight: str | None = None) -> DataFrame:
    """(bins, y, w, margin): rows with a null label are left out, a null weight is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binning.bins(batch)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(bins.ravel()), max(1, bins.shape[1])) if bins.size else (
                pa.array([[]] * len(batch), pa.list_(pa.int16())))
            yield pa.RecordBatch.from_arrays(
                [lists.cast(pa.list_(pa.int16())), batch.column("_y"), batch.column("_w")], ["bins", "y", "w"])

    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    cols = [*binning.numeric, *binning.categorical]
    given = rows.where(F.col(label).isNotNull()).select(*cols, F.col(label).cast("double").alias("_y"), w.alias("_w"))
    return given.mapInArrow(run, "bins array<short>, y double, w double").withColumn("margin", F.lit(0.0))


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return batch.column("bins").flatten().to_numpy().reshape(-1, features) if len(batch) else np.zeros((0, features), np.int16)


def _margin_after(batch: pa.RecordBatch, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    return sum((t.margins(bins) for t in trees), batch.column("margin").to_numpy().copy())


def histograms(rows: DataFrame, features: int, width: int, tree: Tree, nodes: list[int], recent: list[Tree]) -> np.ndarray:
    """nodes x features x bins x (gradient, weight, rows), summed over all rows that lie in these leaves of the tree."""
    wanted = {n: i for i, n in enumerate(nodes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(nodes) * features * width))
        for batch in batches:
            bins = _matrix(batch, features)
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            g = (_margin_after(batch, bins, recent) - y) * w
            at = np.array([wanted.get(n, -1) for n in range(len(tree.feature))])[tree.place(bins)]
            here = np.flatnonzero(at >= 0)
            for f in range(features):
                key = (at[here] * features + f) * width + bins[here, f]
                for k, v in enumerate((g[here], w[here], None)):
                    total[k] += np.bincount(key, v, total.shape[1])
        key = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(t[key]) for t in total)], ["key", "g", "w", "n"])

    out = np.zeros((len(nodes) * features * width, 3))
    summed = (rows.mapInArrow(run, "key long, g double, w double, n double").groupBy("key")
              .agg(F.sum("g").alias("g"), F.sum("w").alias("w"), F.sum("n").alias("n"))).toArrow()  # at most nodes x features x bins
    out[summed.column("key").to_numpy()] = np.column_stack([summed.column(c).to_numpy() for c in "gwn"])
    return out.reshape(len(nodes), features, width, 3)


def best_split(hist: np.ndarray, numeric: int, s: Settings) -> tuple[float, int, list[int]] | None:
    """(gain, feature, bins that go left) of the best split of a node; the first of equal ones."""
    total = hist[0].sum(axis=0)

    def score(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (x[..., 1] + s.l2)

    best = None
    for f in range(len(hist)):
        used = np.flatnonzero(hist[f, :, 2])
        if f < numeric:
            seen = used[used > 0]
            orders = [np.concatenate([[0], seen]), np.append(seen, 0)] if 0 in used else [seen]
        else:
            mean = hist[f, used, 0] / (hist[f, used, 1] + s.l2)
            orders = [used[np.lexsort((used, mean))]]
        for again, order in enumerate(orders):
            # The second order's last split, missing values alone, is the first order's first.
            left = np.cumsum(hist[f, order], axis=0)[:len(order) - 1 - again]
            if not len(left):
                continue
            right = total - left
            ok = (left[:, 2] >= s.least_rows) & (right[:, 2] >= s.least_rows)
            gain = np.where(ok, score(left) + score(right) - score(total), -np.inf)
            k = int(gain.argmax())
            if gain[k] > 1e-12 * max(1.0, score(total)) and (best is None or gain[k] > best[0]):
                best = float(gain[k]), f, sorted(int(b) for b in order[:k + 1])
    return best


def grow(sums: Callable[[Tree, list[int]], np.ndarray], numeric: int, s: Settings) -> Tree:
    """A tree of at most ``leaves`` leaves; ``sums(tree, nodes)`` gives the histograms of leaves."""
    trial = Tree()
    hist = {0: sums(trial, [0])[0]}
    total = {0: hist[0][0].sum(axis=0)}
    choice = {0: best_split(hist[0], numeric, s)}
    waiting = [(-choice[0][0], 0)] if choice[0] else []
    open_ = {0} if choice[0] else set()   # trial leaves that can be split
    chosen: list[int] = []
    while waiting and len(chosen) + 1 < s.leaves:
        node = waiting[0][1]
        if node in open_:
            # Split the most promising leaves on trial, and sum the smaller children of all of them in one pass.
            ahead = sorted(open_ - {node}, key=lambda k: (-choice[k][0], k))[:AHEAD - 1]
            smaller = {}
            for k in [node, *ahead]:
                _, f, left_bins = choice[k]
                child = trial.split(k, f, left_bins)
                lesser = 2 * hist[k][f, left_bins, 2].sum() <= total[k][2]
                smaller[child if lesser else child + 1] = (k, child + 1 if lesser else child)
                open_.discard(k)
            for h, (child, (k, sibling)) in zip(sums(trial, list(smaller)), smaller.items()):
                hist[child], hist[sibling] = h, hist.pop(k) - h
                hist[sibling][hist[sibling][..., 2] == 0] = 0.0  # what rounding leaves in empty bins
                for c in (child, sibling):
                    total[c] = hist[c][0].sum(axis=0)
                    choice[c] = best_split(hist[c], numeric, s)
                    if choice[c]:
                        open_.add(c)
        heapq.heappop(waiting)
        chosen.append(node)
        for c in (trial.left[node], trial.left[node] + 1):
            if choice[c]:
                heapq.heappush(waiting, (-choice[c][0], c))
    return _kept(trial, chosen, total, s)


def _kept(trial: Tree, chosen: list[int], total: dict[int, np.ndarray], s: Settings) -> Tree:
    """The chosen splits alone, with the values of their leaves."""
    tree, names = Tree(), {0: 0}
    for node in chosen:
        left = tree.split(names[node], trial.feature[node], trial.left_bins[node])
        names[trial.left[node]], names[trial.left[node] + 1] = left, left + 1
    for old, new in names.items():
        g, w, _ = total[old]
        tree.value[new] = float(-s.rate * g / (w + s.l2))
    return tree


def fit(train: DataFrame, valid: DataFrame, numeric: list[str], categorical: list[str], label: str = "sales",
        weight: str | None = None, settings: Settings = Settings(),
        keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, build: build().checkpoint()) -> Booster:
    """The booster of the round with the least validation error.

    Rows with a null label are left out; missing features stay missing, so rows
    need no fill and none is dropped. Weights count in training only. Without a
    validation row all rounds are fitted. ``keep(name, build)`` stores a table.
    """
    s = settings
    binning = fit_binning(train, numeric, categorical)
    features, width = len(numeric) + len(categorical), binning.width
    train_rows = keep("boost_train", lambda: binned(train, binning, label, weight))
    valid_rows = keep("boost_valid", lambda: binned(valid, binning, label))
    mean = train_rows.agg(F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()[0]
    base = float(mean or 0.0)
    trees, curve, stored = [], [], 0
    best = 0
    start = Tree(value=[base])

    def recent() -> list[Tree]:
        return ([start] if not stored else []) + trees[stored:]

    def moved(rows: DataFrame, now: list[Tree]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = _margin_after(batch, _matrix(batch, features), now)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("bins", "y", "w")), pa.array(margin)],
                                                 ["bins", "y", "w", "margin"])
        return rows.mapInArrow(run, "bins array<short>, y double, w double, margin double")

    while len(trees) < s.rounds and features:
        now = recent()
        tree = grow(lambda t, nodes: histograms(train_rows, features, width, t, nodes, now), len(numeric), s)
        trees.append(tree)
        error = _squared_error(valid_rows, features, recent())
        curve.append(error)
        if error is not None:
            best = len(curve) - 1 if error < curve[best] or len(curve) == 1 else best
            if len(curve) - 1 - best >= s.patience:
                break
        if len(tree.feature) == 1:  # nothing left to split
            break
        if len(trees) - stored >= STORE_EVERY:
            now, at = recent(), len(trees)
            train_rows = keep(f"boost_train_{at}", lambda rows=train_rows: moved(rows, now))
            valid_rows = keep(f"boost_valid_{at}", lambda rows=valid_rows: moved(rows, now))
            stored = at
    errors = [e for e in curve if e is not None]
    return Booster(binning, base, trees[:best + 1] if errors else trees, errors)


def _squared_error(rows: DataFrame, features: int, now: list[Tree]) -> float | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for batch in batches:
            e = _margin_after(batch, _matrix(batch, features), now) - batch.column("y").to_numpy()
            n, total = n + len(e), total + float(e @ e)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], ["n", "total"])

    r = rows.mapInArrow(run, "n long, total double").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return r["total"] / r["n"] if r["n"] else None


def predict(rows: DataFrame, booster: Booster, out_col: str = "prediction") -> DataFrame:
    """All columns of ``rows`` with the prediction; a column of that name is replaced. Unseen categories share a bin."""
    kept = [c for c in rows.columns if c != out_col]
    shared = rows.sparkSession.sparkContext.broadcast(booster)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = shared.value.margins(shared.value.binning.bins(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(margin)], [*kept, out_col])

    return rows.select(*kept).mapInArrow(run, rows.select(*kept).schema.add(out_col, "double"))
