"""Hard negatives from an inverted multi-index.

Vectors are cut into two halves, each half-space has a codebook, and a pair of
codewords is a cell. A codeword's radius is the distance of its farthest vector,
so a half's inner product with the anchor is at most that of the codeword plus
the anchor's half length times the radius; a cell's bound is the sum of its
halves'. Both lists of half bounds are sorted, and a multi-sequence heap visits
the cells by their bounds, highest first.

First the positives are searched, then the windows of scores that each of them
allows. A search ends when its results are certified: no cell left has a bound
that reaches the last place held (or the window's lower end), so the result is
exact. Cells that lie above all windows, by their least possible score, are
passed over.

The visits go in rounds, each of ``GROWTH`` times as many rows as the one before.
Scores that a query has found already, in a bounded sample at first and then in
its rounds, are its floors, and a task returns only what reaches them. Cells lie
in shards, a shard's rows and its queries are dealt into blocks of bounded size,
and every two blocks are a task, so a cell may hold any share of the rows.

Codebooks are fitted on at most about ``SAMPLE`` vectors; all rows are indexed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from salescube.llm.common import settled
from salescube.llm.vectors import matrix

SAMPLE = 16_384
CELL = 200               # rows of a cell, on average, until there are MOST codewords
MOST = 256               # codewords of a half
STEPS = 8                # of the fitting of a codebook
GROWTH = 16
NOWHERE = -1             # the shard of a query's row that only says that it isn't certified yet
SHARD = 16_384
QUERY_BLOCK = 1_024
LONG = (1 << 63) - 1
SAFE = float(1 << 53)    # whole numbers up to here are exact in double precision
LARGE = 1e100            # larger components are scaled in the index, their products would overflow
TINY = 1e-290            # more than underflow takes from a scaled product


def whole_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, held to the range of a long."""
    def size(a: np.ndarray) -> np.ndarray:
        return np.abs(a).max(axis=1, initial=0)

    with np.errstate(over="ignore", invalid="ignore"):
        out = q @ x.T
        risky = size(q)[:, None] * size(x)[None, :] * max(q.shape[1], 1) >= SAFE
    out[risky] = 0
    out = out.astype(np.int64)
    for i, j in zip(*np.nonzero(risky)):
        exact = sum(int(a) * int(b) for a, b in zip(q[i], x[j]))
        out[i, j] = max(-LONG, min(LONG, exact))
    return out


def codebook(sample: np.ndarray, size: int) -> np.ndarray:
    """Lloyd's steps from evenly spread rows; a codeword without rows stays where it is."""
    words = sample[np.linspace(0, len(sample) - 1, size).astype(int)].copy()
    for _ in range(STEPS):
        near = nearest_word(sample, words)
        for c in np.unique(near):
            words[c] = sample[near == c].mean(axis=0)
    return words


def nearest_word(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", words, words)[None, :] - 2 * x @ words.T).argmin(axis=1)


@dataclass(frozen=True)
class Index:
    """Two codebooks, their radii, the rows of each cell and the shard each lies in.

    Bounds are in units of ``scale``, 1 unless components are so large that squares overflow.
    """

    scale: float
    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    shards: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x / self.scale
        return x[:, :x.shape[1] // 2], x[:, x.shape[1] // 2:]

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(bound, least possible score, cell) of the cells that have rows, by falling bound.

        Both are widened by more than rounding can take from them.
        """
        upper, lower = [], []
        for part, words, radii in zip(self.halves(q[None, :]), self.words, self.radii):
            length = math.sqrt(float(part[0] @ part[0]))
            at, slack = words @ part[0], 1e-9 * length * (np.sqrt(np.einsum("ij,ij->i", words, words)) + radii)
            upper.append(at + length * radii + slack + TINY)
            lower.append(at - length * radii - slack - TINY)
        first, second = (np.argsort(-u, kind="stable") for u in upper)
        best = [u[o] for u, o in zip(upper, (first, second))]
        heap = [(-(best[0][0] + best[1][0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(best[0][i + 1] + best[1][0]), i + 1, 0))
            if j + 1 < len(second):
                heapq.heappush(heap, (-(best[0][i] + best[1][j + 1]), i, j + 1))
            a, b = first[i], second[j]
            cell = int(a * len(second) + b)
            if self.sizes[cell]:
                yield self._score(-bound), self._score(lower[0][a] + lower[1][b]), cell

    def _score(self, x: float) -> float:
        """In units of scores, which are held to the range of a long."""
        return min(max(float(x) * self.scale * self.scale, -LONG), LONG)


def build_index(rows: DataFrame, dim: int) -> tuple[DataFrame, Index, tuple]:
    """(rows with their ``cell``, stored; index; (ids, labels, vectors) of the sample) for rows of one length."""
    n = rows.count()
    draw = F.xxhash64(F.lit(3), "vec_id", "q")
    spread = F.pmod(draw, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(spread < min(1.0, SAMPLE / n)).orderBy(draw, "vec_id").select("vec_id", "label", "q").toArrow()
    x = matrix(drawn.column("q").combine_chunks(), dim) if len(drawn) else np.zeros((0, dim))
    sample = (drawn.column("vec_id").to_numpy(), drawn.column("label").to_numpy(), x)
    largest = rows.agg(F.max(F.array_max(F.transform("q", F.abs)))).first()[0]
    scale = largest if largest > LARGE else 1.0
    size = max(1, min(MOST, round(math.sqrt(n / CELL)), len(x)))
    empty = np.zeros(size * size, np.int64)
    bare = Index(scale, (np.zeros((1, 1)),) * 2, (np.zeros(1),) * 2, empty, empty)
    words = tuple(codebook(half, size) for half in bare.halves(x if len(x) else np.zeros((1, dim))))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((bare, words))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, words = shared.value
        for batch in batches:
            halves = index.halves(matrix(batch.column("q"), dim))
            near = [nearest_word(h, w) for h, w in zip(halves, words)]
            far = [np.sqrt(((h - w[c]) ** 2).sum(axis=1)) for h, w, c in zip(halves, words, near)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near[0] * len(words[1]) + near[1]), *map(pa.array, far)],
                [*batch.schema.names, "cell", "far1", "far2"])

    schema = rows.select("*").schema.add("cell", "long").add("far1", "double").add("far2", "double")
    placed = settled(rows.mapInArrow(place, schema), "negatives-index")
    sizes, radii = np.zeros(size * size, np.int64), [np.zeros(size), np.zeros(size)]
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far1"), F.max("far2")).collect():  # MOST * MOST at most
        sizes[r["cell"]] = r["n"]
        for k, c in enumerate(divmod(r["cell"], size)):
            radii[k][c] = max(radii[k][c], r[2 + k])
    shards = (np.cumsum(sizes) - sizes) // SHARD
    return placed.drop("far1", "far2"), Index(scale, words, tuple(radii), sizes, shards), sample


@dataclass(frozen=True)
class Goal:
    """What a search wants for each target of a query: the first ``k`` of its own label, or of other labels."""

    k: int
    same: bool

    def floors(self, scores: np.ndarray, ok: np.ndarray, low: list[int], high: list[int], floors: list[int]) -> list[int]:
        """The k-th score that each target has for sure, if more than what it had."""
        out = []
        for a, b, f in zip(low, high, floors):
            hit = scores[ok & (scores >= a) & (scores <= b)]
            out.append(max(f, int(np.partition(hit, -self.k)[-self.k])) if len(hit) >= self.k else max(f, a))
        return out


def _route(queries: DataFrame, index: Index, sample: tuple, goal: Goal, dim: int, after: int, until: int) -> DataFrame:
    """The queries that aren't certified, a row for each shard they visit in this round.

    A query resumes where it stopped: the cells whose rows are counted from
    ``after`` to ``until`` are visited now.
    """
    shared = queries.sparkSession.sparkContext.broadcast((index, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, (ids, labels, x) = shared.value
        for batch in batches:
            q = matrix(batch.column("q"), dim)
            out: dict[str, list] = {c: [] for c in ("row", "floors", "shard", "cells")}
            for i, r in enumerate(batch.select(["vec_id", "label", "low", "high", "floors"]).to_pylist()):
                floors = r["floors"]
                if not after:
                    ok = ((labels == r["label"]) == goal.same) & (ids != r["vec_id"])
                    floors = goal.floors(whole_products(q[i:i + 1], x)[0], ok, r["low"], r["high"], floors)
                open_ = [(max(f, a), b) for f, a, b in zip(floors, r["low"], r["high"]) if a <= b]
                least, most = min((f for f, _ in open_), default=LONG), max((b for _, b in open_), default=-LONG)
                seen, cells = 0, {}
                for bound, lowest, cell in index.visit(q[i]) if open_ else ():
                    if bound < least:  # certified
                        break
                    if seen >= until:
                        cells.setdefault(NOWHERE, [])
                        break
                    if seen >= after and lowest <= most:
                        cells.setdefault(int(index.shards[cell]), []).append(cell)
                    seen += int(index.sizes[cell])
                for shard, wanted in cells.items():
                    for name, value in zip(out, (i, floors, shard, wanted)):
                        out[name].append(value)
            at = pa.array(out["row"], pa.int64())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("aid", "vec_id", "label", "q", "low", "high")),
                 pa.array(out["floors"], longs), pa.array(out["shard"], pa.int64()), pa.array(out["cells"], longs)],
                ["aid", "vec_id", "label", "q", "low", "high", "floors", "shard", "cells"])

    schema = (queries.select("aid", "vec_id", "label", "q", "low", "high", "floors").schema
              .add("shard", "long").add("cells", ArrayType(LongType())))
    return settled(queries.select("aid", "vec_id", "label", "q", "low", "high", "floors").mapInArrow(run, schema),
                  "negatives-visits")


def _score_blocks(goal: Goal, dim: int):
    names = ["aid", "target", "vec_id", "score"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def run(points: pa.Table, visits: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(points) and len(visits):
            ids, labels = points.column("vec_id").to_numpy(), points.column("label").to_numpy()
            cells = points.column("cell").to_numpy()
            order = np.lexsort((ids, cells))
            ids, labels, cells = ids[order], labels[order], cells[order]
            x = matrix(points.column("q").combine_chunks(), dim)[order]
            q = matrix(visits.column("q").combine_chunks(), dim)
            for i, r in enumerate(visits.drop_columns(["q"]).to_pylist()):
                wanted = np.array(r["cells"])
                begin, end = np.searchsorted(cells, wanted), np.searchsorted(cells, wanted, side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)])
                at = at[((labels[at] == r["label"]) == goal.same) & (ids[at] != r["vec_id"])]
                if not len(at):
                    continue
                scores = whole_products(q[i:i + 1], x[at])[0]
                for target, (a, b, f) in enumerate(zip(r["low"], r["high"], r["floors"])):
                    hit = np.flatnonzero((scores >= max(a, f)) & (scores <= b))
                    hit = hit[np.lexsort((ids[at[hit]], -scores[hit]))][:goal.k]
                    found += [(r["aid"], target, int(ids[at[h]]), int(scores[h])) for h in hit]
        return pa.Table.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(types)], names)

    return run


def _visit(points: DataFrame, visits: DataFrame, goal: Goal, dim: int) -> DataFrame:
    """(aid, target, vec_id, score) of what the visited cells hold at or above the floors."""
    blocks = (points.groupBy("shard").agg(F.ceil(F.count("*") / (2 * SHARD)).cast("int").alias("pb"))
              .join(visits.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qb")), "shard"))

    def dealt(rows: DataFrame, own: tuple[str, str], other: tuple[str, str], key: Column) -> DataFrame:
        return (rows.join(blocks, "shard").withColumn(own[0], F.pmod(key, F.col(own[1])).cast("int"))
                .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1))).drop("pb", "qb"))

    p, q = ("p", "pb"), ("qn", "qb")
    return (dealt(points, p, q, F.xxhash64("vec_id", "q")).groupBy("shard", "p", "qn")
            .cogroup(dealt(visits, q, p, F.xxhash64("aid")).groupBy("shard", "p", "qn"))
            .applyInArrow(_score_blocks(goal, dim), "aid long, target int, vec_id long, score long"))


def search(points: DataFrame, index: Index, queries: DataFrame, sample: tuple, goal: Goal, dim: int) -> DataFrame:
    """(aid, target, rank, vec_id, score): the certified first ``k`` of each target of each query.

    ``queries``: (aid, vec_id, label, q, low, high), the last two with the least
    and greatest score of each target.
    """
    n = int(index.sizes.sum())
    codes = queries.sparkSession.sparkContext.broadcast(index.shards)

    @F.pandas_udf("long")
    def shard_of(cell: pd.Series) -> pd.Series:
        return pd.Series(codes.value[cell.to_numpy()])

    points = points.withColumn("shard", shard_of("cell"))
    best = Window.partitionBy("aid", "target").orderBy(F.desc("score"), "vec_id")
    state, held, after, until = queries.withColumn("floors", F.col("low")), None, 0, GROWTH * SAMPLE
    while after < n:
        visits = _route(state, index, sample, goal, dim, after, until)
        got = _visit(points, visits, goal, dim)
        got = got if held is None else got.unionByName(held)
        held = settled(got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= goal.k)
                      .drop("rank"), "negatives-held")
        after, until = until, GROWTH * until
        if after < n:
            floors = (held.groupBy("aid", "target").agg(F.count("*").alias("n"), F.min("score").alias("score"))
                      .where(F.col("n") == goal.k).groupBy("aid")
                      .agg(F.map_from_entries(F.collect_list(F.struct("target", "score"))).alias("kth")))
            kth = F.transform("floors", lambda f, i: F.greatest(f, F.coalesce(F.try_element_at("kth", i), f)))
            state = (queries.join(visits.where(F.col("shard") == NOWHERE).select("aid", "floors"), "aid")
                     .join(floors, "aid", "left").withColumn("floors", F.when(F.col("kth").isNull(), F.col("floors")).otherwise(kth))
                     .drop("kth"))
    if held is None:
        return queries.sparkSession.createDataFrame([], "aid long, target int, rank int, vec_id long, score long")
    return held.withColumn("rank", F.row_number().over(best))


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str, steps: int) -> DataFrame:
    """Distinct (vec_id, label, q): each component x as the whole number floor(steps * x), in double precision."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(float(steps)))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
    # Doubles from 2 ** 52 on are whole.
    whole = F.transform(v, lambda x: F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(x))
    return (rows.where(F.coalesce(ok, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                    whole.alias("q")).distinct())


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         steps: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. Scores are inner
    products of whole numbers, higher first, ties to the smaller id. A positive
    is among the first ``positives`` rows of the anchor's label; its negatives
    are the first rows of other labels whose score is from ``low`` to ``high``
    percent of its own.

    Rows with a null id or label, a null or empty vector, or a component that is
    null or not finite (also after scaling by ``steps``) take no part. Only
    vectors of one length are compared. Repeated rows are one; rows of the
    anchor's id are neither its positives nor its negatives; rows that repeat an
    id otherwise are rows of their own. Scores beyond a long are held to its
    range. Other columns are not read; no rows give no result.
    """
    whole = settled(whole_vectors(rows, id_col, vec_col, label_col, steps).withColumn("dim", F.size("q")),
                   "negatives-rows")
    out = None
    for r in whole.select("dim").distinct().orderBy("dim").collect():  # one length in practice
        part = _mine_length(whole.where(F.col("dim") == r["dim"]).drop("dim"), r["dim"], every, positives, negatives, low, high)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], (
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
    return out


def _mine_length(rows: DataFrame, dim: int, every: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    points, index, sample = build_index(rows, dim)
    anchors = settled(rows.where(F.col("vec_id") % every == 0).withColumn("aid", F.monotonically_increasing_id()),
                     "negatives-anchors")
    whole_range = anchors.withColumn("low", F.array(F.lit(-LONG))).withColumn("high", F.array(F.lit(LONG)))
    near = search(points, index, whole_range, sample, Goal(positives, True), dim)
    near = settled(near.select("aid", F.col("vec_id").alias("positive_id"), (F.col("rank") - 1).alias("target"),
                              F.col("score").alias("positive_score")), "negatives-positives")
    share = F.col("positive_score").cast("decimal(20,0)") / 100
    windows = (near.withColumn("low", F.ceil(share * low).cast("long")).withColumn("high", F.floor(share * high).cast("long"))
               .groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("target", "low", "high"))).alias("w"))
               .select("aid", F.col("w.low").alias("low"), F.col("w.high").alias("high")))
    far = search(points, index, anchors.join(windows, "aid"), sample, Goal(negatives, False), dim)
    return (near.join(far.withColumnRenamed("score", "negative_score"), ["aid", "target"])
            .join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", "negative_score"))
