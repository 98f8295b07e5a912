"""Approximate nearest neighbours by inner product.

A forest of random-projection trees: at each level of a tree all nodes share
one random direction, and each node splits at the median of its own sample
vectors. Vectors get one more component that makes their lengths equal, so the
largest inner product is the smallest distance. A search keeps the open nodes of
all trees in one priority queue, by the squared margins that lie between the
query and the node; it pops leaves until their vectors fill the budget, and the
vectors of these leaves are ranked by the exact inner product.

The forest is fitted on a bounded sample, every row is indexed. The budget is
calibrated: for a bounded sample of queries the true neighbours are found by
brute force, and the budget is what ``target`` of them need. Vectors without
structure, such as uniformly random ones, need a large share of all leaves; the
calibration then pays that price instead of losing recall.

Exact copies are one class, searched once, and a class gives its first ids only.
Of the sample's vectors in the leaves that a query pops, the k-th best score is a
floor that it reaches for sure, and what it has found in one round of leaves is
its floor in the next, which pops ``GROWTH`` times as many vectors: a task returns
only what reaches the floor.
Leaves lie in shards, neighbouring leaves together; a shard's vectors and its
queries are dealt into blocks of bounded size and every two blocks are a task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescube.llm.common import stored
from salescube.llm.vectors import keyed, matrix

TREES = 4
LEAF = 128
MAX_DEPTH = 10         # at most 1,024 leaves a tree; larger inputs have larger leaves
SAMPLE = 16_384        # bound of the vectors that fit the forest
PROBES = 64            # bound of the queries that calibrate the budget
TARGET = 0.96
SHARD = 8_192
QUERY_BLOCK = 4_096
GROWTH = 16
ROUTED = 1_000         # queries that a task routes
LARGE = 1e100          # larger components are scaled in the index, their squares would overflow


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision; only those that are too large themselves are infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = q @ x.T
        for i, j in zip(*np.nonzero(~np.isfinite(out))):  # sums that overflow on their way
            a, b = np.abs(q[i]).max(), np.abs(x[j]).max()
            out[i, j] = (q[i] / a) @ (x[j] / b) * min(a, b) * max(a, b)
    return out


@dataclass(frozen=True)
class Forest:
    scale: float              # vectors are divided by it in the index
    radius: float             # the largest length of a scaled vector
    depth: int
    directions: np.ndarray    # trees x depth x (dim + 1)
    cuts: list[np.ndarray]    # for each level, trees x nodes

    def _extended(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = self.radius ** 2 - np.einsum("ij,ij->i", x, x)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(rest, 0))
        return np.column_stack([x, last])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        x = self._extended(x / self.scale, False)
        out = np.zeros((len(x), len(self.directions)), np.int64)
        for t in range(out.shape[1]):
            for level in range(self.depth):
                out[:, t] = 2 * out[:, t] + (x @ self.directions[t, level] > self.cuts[level][t][out[:, t]])
        return out

    def search(self, q: np.ndarray, sizes: np.ndarray, budget: float) -> Iterator[tuple[int, int, int]]:
        """(tree, leaf, vectors popped so far) in the queue's order until the budget is full."""
        place = self._extended(q[None, :] / self.scale, True)[0]
        at = np.einsum("tld,d->tl", self.directions, place) if self.depth else np.zeros((len(sizes), 0))
        heap = [(0.0, t, 0, 0) for t in range(len(sizes))]
        seen = 0
        while heap and seen < budget:
            margin, t, level, node = heapq.heappop(heap)
            while level < self.depth:
                side = at[t, level] - self.cuts[level][t][node]
                near = int(side > 0)
                heapq.heappush(heap, (margin + side * side, t, level + 1, 2 * node + 1 - near))
                level, node = level + 1, 2 * node + near
            seen += int(sizes[t, node])
            yield t, node, seen


def fit(sample: np.ndarray, n: int, radius: float, scale: float = 1.0, trees: int = TREES, leaf: int = LEAF) -> Forest:
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(n, 1) / leaf))))
    rng = np.random.default_rng(97)
    directions = rng.standard_normal((trees, depth, sample.shape[1] + 1))
    cuts = [np.zeros((trees, 1 << level)) for level in range(depth)]
    forest = Forest(scale, radius, depth, directions, cuts)
    x = forest._extended(sample / scale, False)
    for t in range(trees):
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            p = x @ directions[t, level]
            order = np.lexsort((p, node))
            begin = np.searchsorted(node[order], np.arange(1 << level))
            end = np.searchsorted(node[order], np.arange(1 << level), side="right")
            middle = np.minimum((begin + end) // 2, len(x) - 1)
            cuts[level][t] = np.where(end > begin, p[order][middle], 0.0)
            node = 2 * node + (p > cuts[level][t][node])
    return forest


def best_of(scores: np.ndarray, ids: np.ndarray, k: int, ok: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest scores of each row among those that are ``ok``, ties to the smaller id."""
    ok = np.ones(scores.shape, bool) if ok is None else ok
    if scores.shape[1] > k:
        # What isn't ok is lowest; where fewer than k are, all of them are kept.
        least = np.partition(np.where(ok, scores, -np.inf), -k, axis=1)[:, -k][:, None]
        row, col = np.nonzero(ok & (scores >= least))
    else:
        row, col = np.nonzero(ok)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], col[rank < k]


def _true_neighbours(classes: DataFrame, dim: int, probes: np.ndarray, k: int) -> list:
    """(probe, class_id, leaves) of the k best classes for each probe, by brute force in blocks."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("class_id").to_numpy()
            scores = inner(probes, matrix(batch.column("vec"), dim))
            row, col = best_of(scores, ids, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(ids[col]), pa.array(scores[row, col]),
                 batch.column("leaves").take(pa.array(col))], ["probe", "class_id", "score", "leaves"])

    best = Window.partitionBy("probe").orderBy(F.desc("score"), "class_id")
    return (classes.select("class_id", "vec", "leaves")
            .mapInArrow(blocks, "probe long, class_id long, score double, leaves array<long>")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("probe", "class_id", "leaves").collect())


def calibrate(forest: Forest, sizes: np.ndarray, probes: np.ndarray, truth: list, target: float) -> float:
    """The budget at which ``target`` of the true neighbours lie in popped leaves."""
    needed = []
    for p in range(len(probes)):
        upto = {(t, leaf): seen for t, leaf, seen in forest.search(probes[p], sizes, math.inf)}
        needed += [min(upto[t, leaf] for t, leaf in enumerate(r["leaves"])) for r in truth if r["probe"] == p]
    return float(np.quantile(needed, target, method="higher")) if needed else math.inf


def _rank_block(k: int, dim: int):
    names, types = ["query_class", "class_id", "score"], [pa.int64(), pa.int64(), pa.float64()]

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(points) or not len(queries):
            return pa.Table.from_arrays([pa.array([], t) for t in types], names)
        ids, leaf = points.column("class_id").to_numpy(), points.column("leaf").to_numpy()
        x = matrix(points.column("vec").combine_chunks(), dim)
        asked = queries.column("query_class").to_numpy()
        q = matrix(queries.column("vec").combine_chunks(), dim)
        wanted = queries.column("wanted").combine_chunks()
        owner = np.repeat(np.arange(len(q)), wanted.value_lengths().to_numpy())
        wanted, floor = wanted.flatten().to_numpy(), queries.column("floor").to_numpy()
        out = []
        for at in range(0, len(q), 256):
            scores = np.zeros((min(256, len(q) - at), len(x)))
            ok = np.zeros(scores.shape, bool)
            mine = (owner >= at) & (owner < at + 256)
            for here in np.unique(wanted[mine]):
                rows, cols = owner[mine & (wanted == here)] - at, np.flatnonzero(leaf == here)
                at_here = np.ix_(rows, cols)
                scores[at_here] = inner(q[rows + at], x[cols])
                ok[at_here] = scores[at_here] >= floor[rows + at, None]
            row, col = best_of(scores, ids, k, ok)
            out.append((asked[row + at], ids[col], scores[row, col]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), types)], names)

    return run


def _search_length(classes: DataFrame, asked: DataFrame, dim: int, k: int, target: float) -> DataFrame:
    """(query_class, class_id, score): the k best classes found for each asked class of one length."""
    stats = classes.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("vec", F.abs))).alias("most")).first()
    n, scale = stats["n"], stats["most"] if stats["most"] > LARGE else 1.0
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))
    radius = math.sqrt(classes.agg(F.max(square)).first()[0])
    spread = F.pmod("h1", F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = classes.where(spread < min(1.0, SAMPLE / n)).select("vec").orderBy("h1", "h2").toArrow().column("vec")
    # A sample may come out empty where there are few rows; any vector fits a forest without levels.
    sample = matrix(sample.combine_chunks(), dim) if len(sample) else np.zeros((0, dim))
    forest = fit(sample, n, radius, scale)
    known = classes.sparkSession.sparkContext.broadcast((sample, forest.leaves(sample)))
    largest = radius * scale
    shared = classes.sparkSession.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.leaves(matrix(batch.column("vec"), dim))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(leaves.ravel()), leaves.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), batch.column("vec"), lists.cast(pa.list_(pa.int64()))],
                ["class_id", "vec", "leaves"])

    placed = stored(classes.select("class_id", "vec").mapInArrow(
        place, "class_id long, vec array<double>, leaves array<long>"), "ann-index")
    points = placed.select("class_id", "vec", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((TREES, 1 << forest.depth), np.int64)  # trees x at most 1,024 numbers
    for r in points.groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]

    few = asked.count()
    chosen = asked.where(F.pmod(F.xxhash64(F.lit(5), "class_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
                         < min(1.0, 2 * PROBES / max(few, 1))).select("vec").orderBy("class_id").limit(PROBES)
    probes = chosen.toArrow().column("vec")
    probes = matrix(probes.combine_chunks(), dim) if len(probes) else np.zeros((0, dim))
    truth = _true_neighbours(placed, dim, probes, k)
    budget = calibrate(forest, sizes, probes, truth, target)
    shift = forest.depth - min(forest.depth, max(0, math.ceil(math.log2(n / SHARD))))

    def route(after: float, until: float):
        """The leaves that each query pops when it has popped from ``after`` to ``until`` vectors."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, floor = matrix(batch.column("vec"), dim), batch.column("floor").to_numpy().copy()
                sample, homes = known.value
                row, tree, shard, wanted = [], [], [], []
                for i in range(len(q)):
                    popped: dict[tuple[int, int], list[int]] = {}
                    mine = np.zeros(sizes.shape, bool)
                    past = 0
                    for t, leaf, seen in shared.value.search(q[i], sizes, until):
                        mine[t, leaf] = True
                        if past >= after:
                            popped.setdefault((t, leaf >> shift), []).append(leaf)
                        past = seen
                    row += [i] * len(popped)
                    tree += [t for t, _ in popped]
                    shard += [s for _, s in popped]
                    wanted += popped.values()
                    # Vectors of the sample that lie in popped leaves will be found, the k-th of them is a floor.
                    sure = sample[mine[np.arange(len(sizes)), homes].any(axis=1)]
                    if after == 0 and len(sure) >= k:
                        floor[i] = np.partition(inner(q[i:i + 1], sure)[0], -k)[-k]
                with np.errstate(over="ignore", invalid="ignore"):  # the last bits of a product vary by block
                    floor -= 1e-9 * np.sqrt(np.einsum("ij,ij->i", q, q)) * largest
                    floor[np.isnan(floor)] = -np.inf
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class_id").take(at), batch.column("vec").take(at), pa.array(floor).take(at),
                     pa.array(tree, pa.int32()), pa.array(shard, pa.int64()), pa.array(wanted, pa.list_(pa.int64()))],
                    ["query_class", "vec", "floor", "tree", "shard", "wanted"])
        return run

    points = points.withColumn("shard", F.shiftright("leaf", shift))
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    # Routing costs Python time, so its tasks go by the number of queries.
    queries = stored(asked.select("class_id", "vec").repartition(max(1, math.ceil(few / ROUTED)), "class_id"), "ann-asked")
    floors, held, after, until = queries.withColumn("floor", F.lit(-math.inf)), None, 0.0, float(GROWTH * SAMPLE)
    while held is None or after < min(budget, TREES * n):
        routed = stored(floors.select("class_id", "vec", "floor").mapInArrow(
            route(after, min(until, budget)),
            "query_class long, vec array<double>, floor double, tree int, shard long, wanted array<long>"), "ann-queries")
        found = _ranked(points, routed, k, dim)
        found = found if held is None else found.unionByName(held)
        held = stored(found.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
                      .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"), "ann-held")
        after, until = until, GROWTH * until
        kth = held.groupBy(F.col("query_class").alias("class_id")).agg(
            F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(-math.inf)).alias("floor"))
        floors = queries.join(kth, "class_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-math.inf)))
    return held


def _ranked(points: DataFrame, routed: DataFrame, k: int, dim: int) -> DataFrame:
    """(query_class, class_id, score): the best of each block of points and queries that reach the queries' floors."""
    blocks = (points.groupBy("tree", "shard").agg(F.ceil(F.count("*") / (2 * SHARD)).cast("int").alias("pb"))
              .join(routed.groupBy("tree", "shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qb")),
                    ["tree", "shard"]))

    def dealt(rows: DataFrame, id_col: str, own: list[str], other: list[str]) -> DataFrame:
        return (rows.join(blocks, ["tree", "shard"])
                .withColumn(own[0], F.pmod(F.xxhash64(id_col), F.col(own[1])).cast("int"))
                .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1))).drop("pb", "qb"))

    key, p, q = ["tree", "shard", "p", "q"], ["p", "pb"], ["q", "qb"]
    return (dealt(points, "class_id", p, q).groupBy(*key).cogroup(dealt(routed, "query_class", q, p).groupBy(*key))
            .applyInArrow(_rank_block(k, dim), "query_class long, class_id long, score double"))


def nearest(rows: DataFrame, k: int = 20, every: int = 20, target: float = TARGET,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row whose id is divisible by ``every``.

    Nearness is the inner product in double precision, ties go to the smaller
    id; candidates are all other rows of the same length. Null and zero vectors,
    vectors with null or non-finite components and rows with a null id take no
    part. Rows that repeat an id count as that id's own row for its queries.
    Other columns are not read; no rows give no result.
    """
    vectors = keyed(rows, id_col, vec_col).withColumn("dim", F.size("vec"))
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    # Of a class only the k + 1 smallest ids can be among the k nearest of any row; a repeated row is one id.
    ids = (vectors.select("h1", "h2", "vec_id").distinct()
           .withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
           .groupBy("h1", "h2").agg(F.min("vec_id").alias("class_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    heads = vectors.groupBy("h1", "h2", "dim").agg(F.min_by("vec", "vec_id").alias("vec"))
    classes = stored(heads.join(ids, ["h1", "h2"]), "ann-classes")
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    queries = stored(queries.join(classes.select("h1", "h2", F.col("class_id").alias("query_class")), ["h1", "h2"])
                     .select("query_id", "query_class"), "ann-query-ids")
    asked = classes.join(queries.select(F.col("query_class").alias("class_id")).distinct(), "class_id", "left_semi")
    found = None
    for r in classes.select("dim").distinct().orderBy("dim").collect():  # one length in practice
        own = F.col("dim") == r["dim"]
        part = _search_length(classes.where(own), asked.where(own), r["dim"], k + 1, target)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_class long, class_id long, score double")
    order = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    listed = (found.join(classes.select("class_id", "ids"), "class_id")
              .select("query_class", "score", F.explode("ids").alias("vec_id"))
              .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
              .groupBy("query_class").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near")))
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (queries.join(listed, "query_class").select("query_id", F.posexplode(mine).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"))
