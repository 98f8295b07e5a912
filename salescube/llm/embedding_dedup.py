"""Embedding near-dedup by collision counting.

Vectors are projected on many random lines. Two unit vectors at distance d lie
at most ``w`` apart on a line with probability 2 Phi(w / d) - 1, so close pairs
collide on most lines and far ones on few. On each line the vectors are sorted
and a window centred on each vector holds those it collides with; a pair whose
windows meet at least ``least`` times is verified by its cosine in double
precision. ``w``, the number of lines and ``least`` follow from the chosen
probability to miss a pair that is just at the threshold.

Counting all pairs would be quadratic, so it is confined to cells: a cell is
the side of ``bits`` further random lines on which a vector lies. Pairs at the
threshold share a cell with probability (1 - angle / pi) ** bits, whatever the
data; the number of tables of cells follows from the same miss probability.
``bits`` grows with the logarithm of the number of vectors, so a cell of
scattered vectors keeps its size. A pair counts only in the first table in
which it shares a cell, which both vectors can tell, so each link is counted
once and no list of pairs is ever made: a task returns the number of links of
each vector and the edges of a spanning forest.

Exact copies are one vector with a multiplicity. A cell of more than ``block``
vectors is cut into blocks by hash and every two blocks are one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import stored
from salescube.llm.components import connected_components
from salescube.llm.vectors import by_length, keyed, matrix, unit, usable

THRESHOLD = 0.95
MISS = 1e-5
LINES = 32
CELL = 256
BLOCK = 2048


@dataclass(frozen=True)
class Plan:
    threshold: float
    bits: int      # sides that make a cell
    tables: int
    lines: int     # projections whose collisions are counted
    width: float   # half of a window
    least: int     # collisions that make a candidate


def calibrate(n: int, threshold: float = THRESHOLD, miss: float = MISS, lines: int = LINES,
              cell: int = CELL) -> Plan:
    """Half of the miss probability goes to the cells and half to the counts."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / cell)))
    share = (1 - math.acos(threshold) / math.pi) ** bits
    tables = 1 if share == 1 else math.ceil(math.log(miss / 2) / math.log(1 - share))
    distance = math.sqrt(2 * (1 - threshold))
    width = 1.5 * distance
    p = math.erf(1.5 / math.sqrt(2))
    below, least = 0.0, 0
    while True:  # the largest count that a pair at the threshold misses rarely enough
        below += math.comb(lines, least) * p ** least * (1 - p) ** (lines - least)
        if below > miss / 2:
            return Plan(threshold, bits, tables, lines, width, least)
        least += 1


@cache
def _directions(dim: int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([20240, dim])
    return rng.standard_normal((dim, plan.lines)), rng.standard_normal((dim, plan.tables * plan.bits))


def cells(u: np.ndarray, plan: Plan) -> np.ndarray:
    """The cell of each unit vector in each table."""
    side = (u @ _directions(u.shape[1], plan)[1] > 0).reshape(len(u), plan.tables, plan.bits)
    return side @ (1 << np.arange(plan.bits, dtype=np.int64))


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """On how many lines (columns) each row of b lies in the window around each row of a."""
    count = np.zeros((len(a), len(b)), np.int16)
    for x, y in zip(a.T, b.T):
        order = np.argsort(y, kind="stable")
        line = y[order]
        lo, hi = np.searchsorted(line, x - width, "left"), np.searchsorted(line, x + width, "right")
        place = np.empty(len(y), np.int64)
        place[order] = np.arange(len(y))
        count += (place >= lo[:, None]) & (place < hi[:, None])
    return count


def links_of_block(u: np.ndarray, codes: np.ndarray, table: int, first: np.ndarray, second: np.ndarray,
                   plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) between the rows ``first`` and ``second``; i < j if both are the same rows."""
    lines = _directions(u.shape[1], plan)[0]
    found = collisions(u[first] @ lines, u[second] @ lines, plan.width) >= plan.least
    if first is second:
        found = np.triu(found, 1)
    i, j = np.nonzero(found)
    i, j = first[i], second[j]
    keep = []
    for at in range(0, len(i), 200_000):  # bounds the vectors held for verification
        a, b = i[at:at + 200_000], j[at:at + 200_000]
        ok = np.einsum("ij,ij->i", u[a], u[b]) >= plan.threshold
        for earlier in range(table):
            ok &= codes[a, earlier] != codes[b, earlier]
        keep.append(ok)
    ok = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[ok], j[ok]


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node it is linked with, directly or not."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_in_cell(plan: Plan):
    def run(cell: pa.Table) -> pa.Table:
        names, types = ["class_id", "links", "root"], [pa.int64()] * 3
        dim = cell.column("dim")[0].as_py()
        cell = cell.combine_chunks().sort_by("class_id")
        ids = cell.column("class_id").to_numpy()
        many = cell.column("copies").to_numpy()
        u = unit(matrix(cell.column("vec").combine_chunks(), dim))
        codes, table = cells(u, plan), cell.column("tab")[0].as_py()
        block, lo, hi = cell.column("block").to_numpy(), cell.column("lo")[0].as_py(), cell.column("hi")[0].as_py()
        first = np.flatnonzero(block == lo)
        second = first if lo == hi else np.flatnonzero(block == hi)
        i, j = links_of_block(u, codes, table, first, second, plan)
        links = np.bincount(i, many[j], len(ids)) + np.bincount(j, many[i], len(ids))
        root = ids[least_labels(len(ids), i, j)]
        some = links > 0
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(
            (ids[some], links[some].astype(np.int64), root[some]), types)], names)

    return run


def link_classes(classes: DataFrame, plan: Plan, block: int = BLOCK) -> DataFrame:
    """classes (class_id, copies, vec) -> stored (class_id, links, root), some rows for each linked class."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec")
            for dim, at in by_length(vec):
                code = cells(unit(matrix(vec.take(pa.array(at)), dim)), plan)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class_id").take(pa.array(at)), batch.column("copies").take(pa.array(at)),
                     vec.take(pa.array(at)), pa.array(np.full(len(at), dim), pa.int32()),
                     pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), plan.tables).cast(pa.list_(pa.int64()))],
                    ["class_id", "copies", "vec", "dim", "codes"])

    placed = stored(classes.select("class_id", "copies", "vec").mapInArrow(
        place, "class_id long, copies long, vec array<double>, dim int, codes array<long>"), "cells")
    # Cells of one vector have no pair; larger ones are cut into blocks.
    sizes = (placed.select("dim", F.posexplode("codes").alias("tab", "code")).groupBy("dim", "tab", "code").count()
             .where("count > 1").select("dim", "tab", "code", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    rows = placed.select("class_id", "copies", "vec", "dim", F.posexplode("codes").alias("tab", "code"))
    dealt = (rows.join(sizes, ["dim", "tab", "code"])
             .withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    return stored(dealt.groupBy("dim", "tab", "code", "lo", "hi").applyInArrow(
        _links_in_cell(plan), "class_id long, links long, root long"), "links")


def dedup_embeddings(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    ``n_links`` counts the other vectors with cosine of at least ``threshold``.
    Null and zero vectors, vectors with null or non-finite components and rows
    with a null id link with nothing and stand alone. Vectors of different
    length never link. Rows that repeat an id are vectors of their own that
    share a component. Other columns are not read; no rows give no rows.
    """
    vectors = keyed(rows, id_col, vec_col)
    classes = stored(vectors.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.min_by("vec", "vec_id").alias("vec")),
        "classes")
    plan = calibrate(classes.count(), threshold, miss)
    found = link_classes(classes, plan)
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("h1", "h2", "class_id", "copies").join(links, "class_id", "left")
                 .join(parts, F.col("class_id") == F.col("node"), "left")
                 .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "class_id").alias("component_id")))
    used = vectors.select("vec_id", "h1", "h2").join(per_class, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable(F.col(vec_col)) | F.col(id_col).isNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col(id_col).cast("long").alias("component_id"))
    return used.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
