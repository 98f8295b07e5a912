"""MinHash near-dedup with sequential Bayesian verification.

Signatures are cut into bands; documents that share a band are candidates. A
candidate pair's signatures are compared a batch of hashes at a time. With a
uniform prior, m matches among n hashes leave P(similarity >= t) equal to a
binomial tail; the pair is pruned as soon as that falls below the chosen miss
probability. Survivors are verified exactly on their full shingle sets.

Documents with equal shingle sets are one class. Only components are wanted, so
links are looked for in two steps:

1. Each class is paired with the smallest class of each of its buckets. That is
   linear in the bucket, and joins most groups of copies at once.
2. In buckets that still hold several components, pairs across components are
   compared, each pair in the first band it shares only. A bucket of more than
   ``BLOCK`` classes is cut into blocks by hash and every two blocks are one
   task. A task takes its survivors from the most alike down, passes over those
   that are joined by now, verifies the others on the texts it holds, and returns
   the links of a spanning forest: no link between components is lost and no
   group is paired out.

Texts are shuffled once for the classes that share a bucket with another, and
with the rows of the buckets of step 2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from salescube.llm.common import releasing, small, stored
from salescube.llm.components import connected_components

HASHES = 128
BATCH = 16
BLOCK = 512
BAND_MISS = 1e-6
PRUNE_MISS = 1e-6
KNOWN_WORDS = 200_000


@dataclass(frozen=True)
class Plan:
    """Shingles of ``words`` words; linked if 100 * intersection >= ``percent`` * union."""

    words: int = 3
    percent: int = 85
    hashes: int = HASHES

    @property
    def rows(self) -> int:
        """Most hashes a band may have for pairs at the threshold to be missed rarely enough."""
        t = self.percent / 100
        fits = [r for r in range(1, self.hashes + 1) if (1 - t ** r) ** (self.hashes // r) <= BAND_MISS]
        return max(fits, default=1)

    @property
    def bands(self) -> int:
        return self.hashes // self.rows

    def least_matches(self) -> list[int]:
        """For each number of batches compared, the fewest matches that a survivor has."""
        t, out = self.percent / 100, []
        for n in range(BATCH, self.hashes + 1, BATCH):
            tail, m = 0.0, 0
            while True:  # P(similarity >= t) given m of n is P(Binomial(n + 1, t) <= m)
                tail += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
                if tail >= PRUNE_MISS:
                    break
                m += 1
            out.append(m)
        return out


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _WordHashes()


def forget_words() -> None:
    _WORDS.clear()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of
    fewer words is one shingle; without words there is none.
    """
    # On UTF-8 bytes, lower() and split() know exactly A-Z and the six ASCII blanks.
    got = text.encode().lower().split() if text else []
    if not got:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, got), np.uint64, len(got))
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, np.uint64(size))
    for k in range(size):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k:len(w) - size + 1 + k])
    return np.unique(h)


def signature(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """The least of each hash function over the set, 32 bits of each."""
    out = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(h), 512):  # bounds the matrix for long texts
        out = np.minimum(out, (h[at:at + 512, None] * a + b).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32).tobytes()


def _functions(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(4242)
    a, b = rng.integers(0, 1 << 63, (2, hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, b


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    data = s.tobytes()
    return xxhash.xxh64_intdigest(data, 1) - (1 << 63), xxhash.xxh64_intdigest(data, 2) - (1 << 63)


def _sketches(docs: DataFrame, plan: Plan, carry: list[str]) -> DataFrame:
    """(doc_id, *carry, n, h1, h2, keys): set size, 128 bits of hash of the set, a key for each band."""
    @releasing(forget_words)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _functions(plan.hashes)
        step = 4 * plan.rows
        for batch in small(batches, "text"):
            n, hashes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, plan.words)
                sig = signature(s, a, b) if len(s) else b""
                n.append(len(s))
                hashes.append(_set_hash(s))
                keys.append([xxhash.xxh64_intdigest(sig[k * step:(k + 1) * step], k) - (1 << 63)
                             for k in range(plan.bands)] if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in own], pa.array(n, pa.int64()), pa.array([h for h, _ in hashes], pa.int64()),
                 pa.array([h for _, h in hashes], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                [*own, "n", "h1", "h2", "keys"])

    own = ["doc_id", *carry]
    schema = docs.select(*own).schema
    for c, kind in (("n", "long"), ("h1", "long"), ("h2", "long"), ("keys", ArrayType(LongType()))):
        schema = schema.add(c, kind)
    return docs.select(*own, "text").mapInArrow(run, schema)


def _candidates(docs: DataFrame, wanted: DataFrame, plan: Plan) -> DataFrame:
    """Stored (cls, n, sig, text) of the wanted classes (cls, doc_id, h1, h2), by a text of their least id each."""
    @releasing(forget_words)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _functions(plan.hashes)
        for batch in small(batches, "text"):
            n, sig, hashes = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, plan.words)
                hashes.append(_set_hash(s))
                n.append(len(s))
                sig.append(signature(s, a, b))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([h for h, _ in hashes], pa.int64()),
                 pa.array([h for _, h in hashes], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(sig, pa.binary()), batch.column("text")],
                ["doc_id", "h1", "h2", "n", "sig", "text"])

    # Rows that repeat an id may differ in text: the id finds the rows, the set's hash the class.
    rows = docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    found = rows.mapInArrow(run, "doc_id long, h1 long, h2 long, n long, sig binary, text string")
    key = ["doc_id", "h1", "h2"]
    return stored(found.dropDuplicates(key).join(wanted, key).select("cls", "n", "sig", "text"), "candidates")


def _signature_matrix(column, hashes: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, hashes)


def survivors(first: np.ndarray, second: np.ndarray, i: np.ndarray, j: np.ndarray,
              plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (first[i], second[j]) outlive all batches, and their matches."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int16)
    for k, least in enumerate(plan.least_matches()):
        part = slice(k * BATCH, (k + 1) * BATCH)
        a, b = first[:, part], second[:, part]
        for at in range(0, len(alive), 100_000):  # bounds what is compared at once
            some = alive[at:at + 100_000]
            matches[some] += (a[i[some]] == b[j[some]]).sum(axis=1, dtype=np.int16)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _verified(pairs: DataFrame, cands: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) of class ids whose full shingle sets are similar enough, stored.

    The set of ``a`` travels with the pair, the set of ``b`` meets it in a join
    whose other side has one row for each class, so a hub's set is shuffled once.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()

    @releasing(forget_words)
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text"):
            data = [shingles(t, plan.words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(data, pa.binary())], ["id", "set"])

    wanted = cands.join(ends, "cls", "left_semi").select("cls", "text")
    full = stored(wanted.mapInArrow(sets, "id long, set binary"), "shingle-sets")
    joined = (pairs.join(full.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
              .join(full.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                ok.append(similar(np.frombuffer(sa.as_buffer(), np.uint64),
                                  np.frombuffer(sb.as_buffer(), np.uint64), plan.percent))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return stored(joined.mapInArrow(check, "a long, b long"), "links")


def _star_pairs(bands: DataFrame, reps: DataFrame, plan: Plan) -> DataFrame:
    """Step 1: (a, b) with b the smallest class of a bucket of a, and Bayesian survivors only."""
    heads = bands.groupBy("band", "key").agg(F.min("cls").alias("b"), F.count("*").alias("many")).where("many > 1")
    pairs = (bands.join(heads, ["band", "key"]).where("cls <> b")
             .select(F.col("cls").alias("a"), "b").distinct())
    joined = (pairs.join(reps.select(F.col("cls").alias("a"), F.col("sig").alias("sa")), "a")
              .join(reps.select(F.col("cls").alias("b"), F.col("sig").alias("sb")), "b"))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(len(batch))
            alive, _ = survivors(_signature_matrix(batch.column("sa"), plan.hashes),
                                 _signature_matrix(batch.column("sb"), plan.hashes), at, at, plan)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return stored(joined.mapInArrow(prune, "a long, b long"), "star-pairs")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets pass 100 * intersection >= percent * union."""
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _join_components(plan: Plan):
    """Links that join the components of two blocks of a bucket."""
    def run(bucket: pa.Table) -> pa.Table:
        bucket = bucket.combine_chunks().sort_by("cls")
        cls, comp, n = (bucket.column(c).to_numpy() for c in ("cls", "comp", "n"))
        block = bucket.column("block").to_numpy()
        lo, hi, band = (bucket.column(c)[0].as_py() for c in ("lo", "hi", "band"))
        sig = _signature_matrix(bucket.column("sig"), plan.hashes)
        first = np.flatnonzero(block == lo)
        second = first if lo == hi else np.flatnonzero(block == hi)
        x, y = n[first][:, None], n[second][None, :]
        able = (comp[first][:, None] != comp[second][None, :]) & (
            100 * np.minimum(x, y) >= plan.percent * np.maximum(x, y))
        i, j = np.nonzero(np.triu(able, 1) if lo == hi else able)
        i, j = first[i], second[j]
        alive, matches = survivors(sig, sig, i, j, plan)
        i, j = i[alive], j[alive]
        new = np.ones(len(i), bool)
        for k in range(band):  # an earlier band has the pair
            part = slice(k * plan.rows, (k + 1) * plan.rows)
            new[new] = (sig[i[new], part] != sig[j[new], part]).any(axis=1)
        order = np.flatnonzero(new)[np.argsort(-matches[new], kind="stable")]
        texts, sets, links = bucket.column("text"), {}, []
        parent = {c: c for c in set(comp.tolist())}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        def full(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingles(texts[k].as_py(), plan.words)
            return sets[k]

        for p, q in zip(i[order].tolist(), j[order].tolist()):
            a, b = root(int(comp[p])), root(int(comp[q]))
            if a != b and similar(full(p), full(q), plan.percent):
                parent[a] = b
                links.append((int(cls[p]), int(cls[q])))
        return pa.Table.from_arrays([pa.array([e[k] for e in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _joining_links(bands: DataFrame, cands: DataFrame, comps: DataFrame, plan: Plan) -> DataFrame:
    """Step 2: verified links (a, b) between components that share a bucket, stored."""
    rows = (bands.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("comp", F.coalesce("component", "cls")).select("band", "key", "cls", "comp"))
    mark = F.xxhash64("cls").cast("decimal(20,0)")
    buckets = (rows.groupBy("band", "key")
               .agg(F.count("*").alias("many"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                    F.sum(mark).alias("members")).where("c0 <> c1"))
    # Of buckets of the same classes in several bands the first is enough.
    once = (buckets.groupBy("many", "members").agg(F.min(F.struct("band", "key")).alias("k"))
            .select("k.band", "k.key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks")))
    dealt = (rows.join(once, ["band", "key"]).join(cands, "cls")
             .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
             .select("band", "key", "lo", "hi", "block", "cls", "comp", "n", "sig", "text"))
    return stored(dealt.groupBy("band", "key", "lo", "hi").applyInArrow(_join_components(plan), "a long, b long"),
                  "joining-links")


def near_duplicates(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, *carry) for every row.

    Null, empty and blank texts have no shingles and link with nothing. Rows
    with a null id have a null component and are kept. Rows that repeat an id
    are documents of their own: with the same text they share a component, with
    different texts each has its text's component. A component's id is its least
    doc_id, and all of its rows of that id are kept; components whose least
    doc_id is the same share that number only. Whole texts count. Columns of
    ``carry`` come back as they are, others are not read; no rows give no rows.
    """
    carry = list(carry)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    sketches = stored(_sketches(rows, plan, carry), "sketches")
    linked = sketches.where("n > 0 and doc_id is not null")
    # A class is a distinct set under a number of its own, in the order of its least doc_id.
    classes = stored(linked.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).orderBy("doc_id", "h1", "h2")
                     .withColumn("cls", F.monotonically_increasing_id()), "classes")
    every = (linked.select("doc_id", "h1", "h2", "keys").join(classes, ["doc_id", "h1", "h2"])
             .select("cls", F.posexplode("keys").alias("band", "key")))
    # Most buckets hold one class; only the others are kept.
    shared = every.groupBy("band", "key").agg(F.min("cls").alias("c0"), F.max("cls").alias("c1")).where("c0 <> c1")
    bands = stored(every.join(shared, ["band", "key"], "left_semi").distinct(), "bands")
    reps = _candidates(rows, classes.join(bands.select("cls").distinct(), "cls", "left_semi"), plan)

    links = _verified(_star_pairs(bands, reps.select("cls", "sig"), plan), reps, plan)
    more = _joining_links(bands, reps, connected_components(links), plan)
    comps = connected_components(links.unionByName(more))
    # The first class of a component has its least doc_id.
    least = comps.join(classes.select(F.col("cls").alias("component"), F.col("doc_id").alias("least")), "component")
    named = (classes.join(least, F.col("cls") == F.col("node"), "left")
             .select("h1", "h2", F.coalesce("least", "doc_id").alias("component_id")))
    found = linked.select("doc_id", "n", "h1", "h2", *carry).join(named, ["h1", "h2"]).drop("h1", "h2")
    none = (sketches.where("n = 0 or doc_id is null")
            .select("doc_id", "n", *carry, F.col("doc_id").alias("component_id")))
    return (found.unionByName(none)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *carry))
