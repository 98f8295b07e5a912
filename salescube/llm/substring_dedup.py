"""Substring dedup by De Bruijn compaction.

A window is ``window`` consecutive words. Its token k-mers (a fifth as long) are the
edges of a graph; of a window's k-mers the one of least hash is its anchor, so
equal windows have equal anchors at the same place. Consecutive windows with one
anchor are a block, known by the hash of all its words, and the next block of a
document follows it in the graph. Blocks, not words, are shuffled: about one for
every twenty words, and only those whose anchor a counting sketch met twice.

* A block is known by its first occurrence, the least (document, position). In
  any other document its windows start in a smaller document and go.
* An anchor whose blocks are all the same doesn't branch. If it does, different
  blocks may still share windows: the windows of each distinct block are spelled
  out once, from its first occurrence, and compared by their hashes.
* Paths that don't branch (every occurrence of a block is followed by the same
  one, which follows no other) are compacted by joins that double the pointers.
  All occurrences of a path are whole, so those of its head stand for it: a long
  copy is one row.

Every span found so is verified by coordinates: the words are read at the span
and at its source, and their digests compared. A difference, which a collision of
hashes would make, discards the attempt and another seed is taken.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from salescube.llm.common import releasing, settled, small, spread_join
from salescube.llm.sketch import counters_for, merged_sketch, possible_repeats

WINDOW = 50
SEEDS = 4
KNOWN_WORDS = 200_000
ODD = np.uint64(0x9E3779B97F4A7C15)
ROW = ["doc_id", "t"]        # a row: its id and the hash of its text, which tells repeated ids apart


class _WordHashes(dict):
    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII blanks, in UTF-8."""
    return text.encode().split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` words, put together from runs of 1, 2, 4, ... words."""
    out, size, power = None, 0, 1
    while True:
        if n & power:
            if out is None:
                out, size = h, power
            else:
                m = len(h) - size
                out = _mix(out[:m] * ODD + h[size:]) if m > 0 else h[:0]
                size += power
        if size == n:
            return out
        m = len(h) - power
        h = _mix(h[:m] * ODD + h[power:] + np.uint64(power)) if m > 0 else h[:0]
        power *= 2


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def blocks_of(h: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, b1, b2, at, size) of the blocks of texts that lie one after the other.

    ``h`` are the hashes of their words, ``owner`` the text of each word; ``at``
    is the place of the first window, ``size`` the number of windows. First and
    last window hold every word of a block, so their hashes are its hash.
    """
    k = max(1, window // 5)
    n = len(h) - window + 1
    if n <= 0:
        return (h[:0], h[:0], h[:0], *np.empty((2, 0), np.int64))
    short = span_hashes(h, k)
    anchor = np.lib.stride_tricks.sliding_window_view(short, window - k + 1).argmin(axis=1)
    anchor += np.arange(n)
    place = np.flatnonzero(owner[:n] == owner[window - 1:])
    begins = np.ones(len(place), bool)
    begins[1:] = ((np.diff(place) != 1) | (anchor[place[1:]] != anchor[place[:-1]])
                  | (owner[place[1:]] != owner[place[:-1]]))
    at = place[begins]
    size = np.diff(np.append(np.flatnonzero(begins), len(place)))
    out = []
    for salt in (1, 2):
        w = span_hashes(_mix(h + np.uint64(salt)), window)
        out.append(_mix(_mix(w[at] * ODD + w[at + size - 1]) + size.astype(np.uint64)))
    return short[anchor[at]], out[0], out[1], at, size


def _word_hashes(texts: list, known: _WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its text, where each text's words begin) of texts one after the other."""
    words = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    return h, np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes) - sizes


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t, text) of the rows with an id."""
    return docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))


def _occurrences(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """Every block of every row, with the next block's and the one before's first hash."""
    @releasing()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes(seed)
        for batch in small(batches, "text"):
            h, owner, begin = _word_hashes(batch.column("text").to_pylist(), known)
            v, b1, b2, at, size = blocks_of(h, owner, window)
            if not len(at):
                continue
            which = owner[at]
            first = np.diff(which, prepend=-1) != 0
            i, v, b1, b2, at = pa.array(which), _signed(v), _signed(b1), _signed(b2), at - begin[which]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(i), batch.column("t").take(i), pa.array(v), pa.array(b1), pa.array(b2),
                 pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.array(np.roll(b1, -1), mask=np.roll(first, -1)), pa.array(np.roll(b1, 1), mask=first)],
                ["doc_id", "t", "v", "b1", "b2", "at", "size", "after", "prior"])

    every = settled(rows.mapInArrow(
        run, "doc_id long, t long, v long, b1 long, b2 long, at int, size int, after long, prior long"), "substring-anchors")
    # Anchors that were met once in the whole table have nothing in common with any other text.
    keyed = every.withColumn("h1", F.col("v")).withColumn("h2", F.xxhash64("v"))
    sketch = merged_sketch(keyed, counters_for(every.count()))
    return settled(possible_repeats(keyed, sketch).where("possible").drop("h1", "h2", "possible"), "substring-blocks")


def _first_places(occurrences: DataFrame) -> DataFrame:
    """The distinct blocks with their first occurrence, largest document, neighbours and a number."""
    # Beside null, the end of a text, no neighbour is 0: one of that hash would only end a path.
    after, prior = F.coalesce("after", F.lit(0)), F.coalesce("prior", F.lit(0))
    return settled(
        occurrences.groupBy("v", "b1", "b2").agg(
            F.min(F.struct("doc_id", "t", "at", "size")).alias("src"), F.max("doc_id").alias("last"),
            F.count("*").alias("n"), F.min(after).alias("after"), F.max(after).alias("after_high"),
            F.min(prior).alias("prior"), F.max(prior).alias("prior_high"))
        .select("v", "b1", "b2", "src.*", "last", "n", "after", "prior",
                F.expr("after = after_high AND after <> 0").alias("one_after"),
                F.expr("prior = prior_high AND prior <> 0").alias("one_prior"),
                F.monotonically_increasing_id().alias("node")), "substring-distinct")


def compact_paths(repeated: DataFrame) -> DataFrame:
    """(head node, windows): the paths that don't branch, of blocks that several documents hold.

    A path's blocks lie one after the other in the document where each of them
    occurs first. Pointers to the block before are doubled by joins until all
    point to heads; those that do take no further part but as targets.
    """
    left = repeated.where("one_after").select(
        F.col("node").alias("to"), F.col("b1").alias("prior"), F.col("after").alias("b1"), "doc_id", "t",
        (F.col("at") + F.col("size")).alias("at"))
    links = repeated.where("one_prior").join(left, ["b1", "prior", "doc_id", "t", "at"])
    state = settled(links.select("node", "to", F.lit(False).alias("ends")), "substring-links")
    while not (active := state.where("NOT ends")).isEmpty():
        over = state.select(F.col("node").alias("to"), F.col("to").alias("on"), F.col("ends").alias("on_ends"))
        jumped = active.join(over, "to", "left").select(
            "node", F.coalesce("on", "to").alias("to"), F.coalesce("on_ends", F.lit(True)).alias("ends"))
        state = settled(state.where("ends").unionByName(jumped), "substring-jumps")
    heads = repeated.select("node", "size").join(state.select("node", "to"), "node", "left")
    return heads.groupBy(F.coalesce("to", "node").alias("node")).agg(F.sum("size").cast("int").alias("windows"))


def rows_with(rows: DataFrame, keys: DataFrame, others: bool = False) -> DataFrame:
    """The rows (doc_id, t, ...) that may be in ``keys`` by a Bloom filter, or the others, which certainly are not."""
    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("h1", F.xxhash64(*ROW)).withColumn("h2", F.xxhash64(F.lit(1), *ROW))

    sketch = merged_sketch(hashed(keys), counters_for(keys.count()), least=1)
    may = F.col("possible") & F.col("doc_id").isNotNull()
    return possible_repeats(hashed(rows), sketch).where(~may | may.isNull() if others else may).drop("h1", "h2", "possible")


def _spelled_windows(rows: DataFrame, blocks: DataFrame, window: int, seed: int) -> DataFrame:
    """(w1, w2, node, off, doc_id, t, at) of every window of these blocks, at their first occurrence."""
    @releasing()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes(seed)
        for batch in small(batches, "text", 500_000):
            h, _, begin = _word_hashes(batch.column("text").to_pylist(), known)
            asked = batch.column("asked")
            i = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy())
            own = asked.flatten()
            at, size, node = (own.field(c).to_numpy() for c in ("at", "size", "node"))
            w1, w2 = (_signed(span_hashes(_mix(h + np.uint64(salt)), window)) for salt in (1, 2))
            off = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i, node = np.repeat(i, size), np.repeat(node, size)
            at = np.repeat(at, size) + off
            w1, w2, i = w1[begin[i] + at], w2[begin[i] + at], pa.array(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1), pa.array(w2), pa.array(node), pa.array(off.astype(np.int32)),
                 batch.column("doc_id").take(i), batch.column("t").take(i), pa.array(at.astype(np.int32))],
                ["w1", "w2", "node", "off", "doc_id", "t", "at"])

    asked = blocks.groupBy(*ROW).agg(F.collect_list(F.struct("at", "size", "node")).alias("asked"))
    asked = settled(asked, "substring-asked")
    return settled(rows_with(rows, asked).join(asked, ROW).dropDuplicates(ROW).mapInArrow(
        run, "w1 long, w2 long, node long, off int, doc_id long, t long, at int"), "substring-windows")


def repeated_spans(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """(doc_id, t, at, windows, src_doc, src_t, src_at): windows that start in a smaller document, by their hashes."""
    occurrences = _occurrences(rows, window, seed)
    first = _first_places(occurrences)
    source = [F.col("doc_id").alias("src_doc"), F.col("t").alias("src_t"), F.col("at").alias("src_at")]

    repeated = first.where("doc_id < last")
    heads = settled(repeated.join(compact_paths(repeated), "node").select("b1", "b2", "n", "windows", *source),
                   "substring-heads")
    places = occurrences.select("b1", "b2", *ROW, "at")
    spans = spread_join(places, heads, ["b1", "b2"], "n").where("doc_id > src_doc")

    ways = (first.groupBy("v").agg(F.count("*").alias("ways"), F.min("doc_id").alias("low"), F.max("last").alias("high"))
            .where("ways > 1 AND low < high").select("v", "ways"))
    branching = spread_join(first, ways, ["v"], "ways").select(*ROW, "at", "size", "node")
    windows = _spelled_windows(rows, branching, window, seed)
    lowest = (windows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "t", "at")).alias("s"),
                                              F.max("doc_id").alias("high"), F.count("*").alias("n"))
              .where("s.doc_id < high")
              .select("w1", "w2", "n", F.col("s.doc_id").alias("src_doc"), F.col("s.t").alias("src_t"),
                      F.col("s.at").alias("src_at")))
    hits = settled(spread_join(windows, lowest, ["w1", "w2"], "n").where("doc_id > src_doc")
                  .select("node", "off", "src_doc", "src_t", "src_at"), "substring-hits")
    # A block may lie several times in its first document; the others lose all its windows anyway.
    own = first.join(hits.select("node").distinct(), "node").select("b1", "b2", "doc_id", "node", "n")
    again = spread_join(places, own, ["b1", "b2", "doc_id"], "n").select("node", *ROW, F.col("at").alias("begin"))
    single = again.join(hits, "node").select(
        *ROW, (F.col("begin") + F.col("off")).alias("at"), F.lit(1).alias("windows"), "src_doc", "src_t", "src_at")
    return settled(spans.select(*single.columns).unionByName(single), "substring-spans")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _cut(docs: DataFrame, spans: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Every row of ``docs`` as ``row`` with its words left, what is removed, and digests of its spans and sources."""
    @releasing()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text"):
            n, gone, kept, removed, checks = [], [], [], [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                words = words_of(text)
                if not places:
                    n.append(len(words))
                    gone.append(0)
                    kept.append(None if text is None else b" ".join(words).decode())
                    removed.append([])
                    checks.append([])
                    continue
                drop = np.zeros(len(words) + 1, np.int64)
                seen = []
                for p in places:
                    end = p["at"] + p["windows"] + window - 1
                    seen.append({"span": p["span"], "digest": _digest(words[p["at"]:end])})
                    if p["own"]:
                        drop[p["at"]] += 1
                        drop[end] -= 1
                lost = np.cumsum(drop)[:-1] > 0
                edges = np.flatnonzero(np.diff(lost, prepend=False, append=False))
                n.append(len(words))
                gone.append(int(lost.sum()))
                removed.append([{"begin": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                left = [w for w, x in zip(words, lost.tolist()) if not x] if gone[-1] else words
                kept.append(None if text is None else b" ".join(left).decode())
                checks.append(seen)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(removed, batch_types[0]), pa.array(checks, batch_types[1])],
                ["row", "n_words", "n_removed", "kept", "removed", "checks"])

    batch_types = (pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
                   pa.list_(pa.struct([("span", pa.int64()), ("digest", pa.binary())])))
    # A span and its source are checked by what they have in common: the source and the length.
    span = F.xxhash64("src_doc", "src_t", "src_at", "windows")
    own = spans.select(*ROW, "at", "windows", span.alias("span"), F.lit(True).alias("own"))
    sources = spans.select(F.col("src_doc").alias("doc_id"), F.col("src_t").alias("t"), F.col("src_at").alias("at"),
                           "windows", span.alias("span"), F.lit(False).alias("own")).distinct()
    places = settled(own.unionByName(sources).groupBy(*ROW).agg(
        F.collect_list(F.struct("at", "windows", "span", "own")).alias("places")), "substring-places")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    # Only rows that may have a place are shuffled to meet it.
    joined = (rows_with(rows, places).join(places, ROW, "left").select("row", "text", "places")
              .unionByName(rows_with(rows, places, others=True).select("row", "text", F.lit(None).cast(
                  places.schema["places"].dataType).alias("places"))))
    schema = joined.select("row").schema
    for c, kind in (("n_words", "long"), ("n_removed", "long"), ("kept", "string")):
        schema = schema.add(c, kind)
    schema = (schema.add("removed", ArrayType(StructType().add("begin", "long").add("end", "long")))
              .add("checks", ArrayType(StructType().add("span", "long").add("digest", "binary"))))
    return settled(joined.mapInArrow(run, schema), "substring-result")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs``, the text as its words left, joined by a blank, with ``n_words``,
    ``n_removed`` and ``removed`` (the places of the removed runs of words, begin and end).

    A word goes if a window that covers it also starts in a row of a smaller id;
    windows are judged on the input. A null text stays null and has no words;
    texts of fewer words than a window lose none. Rows with a null id lose
    nothing and no row loses anything because of them; rows that repeat an id
    lose nothing because of each other. Columns named as the new ones are
    replaced. An empty table stays empty.
    """
    rows = _rows(docs, id_col, text_col)
    for seed in range(SEEDS):
        result = _cut(docs, repeated_spans(rows, window, seed), window, id_col, text_col)
        seen = result.select(F.explode("checks").alias("c")).groupBy("c.span").agg(
            F.min("c.digest").alias("low"), F.max("c.digest").alias("high"))
        if seen.where("low <> high").isEmpty():
            break
    else:
        raise RuntimeError("spans differ from their sources under every seed")
    new = ["n_words", "n_removed", "removed"]
    columns = [F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
               for c in docs.columns if c not in new]
    return result.select(*columns, *new)


def substring_digest(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
