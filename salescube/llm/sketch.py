"""Counting Bloom sketches of bounded size, merged over all tasks.

Each task counts the slots of its keys, the counts are merged chunk by chunk, and
the sketch that is broadcast has a bit for each counter. It may take a key for
counted that was not, never the other way round. There are ``COUNTERS`` counters
a key up to a bound in bytes (two bits a counter while merging); above it the
sketch clears fewer keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import releasing

COUNTERS = 12
SLOTS = 3                    # counters of a key
CHUNK = 1 << 18              # counters merged by one task
HELD = 200_000               # keys that a task counts before it hands on
MAX_SKETCH_BYTES = 64_000_000


def text_slots(h1: np.ndarray, h2: np.ndarray, counters: int) -> np.ndarray:
    """The counters of keys with these two hashes, one row a key."""
    h1, h2 = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
    k = np.arange(SLOTS, dtype=np.uint64)
    return ((h1[:, None] + k * h2[:, None]) % np.uint64(counters)).astype(np.int64)


def counters_for(keys: int, max_bytes: int = MAX_SKETCH_BYTES) -> int:
    """A power of two of at least COUNTERS for each key, as far as the bound goes (two bits each)."""
    most = 1 << (max(4 * max_bytes, CHUNK).bit_length() - 1)
    return min(most, max(CHUNK, 1 << (max(COUNTERS * keys, 1) - 1).bit_length()))


def merged_sketch(hashes: DataFrame, counters: int, least: int = 2) -> np.ndarray:
    """For each counter, packed to a bit, whether it was counted ``least`` times (up to 3) over all rows of (h1, h2).

    With 1 it is a plain Bloom filter of the keys.
    """
    @releasing()
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            at, n = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
            chunks, begin = np.unique(at // CHUNK, return_index=True)
            ends = np.append(begin, len(at)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))
                     for x in (at % CHUNK, np.minimum(n, 3))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(chunks), *lists], ["chunk", "at", "n"])

        rows = 0
        for batch in batches:
            held.append(text_slots(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), counters).ravel())
            rows += len(batch)
            if rows >= HELD:
                rows = 0
                yield flush()
        yield flush()

    def merge(parts: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for at, n in zip(parts.column("at").chunks, parts.column("n").chunks):
            total += np.bincount(at.flatten().to_numpy(), n.flatten().to_numpy(), CHUNK).astype(np.int64)
        bits = np.packbits(total >= least).tobytes()
        return pa.table({"chunk": parts.column("chunk").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    merged = (hashes.select("h1", "h2").mapInArrow(partial, "chunk long, at array<int>, n array<int>")
              .groupBy("chunk").applyInArrow(merge, "chunk long, bits binary"))
    out = np.zeros((counters // CHUNK, CHUNK // 8), np.uint8)
    for r in merged.toLocalIterator():  # at most max_sketch_bytes / 2 in all
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def possible_repeats(rows: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``rows`` with (h1, h2) and ``possible``: false for keys that certainly were not counted often enough.

    Only the hashes go to the Python worker, the other columns stay where they are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    @F.pandas_udf("boolean")
    def probe(h1: pd.Series, h2: pd.Series) -> pd.Series:
        bits = shared.value
        at = text_slots(h1.to_numpy(), h2.to_numpy(), len(bits) * 8)
        return pd.Series(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1))

    return rows.withColumn("possible", probe("h1", "h2"))
