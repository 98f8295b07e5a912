"""Line dedup on levelled sorted runs of line hashes.

Documents come in batches. A batch's line hashes are merge-anti-joined with the
runs: hashes that no run holds are new and go, sorted by hash, into a run of the
batch's own at level 0. The others are further sightings; each is found in one
run and goes to the counters. So a hash is in one run only, the one of the batch
that saw it first. When a level has ``fanout`` runs they are merged into one run
of the next level. A row is (h1, h2, docs, last): how many documents of the batch
hold the line, and the largest doc_id of them.

After the last batch runs and counters decide together: a key that at least
``min_docs`` documents hold loses all its lines except those of its largest
doc_id. Runs are tables in the shared folder, bucketed and sorted by hash, so that
neither the anti-joins nor the merges shuffle them; only a batch is shuffled, once.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import SPACES, ascii_lower, scratch_path, spread_join, stored

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
BUCKET_LINES = 1_000_000
KEY = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    """Lines between \\n; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hash(key: Column) -> Column:
    """128 bits: two hashes with different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Stored in the shared folder as a table bucketed and sorted by the hash, so that joins of runs need no shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    as_table = "llm_" + os.path.basename(path).replace("-", "_")
    (df.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).option("compression", "zstd")
     .saveAsTable(as_table))
    return spark.table(as_table)


class LineRuns:
    """The levels of runs and the counters. ``add`` takes a batch, ``merged`` gives the view over all."""

    def __init__(self, fanout: int = FANOUT, buckets: int = 8):
        self.fanout, self.buckets = fanout, buckets
        self.levels: list[list[DataFrame]] = []
        self.counters: list[DataFrame] = []

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """``lines`` (doc_id, h1, h2): each line key once for each document."""
        sightings = lines.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        own = _bucketed(sightings.repartition(self.buckets, *KEY), "batch-hashes", self.buckets)
        fresh, known = own, self._runs()
        for run in known:
            fresh = fresh.join(run.select(*KEY), KEY, "left_anti")
        self.counters += [stored(own.join(run.select(*KEY), KEY, "left_semi"), "counter") for run in known]
        self._put(0, fresh if known else own)

    def _put(self, level: int, run: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(_bucketed(run, f"run-l{level}", self.buckets))
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._compact(full))

    @staticmethod
    def _compact(runs: list[DataFrame]) -> DataFrame:
        """Runs hold different keys, so merging them side by side by key is a union in the runs' order."""
        out = runs[0]
        for run in runs[1:]:
            a, b = out.alias("a"), run.alias("b")
            out = a.join(b, KEY, "full").select(
                *KEY, *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("docs", "last")])
        return out

    def merged(self, least: int = 1) -> DataFrame:
        """(h1, h2, docs, last) of the keys that at least so many documents hold: first sightings and counters added up."""
        parts = self._runs() + self.counters
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        total = out.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        return total.where(F.col("docs") >= least)


def _document_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2): the keys of at least ``min_chars`` code points, once for each document."""
    keys = F.filter(F.transform(split_lines(F.col(text_col)), line_key),
                    lambda k: F.char_length(k) >= min_chars)
    hashes = F.array_distinct(F.transform(keys, _hash))
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.explode(hashes).alias("h"))
            .select("doc_id", "h.h1", "h.h2"))


def condemned_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                    batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, h1, h2) of the line keys that each document loses."""
    lines = stored(_document_lines(docs, id_col, text_col, min_chars)
                   .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")),
                   "lines", ["batch"])
    runs = LineRuns(fanout, max(8, -(-lines.count() // BUCKET_LINES)))
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select("doc_id", "h1", "h2"))
    heavy = stored(runs.merged(min_docs), "heavy-lines")
    return spread_join(lines.select("doc_id", *KEY), heavy, KEY, "docs").where("doc_id <> last").select("doc_id", *KEY)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with their condemned lines gone: all columns of ``docs`` plus
    ``n_lines`` (before) and ``n_dropped``, which take the place of columns so named.

    A null text stays null if nothing is dropped. Rows with a null id lose no
    line and count for none; rows that repeat an id each count as a document
    and lose the same lines. Order of lines, short lines and white space are
    kept. ``n_chars``, where there, is left to the caller.
    """
    lost = (condemned_lines(docs, id_col, text_col, **options)
            .groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost")))
    # The row as one struct: no column of the input can clash with those added here.
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    id_, text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    cut = (rows.join(lost, id_ == F.col("doc_id"), "left").select("row", "lost")
           .withColumn("lines", split_lines(text)))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("lost"), _hash(line_key(x)))))
    out = cut.withColumn("kept", kept)
    columns = [F.when(F.col("lost").isNull(), text).otherwise(F.array_join("kept", "\n")).alias(c)
               if c == text_col else F.col("row").getField(c).alias(c)
               for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))


def line_digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
