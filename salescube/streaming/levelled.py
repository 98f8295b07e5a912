"""A feed landing whose settled batches are compacted into levelled runs.

``ingest`` lands each micro-batch in ``landing/batch_id=<n>`` as before. When
batch n is there, batches below it can't be replayed any more: they are
*settled*, and go, one row a grain (the newest delivery), into a run of level
0. ``fan_in`` runs of a level become one run of the next, so each row is
rewritten once a level, a number of times that grows with the logarithm of the
batches. A commit log names the runs in force and the last settled batch.

A read merges those runs (each holds a grain at most once) and the landing
batches after the last settled one; older batch folders are pruned by name.

Runs are named after the version that brings them: a settling that died half
way is done again over its own files, and until it commits, reads see the
version before. Superseded runs stay until the folder is cleaned, so that a
reader that has begun keeps its files.

Nulls in grain columns are values of their own and equal each other. Of rows
of a grain in the same batch and file time the greatest in value stays. An
empty delivery lands nothing; reading a landing without batches gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescube.schemas import GRAIN
from salescube.streaming.feed import DELIVERED, run_feed_stream
from salescube.streaming.log import CommitLog, path_exists

BATCH = "ingested_batch"
FAN_IN = 4


def newest(rows: DataFrame) -> DataFrame:
    """One row a grain: that of the highest batch, then of the latest file, then the greatest."""
    cols = [c for c in rows.columns if c not in GRAIN]
    rest = [c for c in cols if c not in (BATCH, DELIVERED)]
    order = F.struct(BATCH, DELIVERED, *rest)
    return rows.groupBy(*GRAIN).agg(F.max(order).alias("v")).select(*GRAIN, *[f"v.{c}" for c in cols])


class LevelledLanding:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, fan_in: int = FAN_IN):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.spark, self.root, self.fan_in = spark, root, fan_in
        self.schema = T.StructType([*schema.fields, T.StructField(DELIVERED, T.TimestampType()),
                                    T.StructField(BATCH, T.LongType())])
        self.columns = schema.fieldNames()
        self.batches = f"{root}/landing"
        self.log = CommitLog(spark, f"{root}/log", "settled long, level int, run string")

    # ---- writing ----------------------------------------------------------------
    def ingest(self, source_dir: str, max_files_per_trigger: int | None = None) -> None:
        """Land what is new in `source_dir`; settle what came before it."""
        run_feed_stream(self.spark, source_dir, T.StructType([f for f in self.schema if f.name in self.columns]),
                        self.batches, f"{self.root}/checkpoint", max_files_per_trigger, after_batch=self.settle)

    def settle(self, below: int) -> None:
        """Batches under `below` that no run holds yet become a run; full levels are merged."""
        version, state = self.log.read()
        settled = state[0]["settled"] if state else -1
        if below - 1 <= settled:
            return
        version += 1
        runs = [(r["level"], r["run"]) for r in state]
        runs.append((0, self._write(newest(self._landed(settled, below)), f"v{version}-0")))
        level = 0
        while sum(lv == level for lv, _ in runs) >= self.fan_in:
            full = [run for lv, run in runs if lv == level]
            merged = self._write(newest(self._runs(full)), f"v{version}-{level + 1}")
            runs = [(lv, run) for lv, run in runs if lv != level] + [(level + 1, merged)]
            level += 1
        self.log.commit(version, [(below - 1, lv, run) for lv, run in runs])

    def _write(self, df: DataFrame, run: str) -> str:
        # In order of the grain, so that a filter by date skips row groups.
        df.sortWithinPartitions(*GRAIN).write.mode("overwrite").parquet(f"{self.root}/runs/{run}")
        return run

    # ---- reading ----------------------------------------------------------------
    def _landed(self, after: int, below: int | None = None) -> DataFrame:
        df = self._read_batches().where(F.col("batch_id") > after)
        if below is not None:
            df = df.where(F.col("batch_id") < below)
        return df.drop("batch_id")

    def _runs(self, runs: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.schema(self.schema).parquet(f"{self.root}/runs/{run}")
                                              for run in runs])

    def current(self) -> DataFrame:
        """One row a grain, with the columns of the feed."""
        _, state = self.log.read()
        rows = self._landed(state[0]["settled"] if state else -1)
        if state:
            rows = rows.unionByName(self._runs([r["run"] for r in state]))
        return newest(rows).select(*self.columns)

    def changes(self, after: int) -> DataFrame:
        """All rows that landed after batch `after`, as delivered."""
        return self._landed(after)

    def last_batch(self) -> int:
        """The highest batch landed, -1 before the first; no column of the files is read."""
        return self._read_batches().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    def _read_batches(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if not path_exists(self.spark, self.batches):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.batches)
