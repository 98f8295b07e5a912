"""Data-quality checks (Q1-Q5): one aggregate per table, results as rows.

Output shape of every check: ``table, check, column, failures`` (bigint),
so results of all tables union into one report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the marts' declared column tests -------------------------
NOT_NULL = {
    "dim_item": ["item_id"],
    "dim_store": ["store_id"],
    "dim_calendar": ["date"],
    "fct_sales": ["date", "store_id", "item_id", "sales"],
    "fct_prediction_accuracy": ["date", "store_id", "item_id"],
    "agg_prediction_accuracy_daily": ["date"],
}
UNIQUE = {
    "dim_item": ["item_id"],
    "dim_store": ["store_id"],
    "dim_calendar": ["date"],
    "agg_prediction_accuracy_daily": ["date"],
    "fct_sales": ["date", "store_id", "item_id"],   # composite grain (Q3)
}
# ---------------------------------------------------------------------------


def not_null_report(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Q1: NULL count per column, all columns in one pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    return agg.unpivot([], columns, "column", "failures").select(
        F.lit(table).alias("table"), F.lit("not_null").alias("check"), "column", "failures")


def unique_report(table: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Q2/Q3: number of key values occurring more than once (one row)."""
    dup = df.groupBy(*key).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(table).alias("table"), F.lit("unique").alias("check"),
        F.lit(",".join(key)).alias("column"), "failures")


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        if name in NOT_NULL:
            parts.append(not_null_report(name, df, NOT_NULL[name]))
        if name in UNIQUE:
            parts.append(unique_report(name, df, UNIQUE[name]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SALTS = 32


def write_checked(df: DataFrame, path: str, not_null: list[str], unique: list[str] | None = None) -> dict[str, int]:
    """Q1-Q3 while a table is written: one scan, counts by ``observe``, bad rows set aside.

    Rows that break no rule go to ``<path>/status=clean``, the others to
    ``status=quarantine``, both with `violations` (rule names). Of rows with the
    same key one stays clean (that of the smallest hash, ties to any, since such rows
    are alike). Returns the number of rows and of violations of each rule.

    A key that holds a third of all rows is numbered in `SALTS` shares first;
    only the first row of each share meets in one task. A null is equal to a
    null in `unique`, but breaks `not_null` first and is not counted twice.
    An empty table writes nothing and counts zeros.
    """
    broken = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in not_null]
    extra = []
    if unique:
        row = F.xxhash64(*df.columns)
        share = Window.partitionBy(*unique, "_share").orderBy("_row")
        whole = Window.partitionBy(*unique, "_rest").orderBy("_row")
        df = (df.withColumn("_row", row).withColumn("_share", F.pmod("_row", F.lit(SALTS)))
              .withColumn("_nth", F.row_number().over(share))
              .withColumn("_rest", F.when(F.col("_nth") > 1, F.col("_share") + 1).otherwise(0))
              .withColumn("_first", (F.col("_rest") == 0) & (F.row_number().over(whole) == 1)))
        complete = F.lit(True)
        for c in not_null:
            complete = complete & F.col(c).isNotNull()
        broken.append(F.when(complete & ~F.col("_first"), F.lit("unique:" + ",".join(unique))))
        extra = ["_row", "_share", "_nth", "_rest", "_first"]
    rules = [f"not_null:{c}" for c in not_null] + (["unique:" + ",".join(unique)] if unique else [])
    flagged = df.withColumn("violations", F.array_compact(F.array(*broken))).drop(*extra)
    seen = Observation()
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(F.array_contains("violations", r)).alias(r) for r in rules])
    (counted.withColumn("status", F.when(F.size("violations") > 0, "quarantine").otherwise("clean"))
     .write.mode("overwrite").partitionBy("status").parquet(path))
    return {k: int(v or 0) for k, v in seen.get.items()}


def schema_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """Q4: missing columns or type mismatches against a declared schema (driver-side
    metadata only; no data is read)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in expected.fields:
        if f.name not in have:
            out.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            out.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    return out


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> DataFrame:
    """Q4/Q5: fail fast when an extract lacks a required column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df
