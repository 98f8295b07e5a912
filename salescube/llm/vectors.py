"""Shared preparation of embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors with only finite components that aren't all zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def keyed(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>, h1, h2): the usable vectors with 128 bits of hash."""
    v = F.col(vec_col).cast("array<double>")
    # -0.0 and 0.0 are one number.
    v = F.transform(v, lambda x: x + F.lit(0.0))
    return (rows.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"))
            .withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), F.col("vec"))))


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by way of their largest component so that nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def by_length(column: pa.ListArray) -> list[tuple[int, np.ndarray]]:
    """(length, positions) for each length of list in the column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return [(int(d), np.flatnonzero(lengths == d)) for d in np.unique(lengths)]
