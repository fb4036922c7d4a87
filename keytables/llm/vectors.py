"""Vectors in Spark arrays: which of them count, and numpy matrices of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytables.llm.sampling import drawn


def usable(vector: Column) -> Column:
    """Not null, not all zero, and without null or non-finite components."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def dimension(vectors: DataFrame, column: str = "embedding") -> int:
    """The commonest number of components of usable vectors, the smallest of equally common; 0 if there is none."""
    sizes = vectors.where(usable(F.col(column))).groupBy(F.size(column).alias("d")).count()
    found = sizes.orderBy(F.desc("count"), "d").first()
    return found["d"] if found else 0


def comparable(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """The rows whose vector is usable and has ``dim`` components."""
    return vectors.where(usable(F.col(column)) & (F.size(column) == dim))


def sample_matrix(vectors: DataFrame, rows: int, key: str, column: str = "embedding") -> np.ndarray:
    """About ``rows`` vectors, never over twice as many, chosen by a hash of ``key``; all of them if there are fewer."""
    total = vectors.count()
    chosen = vectors
    if total > rows:
        chosen = vectors.where(drawn(rows, total, F.col(key), F.lit("sample")))
    found = chosen.select(key, F.col(column).cast("array<double>").alias(column)).orderBy(key).limit(2 * rows).toArrow()
    return matrix(found[column].combine_chunks()) if found.num_rows else np.empty((0, 0))


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """The rows of an Arrow array of lists of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0), dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)
