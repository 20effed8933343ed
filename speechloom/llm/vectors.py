"""What both vector operators need: usable vectors, bounded samples, Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding``, one row per id, without null or zero vectors and those with null or
    non-finite components; of an id with several vectors the smallest counts."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    plain = vectors.select(F.col("vec_id").cast("bigint"), x).filter(
        F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0))
    return plain.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def dimension(vectors: DataFrame) -> int:
    """The commonest number of components (the smaller of two); 0 without vectors."""
    sizes = vectors.groupBy(F.size("embedding").alias("d")).count()
    found = sizes.orderBy(F.desc("count"), "d").first()
    return found["d"] if found else 0


def sample(vectors: DataFrame, most: int) -> np.ndarray:
    """Different vectors among the ``most`` with the smallest hashes of their id, as a matrix of doubles."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("embedding").limit(most).collect()
    x = np.array([r["embedding"] for r in rows], np.float64)
    _, at = np.unique(x, axis=0, return_index=True)
    return x[np.sort(at)]


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
