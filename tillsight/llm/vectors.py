"""Rows of vectors as whole numbers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written


def _whole(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (
        F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def quantised(rows: DataFrame, scale: int, vector: str = "embedding", *kept: Column) -> tuple[DataFrame, int]:
    """The kept columns and ``x``, floor(scale * entry) as long, of rows with a whole vector, written,
    and the vectors' length.

    Where lengths differ, rows of the most frequent length are kept, the longer of equally frequent ones.
    """
    x = F.transform(vector, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("x")
    table = written(rows.where(_whole(F.col(vector))).select(*kept, x), "vectors")
    sizes = table.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return table, 0
    return table.where(F.size("x") == sizes[0]["size"]), sizes[0]["size"]


def matrix(column: pa.ListArray, length: int) -> np.ndarray:
    """The vectors of a batch as rows (int64)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right, exact: by floats or longs where these hold every sum, else by Python's numbers."""
    if not left.size or not right.size:
        return np.zeros((left.shape[0], right.shape[1]), dtype=np.int64)
    most = max(abs(int(left.min())), abs(int(left.max()))) * max(abs(int(right.min())), abs(int(right.max()))) * left.shape[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left @ right if most < 1 << 62 else left.astype(object) @ right.astype(object)
