"""Vectors as exact integers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components beyond this saturate: sums of products of up to 2 ** 12 of them then fit in 64 bits with room.
LARGEST = 1 << 22


def whole(vector: Column) -> Column:
    """True for vectors that are not null and whose components are all finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def dimension(rows: DataFrame, id_col: str, vec_col: str) -> int:
    """The length of the vector with the smallest id, the longest of several; 0 if there is no row."""
    first = rows.orderBy(F.col(id_col).asc_nulls_last(), F.size(vec_col).desc()).select(F.size(vec_col)).first()
    return first[0] if first else 0


def integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """floor(scale * x) of a column of float vectors, as a matrix of int64."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype(np.int64)


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel(), kind))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
