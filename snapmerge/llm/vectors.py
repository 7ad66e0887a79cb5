"""Helpers of the vector operators: which vectors count, matrices from Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where a vector is not null and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled_down(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, x as double, as doubles that hold whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def longest(vectors: DataFrame, column: str) -> int:
    """The most components that a vector has (0: no vectors)."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as float64; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not len(column):
        return np.zeros((0, width))
    values = np.asarray(column.flatten()).astype(np.float64)
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out
