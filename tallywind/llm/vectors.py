"""Vectors with integer components, and how they travel as Arrow lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integers below this keep a product of two of them, summed over thousands of components, exact in 64 bits.
MOST = 1 << 24


def finite(vector: Column) -> Column:
    """Whether a vector is there and has no null, NaN or infinite component."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component; a magnitude of 2**24 or more has no exact result and raises an error."""
    floors = F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(factor)) * x))
    too_large = F.exists(vector.cast("array<double>"), lambda x: F.abs(F.lit(float(factor)) * x) >= F.lit(float(MOST)))
    return F.when(too_large, F.raise_error(F.lit(f"a component times {factor} reaches 2**24"))).otherwise(floors.cast("array<int>"))


def rows_of(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a list column, which may differ in length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
    return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def matrix_of(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors of a list column as rows of a matrix, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    width = width or (int(lengths.max()) if len(lengths) else 0)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=flat.dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.array(matrix.reshape(-1)).cast(kind))


def chunks(n: int, size: int) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))
