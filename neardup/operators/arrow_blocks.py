"""Small helpers shared by the Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """``[n, D]`` float64 matrix of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, dim or 0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    width = dim if dim is not None else len(column[0])
    if len(values) != n * width or np.any(column.value_lengths().to_numpy() != width):
        raise ValueError(f"vectors of different dimensions in one block (expected {width})")
    return values.reshape(n, width)
