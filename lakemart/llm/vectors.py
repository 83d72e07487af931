"""Arrow helpers for columns of vectors inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` in double precision for each length of vector among the usable
    rows: not null or empty, without null or non-finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    there = np.flatnonzero(np.asarray(column.is_valid()))
    column = column.take(pa.array(there))
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    values = column.flatten()
    flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    begins = np.cumsum(sizes) - sizes
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        matrix = flat[begins[rows][:, None] + np.arange(d)]
        good = np.isfinite(matrix).all(1)
        if good.any():
            yield there[rows[good]], matrix[good]


def matrix_of(column: pa.Array) -> np.ndarray:
    """The matrix of a column of vectors of one length without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
