"""Vector columns in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def rows_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat components as double, start, length) of a list column; rows that are NULL, empty or hold a NULL or
    non-finite component get length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(col.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    size = np.where(bad[start + size] > bad[start], 0, size)
    return flat, start, size


def by_dimension(col: pa.Array):
    """(row numbers, matrix of doubles) for each dimension among the usable rows of a list column."""
    flat, start, size = rows_of(col)
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        yield rows, flat[start[rows][:, None] + np.arange(d)]
