"""Arrays of numbers to matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles, and which rows are whole: not null and without null or non-finite components.

    Shorter rows are filled up with zeros; rows that are not whole are zero.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    lengths = np.asarray(column.value_lengths().fill_null(0))
    width = int(lengths.max(initial=0))
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    out = np.zeros((n, width))
    if len(values) == n * width:
        out[:] = values.reshape(n, width)
    else:
        rows = np.repeat(np.arange(n), lengths)
        out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    whole = np.isfinite(out).all(1) & ~np.asarray(column.is_null())
    out[~whole] = 0
    return out, whole
