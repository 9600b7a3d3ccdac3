"""Rows of a vector column as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each length of a list<double> column.

    Rows that are null or empty, or hold null or non-finite components, are in none of them.
    """
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    start = np.cumsum(length) - length
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    good = (length > 0) & (bad[start + length] == bad[start])
    for size in np.unique(length[good]):
        at = np.flatnonzero(good & (length == size))
        yield at, flat[start[at][:, None] + np.arange(size)]
