"""Vectors of an Arrow list column as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each length of vector; rows that are null, empty or
    hold null or non-finite components are left out."""
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lens)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = (lens > 0) & (bad[ends] == bad[ends - lens])
    for d in np.unique(lens[fine]):
        rows = np.flatnonzero(fine & (lens == d))
        yield rows, values[(ends - lens)[rows][:, None] + np.arange(d)]


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of finite non-zero vectors divided by their lengths.

    A row is first brought to a largest component of 0.5 to 1 by a power of two, which changes no
    digit, so that squares of very large or very small components neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(m).max(axis=1))
    near = np.ldexp(m, -exponent[:, None])
    return near / np.linalg.norm(near, axis=1)[:, None]
