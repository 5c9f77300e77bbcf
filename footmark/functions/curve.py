"""Hilbert key of a place, as a Column: twenty steps a row, taken for a whole Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres of a cell of the curve; the curve covers 2**BITS cells a side around the origin.
CELL = 64.0
BITS = 20


def hilbert_key(x: Column, y: Column, cell: float = CELL, bits: int = BITS) -> Column:
    """Position on the Hilbert curve of the cell that holds (x, y); null for a null place.

    Places beyond the square take its border cells: the key orders rows, it decides nothing."""
    side = 1 << bits

    def cell_of(v: pa.Array) -> np.ndarray:
        # clamped as a double: a far place must not overflow; what is no number takes the last cell
        v = v.fill_null(0.0).to_numpy(zero_copy_only=False) / cell + side / 2
        return np.floor(np.maximum(np.fmin(v, side - 1.0), 0.0)).astype(np.int64)

    def key(px: pa.Array, py: pa.Array) -> pa.Array:
        at_x, at_y = cell_of(px), cell_of(py)
        d = np.zeros(len(at_x), dtype=np.int64)
        for b in range(bits - 1, -1, -1):
            right, up = (at_x >> b) & 1, (at_y >> b) & 1
            d += ((3 * right) ^ up) << (2 * b)
            mirrored = (right == 1) & (up == 0)
            fx, fy = np.where(mirrored, side - 1 - at_x, at_x), np.where(mirrored, side - 1 - at_y, at_y)
            at_x, at_y = np.where(up == 1, fx, fy), np.where(up == 1, fy, fx)
        return pa.array(d, mask=(pa.compute.is_null(px).to_numpy(zero_copy_only=False) | pa.compute.is_null(py).to_numpy(zero_copy_only=False)))
    key.__annotations__ = {"px": pa.Array, "py": pa.Array, "return": pa.Array}
    return F.arrow_udf(key, "bigint")(x.cast("double"), y.cast("double"))


def box_key(prefix: str = "") -> Column:
    """Hilbert key of the middle of a box given by the columns ``xmin``, ``ymin``, ``xmax``, ``ymax``."""
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}") for c in ("xmin", "ymin", "xmax", "ymax"))
    return hilbert_key((x0 + x1) / 2, (y0 + y1) / 2)
