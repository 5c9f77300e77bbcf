"""The county index's cells: a quadtree-like cover of each county on several grid levels.

A cell of level l is a square of ``base * 4**l`` metres. What is classified is the square of twice
that size from the same lower left corner, since a feature no larger than the cell whose lower left
corner lies in the cell is within it. Such a square is inside the county (the cell is a leaf), outside
(no cell) or crossed by the county line. Crossed cells are divided down to level 0; there they keep the
few boundary edges that cross them and whether their corner is inside, which is all that an exact test
of a small feature needs: a point is inside if the way to it from the corner, up and then across,
meets an odd number of edges. Grid lines are shifted off round coordinates, where county corners tend to be.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions import kernels as K
from ..functions import wkb as W

FACTOR = 4
#: Grid shifts in x and y as parts of the base cell, and slack around a square as a part of its cell.
SHIFT_X, SHIFT_Y, SLACK = 0.3819660112501051, 0.2360679774997897, 1e-6
CELL = "fips string, lvl int, cx long, cy long, inside boolean, edges binary, corner boolean"


def _orient(e: np.ndarray, px, py) -> np.ndarray:
    """Positive where the point lies left of the edge."""
    return (e[..., 2] - e[..., 0]) * (py - e[..., 1]) - (e[..., 3] - e[..., 1]) * (px - e[..., 0])


def _side(e: np.ndarray, px, py) -> np.ndarray:
    """``_orient`` that is never 0: on the edge's line the point counts as moved a little to the right,
    and less upward. So a point has one side of every edge, in whichever test."""
    o = _orient(e, px, py)
    dx, dy = e[..., 2] - e[..., 0], e[..., 3] - e[..., 1]
    return np.where(o != 0, o, np.where(dy != 0, -dy, dx))


def inside_ring(edges: np.ndarray, px: np.ndarray, py: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Even-odd rule for points against all edges."""
    out = np.zeros(len(px), dtype=bool)
    step = max(1, block // max(1, len(edges)))
    for a in range(0, len(px), step):
        x, y = px[a:a + step, None], py[a:a + step, None]
        spans = (edges[:, 1] > y) != (edges[:, 3] > y)
        side = _side(edges, x, y)
        right = np.where(edges[:, 3] > edges[:, 1], side > 0, side < 0)   # the edge is crossed to the right of the point
        out[a:a + step] = (spans & right).sum(axis=1) % 2 == 1
    return out


def _meets(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Edges that touch a box: boxes overlap, and the corners aren't all on one side of the edge."""
    near = (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0) & \
        (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0)
    sides = np.stack([_orient(e, x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    return near & ~((sides > 0).all(axis=0) | (sides < 0).all(axis=0))


def county_cells(edges: np.ndarray, base: float, top: int) -> list[tuple]:
    """(lvl, cx, cy, inside, edges or None, corner or None) of one county with these edges (n x 4)."""
    shift_x, shift_y = SHIFT_X * base, SHIFT_Y * base
    size = base * FACTOR ** top
    low, high = edges.reshape(-1, 2).min(axis=0), edges.reshape(-1, 2).max(axis=0)
    shift = np.array([shift_x, shift_y])
    first = np.floor((low - shift) / size).astype(int) - 2
    last = np.floor((high - shift) / size).astype(int)
    every = np.arange(len(edges))
    nodes = [(cx, cy, every) for cx in range(first[0], last[0] + 1) for cy in range(first[1], last[1] + 1)]
    out = []
    for lvl in range(top, -1, -1):
        size = base * FACTOR ** lvl
        slack = SLACK * size
        corner_x = np.array([shift_x + n[0] * size - slack for n in nodes])
        corner_y = np.array([shift_y + n[1] * size - slack for n in nodes])
        corner = inside_ring(edges, corner_x, corner_y)
        below = []
        for (cx, cy, some), x0, y0, within in zip(nodes, corner_x, corner_y, corner.tolist()):
            some = some[_meets(edges[some], x0, y0, x0 + 2 * (size + slack), y0 + 2 * (size + slack))]
            if not len(some):
                if within:
                    out.append((lvl, cx, cy, True, None, None))
                continue
            out.append((lvl, cx, cy, False, edges[some].tobytes() if lvl == 0 else None, within if lvl == 0 else None))
            if lvl:
                below += [(cx * FACTOR + i, cy * FACTOR + j, some) for i in range(FACTOR) for j in range(FACTOR)]
        nodes = below
    return out


def cell_batches(batches, base: float, top: int):
    """Rows (fips, geometry) to cells; a county without area edges has none."""
    for batch in batches:
        x1, y1, x2, y2, _, off = K._area_edges(W.decode(batch.column(1)))
        edges = np.stack([x1, y1, x2, y2], axis=1)
        for i, fips in enumerate(batch.column(0).to_pylist()):
            if off[i + 1] > off[i]:
                cells = list(zip(*county_cells(edges[off[i]:off[i + 1]], base, top)))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_())
                yield pa.record_batch([pa.array([fips] * len(cells[0])), *[pa.array(c, k) for c, k in zip(cells, kinds)]],
                                      names=["fips", "lvl", "cx", "cy", "inside", "edges", "corner"])


def _local_hit(geometry: pa.Array, edges: pa.Array, cx: pa.Array, cy: pa.Array, corner: pa.Array, base: pa.Array) -> pa.Array:
    g = W.decode(geometry)
    held = edges.to_pylist()
    size = base.to_numpy(zero_copy_only=False)
    x0 = SHIFT_X * size + cx.fill_null(0).to_numpy(zero_copy_only=False) * size - SLACK * size
    y0 = SHIFT_Y * size + cy.fill_null(0).to_numpy(zero_copy_only=False) * size - SLACK * size
    flag = corner.fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
    count = np.array([len(b) // 32 if b else 0 for b in held], dtype=np.int64)
    e = np.frombuffer(b"".join(b for b in held if b), dtype=np.float64).reshape(-1, 4)
    off = np.concatenate([[0], np.cumsum(count)])
    hit = np.zeros(g.n, dtype=bool)
    known = g.valid & (count > 0)
    # vertices of the feature inside the county, or on its line
    px, py, poff = K.points_of(g)
    n_pts = np.where(known, np.diff(poff), 0)
    crossed, begin = np.zeros(int(n_pts.sum()), dtype=np.int64), np.cumsum(n_pts) - n_pts
    for row, i, j in K._pair_product(n_pts, count):
        x, y, s = px[poff[row] + i], py[poff[row] + i], e[off[row] + j]
        a, b = x0[row], y0[row]
        at_point, at_turn, at_corner = _orient(s, x, y), _side(s, a, y), _side(s, a, b)
        up, right = s[:, 3] > s[:, 1], s[:, 2] > s[:, 0]
        on = (at_point == 0) & (np.minimum(s[:, 0], s[:, 2]) <= x) & (x <= np.maximum(s[:, 0], s[:, 2])) & \
            (np.minimum(s[:, 1], s[:, 3]) <= y) & (y <= np.maximum(s[:, 1], s[:, 3]))
        hit[row[on]] = True
        across = ((s[:, 1] > y) != (s[:, 3] > y)) & np.where(up, (at_turn > 0) & (at_point < 0), (at_turn < 0) & (at_point > 0))
        upward = ((s[:, 0] > a) != (s[:, 2] > a)) & np.where(right, (at_corner < 0) & (at_turn > 0), (at_corner > 0) & (at_turn < 0))
        np.add.at(crossed, begin[row] + i, across.astype(np.int64) + upward)
    inside = flag[np.repeat(np.arange(g.n), n_pts)] ^ (crossed % 2 == 1)
    hit[np.repeat(np.arange(g.n), n_pts)[inside]] = True
    # edges of the feature that cross the county line
    ax, ay, bx, by, _, soff = K._segments(g)
    n_seg = np.where(known & ~hit, np.diff(soff), 0)
    for row, i, j in K._pair_product(n_seg, np.where(known & ~hit, count, 0)):
        k, s = soff[row] + i, e[off[row] + j]
        cross = K._seg_intersects(ax[k], ay[k], bx[k], by[k], s[:, 0], s[:, 1], s[:, 2], s[:, 3])
        hit[row[cross]] = True
    # a ring of the county inside the feature
    fx1, fy1, fx2, fy2, _, foff = K._area_edges(g)
    for row in np.flatnonzero(known & ~hit & (np.diff(foff) > 0)):
        own = np.stack([z[foff[row]:foff[row + 1]] for z in (fx1, fy1, fx2, fy2)], axis=1)
        s = e[off[row]:off[row + 1]]
        low, high = own.reshape(-1, 2).min(axis=0), own.reshape(-1, 2).max(axis=0)
        s = s[(s[:, :2] >= low).all(axis=1) & (s[:, :2] <= high).all(axis=1)]
        hit[row] = bool(len(s)) and bool(inside_ring(own, s[:, 0], s[:, 1]).any())
    return pa.array(hit, mask=~known)


# Whether a feature touches the county of a crossed level-0 cell, from that cell's edges alone; null
# without a geometry or edges.
local_hit = arrow_udf(_local_hit, T.BooleanType())
