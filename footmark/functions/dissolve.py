"""The trapezoids of an overlay joined into valid polygons (numpy only, all pairs of a batch at once).

The trapezoids of a pair lie in horizontal slabs. Their corners become nodes, numbered along each
slab line, so that a horizontal side is a run of node numbers. Sides that two trapezoids share
cancel; what is left is directed with the inside on its left. At a node each incoming side goes on
with the first outgoing side across the inside, which gives closed chains; a chain that visits a
node twice is cut there. Trapezoids that share a side are one polygon: its one counter-clockwise
ring is the shell, the others are holes.
"""

from __future__ import annotations

import numpy as np

#: Corners of one slab line closer than this share of the pair's extent are one node.
SNAP = 1e-9


def dissolve(owner: np.ndarray, quads: np.ndarray, sides: np.ndarray):
    """Polygons of the trapezoids of each owner: (xy, ring offsets, owner of each ring, polygon of each ring).

    ``quads``: x of the left and right corner at the bottom, the same at the top, y of the bottom and
    of the top. ``sides``: number of the edge on the left and on the right (points along one edge go).
    Rings are closed, sorted by owner and polygon, the shell (counter-clockwise) before its holes."""
    m = len(owner)
    if m == 0:
        return np.zeros((0, 2)), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    corner, nx, ny = _nodes(owner, quads)
    n = len(nx)
    b0, t0 = corner[0], corner[2]
    b1, t1 = np.maximum(corner[1], b0), np.maximum(corner[3], t0)  # (rounding may swap two corners)

    # horizontal sides, in steps from one node to the next
    over, step_o = _steps(b0, b1)
    under, step_u = _steps(t0, t1)
    above, below = np.full(n, -1), np.full(n, -1)
    above[step_o], below[step_u] = over, under
    both = np.flatnonzero((above >= 0) & (below >= 0))
    net = np.bincount(step_o, minlength=n) - np.bincount(step_u, minlength=n)
    flat = np.repeat(np.arange(n), np.abs(net))
    right = net[flat] > 0
    h_from, h_to = np.where(right, flat, flat + 1), np.where(right, flat + 1, flat)
    h_face = np.where(right, above[flat], below[flat])

    # slanted sides: down on the left, up on the right
    lo, hi = np.r_[b0, b1], np.r_[t0, t1]
    sign = np.repeat([-1, 1], m)
    face, edge = np.tile(np.arange(m), 2), np.r_[sides[:, 0], sides[:, 1]]
    o = np.lexsort((hi, lo))
    lo, hi, sign, face, edge = lo[o], hi[o], sign[o], face[o], edge[o]
    same = (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1])
    first = np.flatnonzero(np.r_[True, ~same])
    total = np.add.reduceat(sign, first)
    kept = np.repeat(first, np.abs(total))
    up = np.repeat(total > 0, np.abs(total))

    root = _groups(m, np.r_[above[both], face[:-1][same]], np.r_[below[both], face[1:][same]])
    src = np.r_[h_from, np.where(up, lo[kept], hi[kept])]
    dst = np.r_[h_to, np.where(up, hi[kept], lo[kept])]
    tag = np.r_[np.full(len(flat), -1), edge[kept]]
    poly = root[np.r_[h_face, face[kept]]]
    if not len(src):
        return dissolve(owner[:0], quads[:0], sides[:0])

    order, ring = _chains(_following(src, dst, nx, ny), src)
    src, tag, poly = src[order], tag[order], poly[order]
    first = np.r_[True, ring[1:] != ring[:-1]]
    before = np.arange(-1, len(ring) - 1)
    before[first] = np.r_[np.flatnonzero(first)[1:], len(ring)] - 1
    turns = tag != tag[before]  # a node within one edge, or within a horizontal side, is no corner
    src, ring, poly = src[turns], ring[turns], poly[turns]
    return _polygons(owner, nx[src], ny[src], ring, poly)


def _nodes(owner, quads):
    """Node of each corner (4 x m: bottom left, bottom right, top left, top right), and the nodes' x and y."""
    m = len(owner)
    x, y = quads[:, :4].T.ravel(), np.r_[quads[:, 4], quads[:, 4], quads[:, 5], quads[:, 5]]
    who = np.tile(owner, 4)
    extent = np.zeros(int(owner.max()) + 1)
    np.maximum.at(extent, who, np.maximum(np.abs(x), np.abs(y)))
    o = np.lexsort((x, y, who))
    xs, ys, ws = x[o], y[o], who[o]
    new = np.r_[True, (ws[1:] != ws[:-1]) | (ys[1:] != ys[:-1]) | (xs[1:] - xs[:-1] > SNAP * extent[ws[1:]])]
    node = np.empty(4 * m, np.int64)
    node[o] = np.cumsum(new) - 1
    return node.reshape(4, m), xs[new], ys[new]


def _steps(lo, hi):
    """(row, number) for each number from ``lo`` up to ``hi`` of each row."""
    n = hi - lo
    row = np.repeat(np.arange(len(n)), n)
    return row, lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _groups(n, a, b):
    """Smallest member of the group of each of ``n`` items that the links a-b connect."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]


def _following(src, dst, nx, ny):
    """The side that follows each side."""
    e = len(src)
    follow = np.empty(e, np.int64)
    follow[np.argsort(dst, kind="stable")] = np.argsort(src, kind="stable")  # as many come as go
    if (np.bincount(src) <= 1).all():
        return follow
    # nodes of several sides: around the node, the side before (clockwise) an incoming one is its next
    node, far, out = np.r_[src, dst], np.r_[dst, src], np.repeat([True, False], e)
    busy = np.flatnonzero(np.bincount(node, minlength=len(nx))[node] > 2)
    angle = np.arctan2(ny[far[busy]] - ny[node[busy]], nx[far[busy]] - nx[node[busy]])
    o = busy[np.lexsort((angle, node[busy]))]
    first = np.r_[True, node[o[1:]] != node[o[:-1]]]
    before = np.arange(-1, len(o) - 1)
    before[first] = np.r_[np.flatnonzero(first)[1:], len(o)] - 1
    turn = ~out[o] & out[o[before]]
    wrong = np.zeros(len(nx), bool)  # (rounding) the sides don't alternate: any pairing stays closed
    wrong[node[o[~out[o] & ~out[o[before]]]]] = True
    turn &= ~wrong[node[o]]
    follow[o[turn] - e] = o[before][turn]
    return follow


def _chains(follow, src):
    """Sides in the order of their rings, and the ring of each; no ring visits a node twice."""
    e = len(follow)
    label, jump = np.arange(e), follow
    for _ in range(e.bit_length()):
        label, jump = np.minimum(label, label[jump]), jump[jump]
    left = np.where(follow == label, 0, 1)  # sides to go until the ring closes
    jump = np.where(follow == label, np.arange(e), follow)
    for _ in range(e.bit_length()):
        left, jump = left + left[jump], jump[jump]
    order = np.lexsort((-left, label))
    ring = label[order]
    o = np.lexsort((src[order], ring))
    twice = (ring[o][1:] == ring[o][:-1]) & (src[order][o][1:] == src[order][o][:-1])
    if not twice.any():
        return order, ring
    names = e
    ring = ring.copy()
    for r in np.unique(ring[o][1:][twice]):
        path, place = [], {}
        for at in np.flatnonzero(label[order] == r):
            here = src[order[at]]
            if here in place:
                loop = path[place[here]:]
                del path[place[here]:]
                for p in loop:
                    del place[src[order[p]]]
                ring[loop], names = names, names + 1
            place[here] = len(path)
            path.append(at)
    o = np.argsort(ring, kind="stable")
    return order[o], ring[o]


def _polygons(owner, x, y, ring, poly):
    """Rings of corners as closed rings by owner and polygon, shells first."""
    start = np.flatnonzero(np.r_[True, ring[1:] != ring[:-1]]) if len(ring) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(ring)])
    if not len(size):
        return dissolve(owner[:0], np.zeros((0, 6)), np.zeros((0, 2), np.int64))
    follows = np.arange(1, len(ring) + 1)
    follows[start + size - 1] = start
    fx, fy = x[start].repeat(size), y[start].repeat(size)
    area = np.add.reduceat((x - fx) * (y[follows] - fy) - (x[follows] - fx) * (y - fy), start)
    poly = poly[start]
    shell = area > 0
    big = np.zeros(int(poly.max()) + 1)
    np.maximum.at(big, poly, area)
    use = (size > 2) & (area != 0) & (big[poly] > 0)
    rank = np.where(shell, np.where(area == big[poly], 0, 2), 1)
    o = np.lexsort((start, rank, poly, owner[poly]))
    o = o[use[o]]
    n = size[o] + 1
    off = np.r_[0, np.cumsum(n)]
    at = np.repeat(start[o], n) + np.arange(off[-1]) - np.repeat(off[:-1], n)
    at[off[1:] - 1] = start[o]
    return np.c_[x[at], y[at]], off, owner[poly[o]], np.cumsum(shell[o]) - 1
