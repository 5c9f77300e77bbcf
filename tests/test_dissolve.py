"""Overlay results as valid polygons, and encoding by offsets, against plain versions."""

import numpy as np
import pyarrow as pa
import pytest

from footmark.functions import kernels as K
from footmark.functions import wkb as W


def dec(*values):
    return W.decode(pa.array(list(values), pa.binary()))


def signed(ring):
    x, y = np.asarray(ring).T
    x, y = x - x[0], y - y[0]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def inside(polys, p):
    """Even-odd rule over all rings, one edge at a time."""
    hit = False
    for ring in [r for poly in polys for r in poly]:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
            if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
    return hit


def crosses(a, b, c, d):
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    eps = 1e-6
    s = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
    return s[0] * s[1] < 0 and s[2] * s[3] < 0 and min(map(abs, s)) > eps


def check_valid(polys):
    rings = [r for p in polys for r in p]
    for p in polys:
        assert signed(p[0]) > 0 and all(signed(h) < 0 for h in p[1:])
    for r in rings:
        assert len(r) >= 4 and (r[0] == r[-1]).all()
        assert len({tuple(v) for v in r[:-1]}) == len(r) - 1     # no corner twice: a simple ring
    edges = [(r[i], r[i + 1]) for r in rings for i in range(len(r) - 1)]
    for i, e in enumerate(edges):
        assert not any(crosses(*e, *f) for f in edges[:i])


def star(rng, c, k, low, high):
    t = np.sort(rng.uniform(0, 2 * np.pi, k))
    return c + rng.uniform(low, high, k)[:, None] * np.c_[np.cos(t), np.sin(t)]


@pytest.mark.parametrize("origin", [(0, 0), (-2174000, 2020000)])
def test_random_polygons_with_holes(origin):
    rng = np.random.default_rng(3)
    la, lb = [], []
    for _ in range(150):
        rings = [star(rng, origin, 12, 20, 60)]
        if rng.random() < 0.6:
            rings.append(star(rng, origin, 6, 2, 9)[::-1])
        la.append(W.wkb_polygon(rings))
        lb.append(W.wkb_polygon([star(rng, np.array(origin) + rng.uniform(-25, 25, 2), 9, 15, 60)]))
    a, b = dec(*la), dec(*lb)
    got, area = K.intersection_parts(a, b), K.intersection_area(a, b)
    left, right = K.polygons_of(a), K.polygons_of(b)
    assert sum(len(p) > 1 for p in got) > 4 and sum(len(q) > 1 for p in got for q in p) > 10
    for i, polys in enumerate(got):
        check_valid(polys)
        assert sum(signed(r) for p in polys for r in p) == pytest.approx(area[i], abs=1e-6)
        for p in rng.uniform(-60, 60, (15, 2)) + origin:
            assert inside(polys, p) == (inside(left[i], p) and inside(right[i], p))


def test_known_shapes():
    comb = W.wkb_polygon([[(0, 0), (9, 0), (9, 5), (8, 5), (8, 1), (5, 1), (5, 5), (4, 5), (4, 1), (1, 1), (1, 5), (0, 5)]])
    band = W.wkb_polygon([[(-1, 3), (10, 3), (10, 4), (-1, 4.0), (-2, 3.5)]])
    frame = W.wkb_polygon([[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (4, 6), (6, 6), (6, 4)]])
    big = W.wkb_polygon([[(-5, -5), (20, -5), (30, 8), (20, 20), (-5, 20)]])
    notched = W.wkb_polygon([[(0, 0), (4, 0), (4, 4), (2, 2), (0, 4)]])
    above = W.wkb_polygon([[(-1, 2), (5, 2), (5, 9), (2, 10), (-1, 9)]])
    hole_at_shell = W.wkb_polygon([[(0, 0), (8, 0), (8, 8), (0, 8)], [(4, 0), (2, 3), (6, 3)]])
    parts = K.intersection_parts(dec(comb, frame, notched, hole_at_shell, W.wkb_point(1, 1), None), dec(band, big, above, big, big, big))
    assert [len(p) for p in parts[:5]] == [3, 1, 2, 1, 0] and parts[5] is None
    assert all(len(p) == 1 and len(p[0]) == 5 for p in parts[0])          # three teeth, four corners each
    assert [len(r) for r in parts[1][0]] == [5, 5]                        # the frame with its hole, no corner added
    assert sorted(abs(signed(r)) for p in parts[2] for r in p) == [2, 2]  # two triangles that touch in a corner
    assert sum(signed(r) for r in parts[3][0]) == 64 - 6                  # a hole that touches the shell
    for p in parts[:5]:
        check_valid(p)


def test_many_touching_squares():
    """A chess board: squares meet in corners, and a MultiPolygon's common edges dissolve."""
    squares = [[[(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]] for i in range(8) for j in range(8)]
    black = [s for s in squares if (s[0][0][0] + s[0][0][1]) % 2 == 0]
    around = W.wkb_polygon([[(-1, -1), (9, -2), (9, 9), (-1, 9)]])
    board, whole = K.intersection_parts(dec(W.wkb_multipolygon(black), W.wkb_multipolygon(squares)), dec(around, around))
    assert len(board) == 32 and all(signed(p[0]) == 1 for p in board)
    assert len(whole) == 1 and len(whole[0]) == 1 and signed(whole[0][0]) == 64
    check_valid(board)


def test_encoding_by_offsets():
    rng = np.random.default_rng(9)
    values = []
    for i in range(60):
        rings = [rng.uniform(0, 9, (rng.integers(3, 8), 2)) for _ in range(rng.integers(1, 4))]
        polys = [rings, [rng.uniform(20, 30, (4, 2))]]
        values.append([W.wkb_polygon(rings), W.wkb_multipolygon(polys), W.wkb_point(*rng.uniform(0, 9, 2)), None,
                       W.wkb_linestring(rng.uniform(0, 9, (3, 2))), W.EMPTY_COLLECTION, W.wkb_multipolygon(polys[1:])][i % 7])
    g = dec(*values)
    assert W.encode(g, g.xy).to_pylist() == W.encode_geoms(g) == values
    none = dec()
    assert W.encode(none, none.xy).to_pylist() == []
    assert W.encode_multipoints(3, np.array([[1.0, 2], [3, 4], [5, 6]]), np.array([0, 0, 2])).to_pylist() == \
        [W.wkb_multipoint([(1, 2), (3, 4)]), None, W.wkb_multipoint([(5, 6)])]
