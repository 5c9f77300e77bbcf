"""Geometry kernels (numpy only): known shapes, symmetry, WKB edge cases."""

import struct

import numpy as np
import pyarrow as pa
import pytest

from footmark.functions import kernels as K
from footmark.functions import wkb as W


def box(x0, y0, x1, y1):
    return W.wkb_polygon([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])


HOLED = W.wkb_polygon([[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (2, 4), (4, 4), (4, 2)]])
CONCAVE = W.wkb_polygon([[(0, 0), (10, 0), (10, 10), (5, 5), (0, 10)]])
ROTATED = W.wkb_polygon([[(5, 0), (10, 5), (5, 10), (0, 5)]])
MULTI = W.wkb_multipolygon([[[(0, 0), (1, 0), (1, 1), (0, 1)]], [[(10, 10), (12, 10), (12, 12), (10, 12)]]])


def dec(*vals):
    return W.decode(pa.array(list(vals), pa.binary()))


def test_area_and_centroid_of_known_shapes():
    g = dec(box(0, 0, 10, 10), HOLED, CONCAVE, ROTATED, MULTI, W.wkb_point(3, 4),
            W.wkb_linestring([(0, 0), (3, 4)]))
    np.testing.assert_allclose(K.area(g), [100, 96, 75, 50, 5, 0, 0])
    cx, cy = K.centroid(g)
    np.testing.assert_allclose(cx, [5, 488 / 96, 5, 5, 8.9, 3, 1.5])
    np.testing.assert_allclose(cy, [5, 488 / 96, (500 - 25 * 25 / 3) / 75, 5, 8.9, 4, 2])


def test_large_coordinates_are_exact():
    x0, y0 = -2174000.0, 2020000.0
    g = dec(box(x0, y0, x0 + 17, y0 + 11))
    assert K.area(g)[0] == 187.0
    cx, cy = K.centroid(g)
    assert (cx[0], cy[0]) == (x0 + 8.5, y0 + 5.5)


@pytest.mark.parametrize("a,b,area,dist", [
    (box(0, 0, 10, 10), box(5, 5, 15, 15), 25, 0),
    (box(0, 0, 10, 10), box(10, 0, 20, 10), 0, 0),            # touching edge
    (box(0, 0, 10, 10), box(20, 0, 30, 10), 0, 10),
    (HOLED, W.wkb_point(3, 3), 0, 1),                          # point in the hole
    (CONCAVE, box(0, 5, 10, 10), 25, 0),
    (ROTATED, box(0, 0, 5, 5), 12.5, 0),
    (box(0, 0, 10, 10), box(2, 2, 3, 3), 1, 0),                # containment
    (HOLED, CONCAVE, 71, 0),
    (MULTI, box(0.5, 0.5, 11, 11), 0.25 + 1, 0),
])
def test_pairwise(a, b, area, dist):
    ga, gb = dec(a), dec(b)
    assert K.intersection_area(ga, gb)[0] == pytest.approx(area)
    assert K.intersection_area(gb, ga)[0] == pytest.approx(area)
    d, hit = K.distance_and_intersects(ga, gb)
    assert d[0] == pytest.approx(dist)
    assert hit[0] == (dist == 0)
    d2, hit2 = K.distance_and_intersects(gb, ga)
    assert d2[0] == pytest.approx(dist) and hit2[0] == hit[0]


def test_self_intersection_is_self():
    for g in (HOLED, CONCAVE, ROTATED, MULTI):
        a = dec(g)
        assert K.intersection_area(a, a)[0] == pytest.approx(K.area(a)[0])


def test_intersection_parts_area_and_centroid():
    a, b = dec(CONCAVE), dec(box(0, 5, 10, 10))
    parts = K.intersection_parts(a, b)[0]
    g = dec(W.wkb_multipolygon(parts))
    assert K.area(g)[0] == pytest.approx(25)


def test_random_polygons_against_grid_sampling():
    rng = np.random.default_rng(7)
    for _ in range(20):
        ang = np.sort(rng.uniform(0, 2 * np.pi, 7))
        r = rng.uniform(3, 10, 7)
        p1 = np.c_[10 + r * np.cos(ang), 10 + r * np.sin(ang)]
        p2 = p1 + rng.uniform(-4, 4, 2)
        a, b = dec(W.wkb_polygon([p1])), dec(W.wkb_polygon([p2]))
        got = K.intersection_area(a, b)[0]
        # Monte-Carlo style check on a fine grid
        xs = np.linspace(-5, 25, 601)
        X, Y = np.meshgrid(xs, xs)

        def inside(poly):
            c = np.zeros(X.shape, bool)
            for (x1, y1), (x2, y2) in zip(poly, np.roll(poly, -1, axis=0)):
                cond = ((y1 > Y) != (y2 > Y)) & (X < x1 + (Y - y1) * (x2 - x1) / (y2 - y1 + 1e-300))
                c ^= cond
            return c
        est = (inside(p1) & inside(p2)).sum() * (xs[1] - xs[0]) ** 2
        assert got == pytest.approx(est, abs=1.5)


def test_wkb_variants_and_bad_values():
    le = W.wkb_point(1.5, 2.5)
    be = struct.pack(">BIdd", 0, 1, 1.5, 2.5)
    z = struct.pack("<BIddd", 1, 1001, 1.5, 2.5, 9.0)
    ewkb = struct.pack("<BIIdd", 1, 0x20000001, 4326, 1.5, 2.5)
    empty_pt = struct.pack("<BIdd", 1, 1, float("nan"), float("nan"))
    empty_poly = struct.pack("<BII", 1, 3, 0)
    g = dec(le, be, z, ewkb, None, b"\x01\x02", b"", le[:15], empty_pt, empty_poly, b"\x01\x63\x00\x00\x00")
    assert list(g.valid) == [True] * 4 + [False] * 7
    cx, cy = K.centroid(g)
    np.testing.assert_allclose(cx[:4], 1.5)
    np.testing.assert_allclose(cy[:4], 2.5)
    assert np.isnan(cx[4:]).all()
    a = K.area(g)
    assert np.isnan(a[4]) and a[8] == 0 and a[9] == 0


def test_points_and_polygons_generators():
    g = dec(box(0, 0, 1, 1), MULTI, None)
    x, y, off = K.points_of(g)
    assert list(np.diff(off)) == [5, 10, 0]
    polys = K.polygons_of(g)
    assert len(polys[0]) == 1 and len(polys[1]) == 2 and polys[2] is None
    with pytest.raises(ValueError):
        K.polygons_of(dec(W.wkb_point(0, 0)))


def test_encode_round_trip():
    arr = W.encode_boxes(np.array([0.0, -5]), np.array([0.0, 1]), np.array([2.0, 5]), np.array([3.0, 2]))
    g = W.decode(arr)
    np.testing.assert_allclose(K.area(g), [6, 10])
    pts = W.encode_points(np.array([1.0, np.nan]), np.array([2.0, 3.0]))
    assert pts.null_count == 1


def test_batches_without_rings():
    g = dec(None, W.EMPTY_COLLECTION, struct.pack("<BII", 1, 3, 0))
    a = K.area(g)
    assert np.isnan(a[0]) and a[1] == 0 and a[2] == 0
    cx, cy = K.centroid(g)
    assert np.isnan(cx).all()
    assert np.isnan(K.bbox(g)[0]).all()


def test_vectorised_overlap_matches_per_pair():
    rng = np.random.default_rng(11)
    la, lb = [], []
    for _ in range(300):
        k = rng.integers(3, 9)
        ang = np.sort(rng.uniform(0, 2 * np.pi, k))
        r = rng.uniform(2, 8, k)
        c = rng.uniform(0, 10, 2)
        p1 = np.c_[c[0] + r * np.cos(ang), c[1] + r * np.sin(ang)]
        th = rng.uniform(0, np.pi)
        rect = np.array([[-3, -2], [3, -2], [3, 2], [-3, 2]]) @ np.array([[np.cos(th), np.sin(th)],
                                                                          [-np.sin(th), np.cos(th)]])
        la.append(W.wkb_polygon([p1]))
        lb.append(W.wkb_polygon([rect + c + rng.uniform(-3, 3, 2)]))
    a, b = dec(*la), dec(*lb)
    got = K.intersection_area(a, b)
    for i in range(len(la)):  # alone, and as the sum of its pieces
        assert got[i] == pytest.approx(K.intersection_area(dec(la[i]), dec(lb[i]))[0], abs=1e-9)
    pieces = K.intersection_parts(a, b)
    for i, ps in enumerate(pieces):
        total = sum(K.area(dec(W.wkb_polygon(p)))[0] for p in ps)
        assert got[i] == pytest.approx(total, abs=1e-9)


def test_large_pairs_are_cut_into_blocks(monkeypatch):
    # a regular polygon of 3,000 corners against a square through its centre: a quarter of it
    t = np.linspace(0, 2 * np.pi, 3000, endpoint=False)
    disc = W.wkb_polygon([100 * np.c_[np.cos(t), np.sin(t)]])
    square = W.wkb_polygon([[(0, 0), (0.1, 150), (150, 150), (150, 0.1)]])
    a, b = dec(disc, square), dec(square, disc)
    whole = K.intersection_area(a, b)
    near = K.distance_and_intersects(a, b)
    monkeypatch.setattr(K, "MAX_SPANS", 100)
    product = K._pair_product
    monkeypatch.setattr(K, "_pair_product", lambda x, y: product(x, y, 97))
    small = K.intersection_area(a, b)
    assert small == pytest.approx(whole, rel=1e-12)
    assert whole[0] == pytest.approx(np.pi * 2500, rel=2e-3)
    assert all(np.array_equal(p, q) for p, q in zip(near, K.distance_and_intersects(a, b)))


def test_fast_decode_matches_per_value_parser():
    rng = np.random.default_rng(5)
    vals = []
    for i in range(400):
        kind = i % 5
        c = rng.uniform(-2e6, 2e6, 2)
        if kind == 0:
            vals.append(W.wkb_point(*c))
        elif kind in (1, 2):
            rings = [c + rng.uniform(-50, 50, (rng.integers(3, 9), 2)) for _ in range(1 + (kind == 2) * rng.integers(1, 4))]
            vals.append(W.wkb_polygon(rings))
        elif kind == 3:
            vals.append(W.wkb_multipolygon([[c + rng.uniform(-5, 5, (4, 2))], [c + 100 + rng.uniform(-5, 5, (5, 2))]]))
        else:
            good = W.wkb_polygon([c + rng.uniform(-5, 5, (6, 2))])
            vals.append(good[: rng.integers(5, len(good))])        # truncated
    fast = W.decode(pa.array(vals, pa.binary()))
    for i, v in enumerate(vals):
        rings = []
        try:
            W._parse_one(v, rings, i, [0])
        except Exception:
            rings = []
        ring_sel = np.nonzero(fast.ring_geom == i)[0]
        assert fast.valid[i] == bool(rings), i
        assert len(ring_sel) == len(rings), i
        for r, (xy, kind, _) in zip(ring_sel, rings):
            np.testing.assert_array_equal(fast.xy[fast.ring_off[r]:fast.ring_off[r + 1]], xy)
            assert fast.ring_kind[r] == kind
    # holed polygon keeps its area through the fast path
    assert K.area(dec(HOLED))[0] == 96
    # an open ring is closed by the per-value path
    open_ring = struct.pack("<BIII", 1, 3, 1, 4) + np.array([[0, 0], [4, 0], [4, 4], [0, 4]], "<f8").tobytes()
    assert K.area(dec(open_ring))[0] == 16


def test_deep_collections_and_many_parts_decode():
    deep = W.wkb_point(3, 4)
    for _ in range(3000):
        deep = struct.pack("<BII", 1, 7, 1) + deep
    g = dec(deep)
    assert g.valid[0] and g.xy.tolist() == [[3.0, 4.0]]
    square = np.array([(0, 0), (2, 0), (2, 2), (0, 2)])
    hole = np.array([(0.5, 0.5), (0.5, 1), (1, 1), (1, 0.5)])
    multi = W.wkb_multipolygon([[square + (3 * i, 0), hole + (3 * i, 0)] for i in range(500)])
    assert K.area(dec(multi, W.wkb_polygon([square])))[0] == pytest.approx(500 * 3.75)
    assert len(K.polygons_of(dec(multi))[0]) == 500
