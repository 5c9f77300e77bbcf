"""Planar geometry kernels over decoded WKB batches (numpy only).

Every function takes :class:`~footmark.functions.wkb.Geoms` batches and
returns numpy arrays (NaN / False for null input). Pairwise kernels take two
batches of equal length and work element by element.

Precision: coordinates in EPSG:5070 are about 2e6 metres, so ring sums are
taken relative to the ring's first vertex before the shoelace products.
"""

from __future__ import annotations

import numpy as np

from .dissolve import SNAP, dissolve
from .wkb import K_HOLE, K_LINE, K_POINT, K_SHELL, MULTIPOLYGON, POLYGON, Geoms

# --------------------------------------------------------------------------- helpers


def _seg_reduce(values: np.ndarray, offsets: np.ndarray, ufunc, fill: float) -> np.ndarray:
    """Reduce ``values`` over consecutive segments given by ``offsets`` (len m+1)."""
    m = len(offsets) - 1
    out = np.full(m, fill, dtype=np.float64)
    if m == 0 or len(values) == 0:
        return out
    lens = np.diff(offsets)
    ne = lens > 0
    if ne.any():
        out[ne] = ufunc.reduceat(values, offsets[:-1][ne])
    return out


def _ring_terms(g: Geoms):
    """Per-edge shoelace terms relative to the ring's first vertex.

    Returns (edge_ring, cross, dx0, dy0, dx1, dy1) for every edge of every
    ring with at least two coordinates.
    """
    nc = len(g.xy)
    if nc == 0:
        z = np.zeros(0)
        return np.zeros(0, np.int64), z, z, z, z, z
    cr = g.coord_ring()
    first = g.ring_off[:-1][cr]
    rel = g.xy - g.xy[first]
    is_last = np.zeros(nc, bool)
    is_last[g.ring_off[1:] - 1] = True
    e0 = np.nonzero(~is_last)[0]
    e1 = e0 + 1
    dx0, dy0 = rel[e0, 0], rel[e0, 1]
    dx1, dy1 = rel[e1, 0], rel[e1, 1]
    cross = dx0 * dy1 - dx1 * dy0
    return cr[e0], cross, dx0, dy0, dx1, dy1


# --------------------------------------------------------------------------- unary


def bbox(g: Geoms):
    """(xmin, ymin, xmax, ymax); NaN for null or empty geometry."""
    off = g.geom_coord_off()
    x = g.xy[:, 0]
    y = g.xy[:, 1]
    return (_seg_reduce(x, off, np.minimum, np.nan), _seg_reduce(y, off, np.minimum, np.nan),
            _seg_reduce(x, off, np.maximum, np.nan), _seg_reduce(y, off, np.maximum, np.nan))


def ring_signed_areas(g: Geoms) -> np.ndarray:
    er, cross, *_ = _ring_terms(g)
    return np.bincount(er, weights=cross, minlength=len(g.ring_geom)) / 2.0


def area(g: Geoms) -> np.ndarray:
    """Unsigned planar area (shells minus holes); points and lines are 0.

    Null geometry gives NaN; an empty geometry gives 0.
    """
    ra = np.abs(ring_signed_areas(g))
    sign = np.where(g.ring_kind == K_SHELL, 1.0, np.where(g.ring_kind == K_HOLE, -1.0, 0.0))
    out = np.bincount(g.ring_geom, weights=ra * sign, minlength=g.n).astype(np.float64)
    out[~g.valid] = np.nan
    out[g.empty] = 0.0
    return out


def centroid(g: Geoms):
    """Centroid (x, y) of each geometry, by its highest dimension with measure.

    Polygons: area-weighted (holes subtract). Lines (and degenerate polygons):
    length-weighted segment midpoints. Points: mean. Null -> NaN.
    """
    n = g.n
    R = len(g.ring_geom)
    cx = np.full(n, np.nan)
    cy = np.full(n, np.nan)
    if R == 0:
        return cx, cy
    # reference point per geometry: its first coordinate
    goff = g.geom_coord_off()
    has = np.diff(goff) > 0
    ref = np.zeros((n, 2))
    ref[has] = g.xy[goff[:-1][has]]
    ring_first = g.xy[g.ring_off[:-1]] - ref[g.ring_geom]

    er, cross, dx0, dy0, dx1, dy1 = _ring_terms(g)
    # polygon part
    a_r = np.bincount(er, weights=cross, minlength=R) / 2.0
    sx_r = np.bincount(er, weights=(dx0 + dx1) * cross, minlength=R) / 6.0
    sy_r = np.bincount(er, weights=(dy0 + dy1) * cross, minlength=R) / 6.0
    is_area = (g.ring_kind == K_SHELL) | (g.ring_kind == K_HOLE)
    sgn = np.where(g.ring_kind == K_SHELL, 1.0, -1.0) * np.sign(a_r)
    w = np.where(is_area, np.abs(a_r), 0.0) * np.where(g.ring_kind == K_SHELL, 1.0, -1.0)
    # ring centroid relative to ring first vertex = s/a ; moment = |a| * c
    with np.errstate(invalid="ignore", divide="ignore"):
        mx = np.where(is_area & (a_r != 0), sgn * sx_r, 0.0) + w * ring_first[:, 0]
        my = np.where(is_area & (a_r != 0), sgn * sy_r, 0.0) + w * ring_first[:, 1]
    A = np.bincount(g.ring_geom, weights=w, minlength=n)
    MX = np.bincount(g.ring_geom, weights=mx, minlength=n)
    MY = np.bincount(g.ring_geom, weights=my, minlength=n)

    # line part (all rings with >= 2 coords, incl. polygon rings)
    seg_len = np.hypot(dx1 - dx0, dy1 - dy0)
    L_r = np.bincount(er, weights=seg_len, minlength=R)
    lx_r = np.bincount(er, weights=seg_len * (dx0 + dx1) / 2.0, minlength=R)
    ly_r = np.bincount(er, weights=seg_len * (dy0 + dy1) / 2.0, minlength=R)
    L = np.bincount(g.ring_geom, weights=L_r, minlength=n)
    LX = np.bincount(g.ring_geom, weights=lx_r + L_r * ring_first[:, 0], minlength=n)
    LY = np.bincount(g.ring_geom, weights=ly_r + L_r * ring_first[:, 1], minlength=n)

    # point part (mean of all coordinates)
    cg = g.coord_geom()
    rel = g.xy - ref[cg]
    C = np.bincount(cg, minlength=n).astype(float)
    PX = np.bincount(cg, weights=rel[:, 0], minlength=n)
    PY = np.bincount(cg, weights=rel[:, 1], minlength=n)

    # geo's centroid looks at the highest-dimension members: polygons before lines
    has_poly = np.bincount(g.ring_geom, weights=is_area.astype(float), minlength=n) > 0
    has_line = np.bincount(g.ring_geom, weights=(g.ring_kind == K_LINE).astype(float), minlength=n) > 0
    with np.errstate(invalid="ignore", divide="ignore"):
        use_a = has_poly & (A != 0)
        use_l = ~use_a & (has_poly | has_line) & (L > 0)
        use_p = ~use_a & ~use_l & (C > 0)
        cx = np.where(use_a, MX / A, np.where(use_l, LX / L, np.where(use_p, PX / C, np.nan))) + ref[:, 0]
        cy = np.where(use_a, MY / A, np.where(use_l, LY / L, np.where(use_p, PY / C, np.nan))) + ref[:, 1]
    cx[~g.valid] = np.nan
    cy[~g.valid] = np.nan
    return cx, cy


def is_rectangle(g: Geoms) -> np.ndarray:
    """True for a single-ring polygon that is an axis-aligned rectangle."""
    n = g.n
    out = np.zeros(n, bool)
    gro = g.geom_ring_off()
    one_ring = (np.diff(gro) == 1) & g.valid
    cand = np.nonzero(one_ring)[0]
    if len(cand) == 0:
        return out
    r = gro[:-1][cand]
    ok = (g.ring_kind[r] == K_SHELL) & (np.diff(g.ring_off)[r] == 5)
    cand, r = cand[ok], r[ok]
    if len(cand) == 0:
        return out
    s = g.ring_off[:-1][r]
    p = g.xy[s[:, None] + np.arange(5)]  # (m, 5, 2)
    d = np.diff(p, axis=1)  # (m, 4, 2)
    axis = (d[..., 0] == 0) | (d[..., 1] == 0)
    alt = ((d[:, 0, 0] == 0) & (d[:, 1, 1] == 0) & (d[:, 2, 0] == 0) & (d[:, 3, 1] == 0)) | \
          ((d[:, 0, 1] == 0) & (d[:, 1, 0] == 0) & (d[:, 2, 1] == 0) & (d[:, 3, 0] == 0))
    nondeg = (np.abs(d).sum(axis=2) > 0).all(axis=1)
    out[cand[axis.all(axis=1) & alt & nondeg]] = True
    return out


# --------------------------------------------------------------------------- segments


def _segments(g: Geoms):
    """All segments of every geometry, sorted by geometry.

    A point (or one-coordinate ring) is a zero-length segment.
    Returns (x1, y1, x2, y2, seg_geom, geom_seg_off).
    """
    nc = len(g.xy)
    if nc == 0:
        z = np.zeros(0)
        return z, z, z, z, np.zeros(0, np.int64), np.zeros(g.n + 1, np.int64)
    rl = g.ring_len
    cr = g.coord_ring()
    is_last = np.zeros(nc, bool)
    is_last[g.ring_off[1:] - 1] = True
    single = rl == 1
    keep = ~is_last | single[cr]
    i0 = np.nonzero(keep)[0]
    i1 = np.where(single[cr[i0]], i0, i0 + 1)
    sg = g.ring_geom[cr[i0]]
    off = np.searchsorted(sg, np.arange(g.n + 1)).astype(np.int64)
    return g.xy[i0, 0], g.xy[i0, 1], g.xy[i1, 0], g.xy[i1, 1], sg, off


def _pt_seg_dist2(px, py, x1, y1, x2, y2):
    dx = x2 - x1
    dy = y2 - y1
    L2 = dx * dx + dy * dy
    with np.errstate(invalid="ignore", divide="ignore"):
        t = np.where(L2 > 0, ((px - x1) * dx + (py - y1) * dy) / np.where(L2 > 0, L2, 1.0), 0.0)
    t = np.clip(t, 0.0, 1.0)
    ex = px - (x1 + t * dx)
    ey = py - (y1 + t * dy)
    # exact for the end points
    d2 = ex * ex + ey * ey
    d2 = np.minimum(d2, np.minimum((px - x1) ** 2 + (py - y1) ** 2, (px - x2) ** 2 + (py - y2) ** 2))
    return d2


def _orient(ax, ay, bx, by, cx, cy):
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _seg_intersects(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2):
    o1 = _orient(ax1, ay1, ax2, ay2, bx1, by1)
    o2 = _orient(ax1, ay1, ax2, ay2, bx2, by2)
    o3 = _orient(bx1, by1, bx2, by2, ax1, ay1)
    o4 = _orient(bx1, by1, bx2, by2, ax2, ay2)
    box = (np.minimum(ax1, ax2) <= np.maximum(bx1, bx2)) & (np.minimum(bx1, bx2) <= np.maximum(ax1, ax2)) & \
          (np.minimum(ay1, ay2) <= np.maximum(by1, by2)) & (np.minimum(by1, by2) <= np.maximum(ay1, ay2))
    return (o1 * o2 <= 0) & (o3 * o4 <= 0) & box


def _pair_product(ca: np.ndarray, cb: np.ndarray, max_rows: int = 500_000):
    """Yield (pair_idx, ia_local, ib_local) chunks enumerating ca[i] x cb[i] per pair.

    A chunk holds at most ``max_rows`` combinations: a larger pair is cut by ranges of its product.
    """
    tot = (ca * cb).astype(np.int64)
    end = np.cumsum(tot)
    begin = end - tot
    total = int(end[-1]) if len(end) else 0
    for at in range(0, total, max_rows):
        w = np.arange(at, min(at + max_rows, total))
        p = np.searchsorted(end, w, side="right")
        w -= begin[p]
        cbp = cb[p]
        yield p, w // cbp, w % cbp


def _area_edges(g: Geoms):
    """Edges of polygon rings only: (x1, y1, x2, y2, geom, geom_off)."""
    nc = len(g.xy)
    if nc == 0:
        z = np.zeros(0)
        return z, z, z, z, np.zeros(0, np.int64), np.zeros(g.n + 1, np.int64)
    cr = g.coord_ring()
    is_last = np.zeros(nc, bool)
    is_last[g.ring_off[1:] - 1] = True
    is_area = (g.ring_kind == K_SHELL) | (g.ring_kind == K_HOLE)
    keep = ~is_last & is_area[cr]
    i0 = np.nonzero(keep)[0]
    i1 = i0 + 1
    eg = g.ring_geom[cr[i0]]
    off = np.searchsorted(eg, np.arange(g.n + 1)).astype(np.int64)
    return g.xy[i0, 0], g.xy[i0, 1], g.xy[i1, 0], g.xy[i1, 1], eg, off


def _ring_firsts(g: Geoms):
    """First vertex of every ring, grouped by geometry: (x, y, geom_off)."""
    f = g.ring_off[:-1]
    return g.xy[f, 0], g.xy[f, 1], g.geom_ring_off()


def _contains_any(pa_: Geoms, pb: Geoms, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """For pairs (ia[k], ib[k]): does the area of b contain the first vertex of any ring of a?

    Even-odd rule over b's polygon rings (boundary points are found by the
    segment test instead).
    """
    m = len(ia)
    out = np.zeros(m, bool)
    if m == 0:
        return out
    fx, fy, foff = _ring_firsts(pa_)
    ex1, ey1, ex2, ey2, _, eoff = _area_edges(pb)
    nr = foff[1:][ia] - foff[:-1][ia]
    ne = eoff[1:][ib] - eoff[:-1][ib]
    # crossings per (pair, ring), summed over the chunks: a large pair spans several
    base = np.cumsum(nr) - nr
    cnt = np.zeros(int(nr.sum()), np.int64)
    for p, rloc, eloc in _pair_product(nr, ne):
        r = foff[:-1][ia[p]] + rloc
        e = eoff[:-1][ib[p]] + eloc
        px, py = fx[r], fy[r]
        y1, y2 = ey1[e], ey2[e]
        x1, x2 = ex1[e], ex2[e]
        spans = (y1 > py) != (y2 > py)
        with np.errstate(invalid="ignore", divide="ignore"):
            xi = x1 + (py - y1) * (x2 - x1) / np.where(y2 != y1, y2 - y1, 1.0)
        hit = spans & (px < xi)
        np.add.at(cnt, (base[p] + rloc)[hit], 1)
    out[np.repeat(np.arange(m), nr)[cnt % 2 == 1]] = True
    return out


def distance_and_intersects(a: Geoms, b: Geoms):
    """Pairwise minimum planar distance and the intersects predicate.

    distance is 0 when the shapes intersect (boundary contact or containment).
    Null on either side gives NaN / False.
    """
    n = a.n
    dist = np.full(n, np.nan)
    inter = np.zeros(n, bool)
    ok = a.valid & b.valid
    if not ok.any():
        return dist, inter
    # closed form for rectangle/point pairs: gap between the two boxes
    boxy_a = is_rectangle(a) | (a.gtype == 1)
    boxy_b = is_rectangle(b) | (b.gtype == 1)
    fast = ok & boxy_a & boxy_b
    if fast.any():
        axmin, aymin, axmax, aymax = bbox(a)
        bxmin, bymin, bxmax, bymax = bbox(b)
        gx = np.maximum(0.0, np.maximum(axmin - bxmax, bxmin - axmax))
        gy = np.maximum(0.0, np.maximum(aymin - bymax, bymin - aymax))
        dist[fast] = np.sqrt(gx * gx + gy * gy)[fast]
        inter[fast] = dist[fast] == 0
        ok = ok & ~fast
        if not ok.any():
            return dist, inter
    ax1, ay1, ax2, ay2, _, aoff = _segments(a)
    bx1, by1, bx2, by2, _, boff = _segments(b)
    ca = np.where(ok, aoff[1:] - aoff[:-1], 0)
    cb = np.where(ok, boff[1:] - boff[:-1], 0)
    axl, axh, ayl, ayh = np.minimum(ax1, ax2), np.maximum(ax1, ax2), np.minimum(ay1, ay2), np.maximum(ay1, ay2)
    bxl, bxh, byl, byh = np.minimum(bx1, bx2), np.maximum(bx1, bx2), np.minimum(by1, by2), np.maximum(by1, by2)
    best = np.full(n, np.inf)
    for p, ia, ib in _pair_product(ca, cb):
        i = aoff[:-1][p] + ia
        j = boff[:-1][p] + ib
        # segments whose boxes are farther apart than the best so far can't improve it
        gx = np.maximum(0.0, np.maximum(axl[i] - bxh[j], bxl[j] - axh[i]))
        gy = np.maximum(0.0, np.maximum(ayl[i] - byh[j], byl[j] - ayh[i]))
        near = (best[p] > 0) & (gx * gx + gy * gy <= best[p] * (1 + 1e-9))
        if not near.any():
            continue
        p, i, j = p[near], i[near], j[near]
        hit = _seg_intersects(ax1[i], ay1[i], ax2[i], ay2[i], bx1[j], by1[j], bx2[j], by2[j])
        d2 = np.minimum(
            np.minimum(_pt_seg_dist2(ax1[i], ay1[i], bx1[j], by1[j], bx2[j], by2[j]),
                       _pt_seg_dist2(ax2[i], ay2[i], bx1[j], by1[j], bx2[j], by2[j])),
            np.minimum(_pt_seg_dist2(bx1[j], by1[j], ax1[i], ay1[i], ax2[i], ay2[i]),
                       _pt_seg_dist2(bx2[j], by2[j], ax1[i], ay1[i], ax2[i], ay2[i])))
        d2 = np.where(hit, 0.0, d2)
        starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        ps = p[starts]
        best[ps] = np.minimum(best[ps], np.minimum.reduceat(d2, starts))
    idx = np.nonzero(ok)[0]
    contain = _contains_any(a, b, idx, idx) | _contains_any(b, a, idx, idx)
    best[idx[contain]] = 0.0
    dist[ok] = np.sqrt(best[ok])
    inter[ok] = dist[ok] == 0
    return dist, inter


# --------------------------------------------------------------------------- overlay


#: (slab, edge) rows held at a time
MAX_SPANS = 500_000


def _no_pieces():
    return np.zeros(0, np.int64), np.zeros((0, 6)), np.zeros((0, 2), np.int64), np.zeros((0, 2))


def _slab_overlap(A, B, pairs: np.ndarray, want_pieces: bool = False, own: bool = False):
    """Slab overlap: (intersection area, pieces) for every pair index in ``pairs``.

    ``A`` / ``B`` are (x1, y1, x2, y2, geom_off) polygon-edge tables; pair i
    intersects geometry i of A with geometry i of B. The plane is cut into
    horizontal slabs at every vertex y and every edge crossing y; in a slab no
    edges cross, so the even-odd spans are trapezoids whose area is height x
    width at mid-height. All pairs are evaluated at once with sort-based
    grouping (no per-pair Python loop); a slab only sees the edges that span it.
    A polygon whose own edges cross (seen by edges that swap places in a slab) is computed again with
    those crossings as cuts (``own``).

    pieces, when wanted: (position in ``pairs``, trapezoids and their edges as :func:`dissolve` takes
    them, origin of their coordinates), else empty.
    """
    out = np.zeros(len(pairs), np.float64)
    ax1, ay1, ax2, ay2, aoff = A
    bx1, by1, bx2, by2, boff = B
    # a side without polygon edges (point, line) has no area to share
    has = ((aoff[1:][pairs] - aoff[:-1][pairs]) > 0) & ((boff[1:][pairs] - boff[:-1][pairs]) > 0)
    if not has.all():
        pieces = _no_pieces()
        if has.any():
            out[has], (owner, *rest) = _slab_overlap(A, B, pairs[has], want_pieces, own)
            pieces = np.nonzero(has)[0][owner], *rest
        return out, pieces
    if len(pairs) == 0:
        return out, _no_pieces()
    na = aoff[1:][pairs] - aoff[:-1][pairs]
    nb = boff[1:][pairs] - boff[:-1][pairs]
    P = len(pairs)
    # edges of each pair, A then B, with labels
    ea_pair = np.repeat(np.arange(P), na)
    ea_idx = np.repeat(aoff[:-1][pairs], na) + (np.arange(int(na.sum())) - np.repeat(np.cumsum(na) - na, na))
    eb_pair = np.repeat(np.arange(P), nb)
    eb_idx = np.repeat(boff[:-1][pairs], nb) + (np.arange(int(nb.sum())) - np.repeat(np.cumsum(nb) - nb, nb))
    EX1 = np.concatenate([ax1[ea_idx], bx1[eb_idx]])
    EY1 = np.concatenate([ay1[ea_idx], by1[eb_idx]])
    EX2 = np.concatenate([ax2[ea_idx], bx2[eb_idx]])
    EY2 = np.concatenate([ay2[ea_idx], by2[eb_idx]])
    EP = np.concatenate([ea_pair, eb_pair])
    EL = np.concatenate([np.zeros(len(ea_pair), np.int8), np.ones(len(eb_pair), np.int8)])
    o = np.argsort(EP, kind="stable")
    EX1, EY1, EX2, EY2, EP, EL = EX1[o], EY1[o], EX2[o], EY2[o], EP[o], EL[o]
    ne = na + nb
    eoff = np.concatenate([[0], np.cumsum(ne)])
    # local origin per pair (its first edge's start): keeps the products small
    rx, ry = EX1[eoff[:-1]][EP], EY1[eoff[:-1]][EP]
    EX1, EX2, EY1, EY2 = EX1 - rx, EX2 - rx, EY1 - ry, EY2 - ry
    # y-range overlap per pair
    ymin_e, ymax_e = np.minimum(EY1, EY2), np.maximum(EY1, EY2)
    isA = EL == 0
    lo = np.maximum(_group_reduce(ymin_e, EP, isA, P, np.minimum, np.inf),
                    _group_reduce(ymin_e, EP, ~isA, P, np.minimum, np.inf))
    hi = np.minimum(_group_reduce(ymax_e, EP, isA, P, np.maximum, -np.inf),
                    _group_reduce(ymax_e, EP, ~isA, P, np.maximum, -np.inf))
    # break points: vertex ys and proper crossings between A and B edges of the pair
    ys_p = [EP, EP]
    ys_v = [EY1, EY2]
    # (only edges that reach the common y-range can cross there)
    reach = (ymax_e > lo[EP]) & (ymin_e < hi[EP])
    ra, rb = np.nonzero(reach & isA)[0], np.nonzero(reach & ~isA)[0]
    for one, two in ((ra, rb), (ra, ra), (rb, rb)) if own else ((ra, rb),):
        for g, y in _crossings(EX1, EY1, EX2, EY2, EP, one, two, P):
            ys_p.append(g)
            ys_v.append(y)
    yp = np.concatenate(ys_p)
    yv = np.concatenate(ys_v)
    keep = (yv >= lo[yp]) & (yv <= hi[yp])
    yp, yv = yp[keep], yv[keep]
    if len(yp) == 0:
        return out, _no_pieces()
    o = np.lexsort((yv, yp))
    yp, yv = yp[o], yv[o]
    first = np.r_[True, (yp[1:] != yp[:-1]) | (yv[1:] != yv[:-1])]
    yp, yv = yp[first], yv[first]
    # slabs between consecutive break points of the same pair
    same = yp[1:] == yp[:-1]
    sp = yp[:-1][same]
    yb, yt = yv[:-1][same], yv[1:][same]
    if len(sp) == 0:
        return out, _no_pieces()
    ym = (yb + yt) / 2.0
    h = yt - yb
    # the slabs that each edge spans: a range, since its ends (cut to lo..hi) are break points
    e_lo, e_hi = np.maximum(ymin_e, lo[EP]), np.minimum(ymax_e, hi[EP])
    levels = np.unique(yv)
    key = yp * len(levels) + np.searchsorted(levels, yv)
    slab_of = np.cumsum(np.r_[same, False]) - np.r_[same, False]  # break point -> slab that starts there
    edge = np.nonzero(e_hi > e_lo)[0]
    first_pt = np.searchsorted(key, EP[edge] * len(levels) + np.searchsorted(levels, e_lo[edge]))
    last_pt = np.searchsorted(key, EP[edge] * len(levels) + np.searchsorted(levels, e_hi[edge]))
    from_slab = slab_of[first_pt]
    to_slab = from_slab + (last_pt - first_pt)
    # blocks of slabs with a bounded number of spans
    depth = np.cumsum(np.bincount(from_slab, minlength=len(sp) + 1) - np.bincount(to_slab, minlength=len(sp) + 1))
    block = np.cumsum(depth[:-1]) // MAX_SPANS
    cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(sp)]
    owner, quads, sides = [], [], []
    swapped = np.zeros(P, bool)
    slack = SNAP * np.maximum.reduceat(np.maximum(np.abs(EX1), np.abs(EY1)), eoff[:-1])
    for u, v in zip(cuts[:-1], cuts[1:]):
        here = np.nonzero((from_slab < v) & (to_slab > u))[0]
        f, n_sp = np.maximum(from_slab[here], u), np.minimum(to_slab[here], v) - np.maximum(from_slab[here], u)
        e_id = np.repeat(edge[here], n_sp)
        s_id = np.repeat(f, n_sp) + (np.arange(len(e_id)) - np.repeat(np.cumsum(n_sp) - n_sp, n_sp))
        y = ym[s_id]
        spans = (ymin_e[e_id] < y) & (ymax_e[e_id] > y)  # rounding of the middle of a thin slab
        s_id, e_id, y = s_id[spans], e_id[spans], y[spans]
        if len(s_id) == 0:
            continue
        x = EX1[e_id] + (y - EY1[e_id]) * (EX2[e_id] - EX1[e_id]) / (EY2[e_id] - EY1[e_id])
        lab = EL[e_id]
        o = np.lexsort((x, s_id))
        s_id, x, lab, e_id = s_id[o], x[o], lab[o], e_id[o]
        # parity of A and B crossings to the left of each gap, per slab
        start = np.r_[True, s_id[1:] != s_id[:-1]]
        grp_start = np.maximum.accumulate(np.where(start, np.arange(len(s_id)), 0))
        ca = np.cumsum(lab == 0)
        cb = np.cumsum(lab == 1)
        ina = (ca - (ca - (lab == 0))[grp_start]) % 2 == 1
        inb = (cb - (cb - (lab == 1))[grp_start]) % 2 == 1
        if not own:
            for at in (yb[s_id], yt[s_id]):
                end = EX1[e_id] + (at - EY1[e_id]) * (EX2[e_id] - EX1[e_id]) / (EY2[e_id] - EY1[e_id])
                back = ~start[1:] & (end[:-1] - end[1:] > slack[sp[s_id[1:]]])
                swapped[sp[s_id[1:][back]]] = True
        k = np.nonzero(~start[1:] & ina[:-1] & inb[:-1])[0]
        out += np.bincount(sp[s_id[k]], weights=(x[k + 1] - x[k]) * h[s_id[k]], minlength=P)
        if want_pieces:
            bot, top = yb[s_id[k]], yt[s_id[k]]

            def corner(e, at):
                px = EX1[e] + (at - EY1[e]) * (EX2[e] - EX1[e]) / (EY2[e] - EY1[e])
                return np.where(at == EY2[e], EX2[e], px)

            e0, e1 = e_id[k], e_id[k + 1]
            owner.append(sp[s_id[k]])
            quads.append(np.stack([corner(e0, bot), corner(e1, bot), corner(e0, top), corner(e1, top), bot, top], axis=1))
            sides.append(np.stack([e0, e1], axis=1))
    pieces = _no_pieces()
    if owner:
        owner = np.concatenate(owner)
        pieces = owner, np.concatenate(quads), np.concatenate(sides), np.stack([rx, ry], axis=1)[eoff[:-1][owner]]
    if swapped.any():
        again = np.nonzero(swapped)[0]
        out[again], (owner, *rest) = _slab_overlap(A, B, pairs[again], want_pieces, True)
        keep = ~swapped[pieces[0]]
        pieces = tuple(np.concatenate([v[keep], w]) for v, w in zip(pieces, (again[owner], *rest)))
    return out, pieces


def _crossings(x1, y1, x2, y2, group, one, two, groups):
    """(group, y) where edges ``one`` cross edges ``two`` of their group (both sorted by group), in blocks."""
    ka, kb = np.bincount(group[one], minlength=groups), np.bincount(group[two], minlength=groups)
    oa, ob = np.cumsum(ka) - ka, np.cumsum(kb) - kb
    for g, i, j in _pair_product(ka, kb):
        a, b = one[oa[g] + i], two[ob[g] + j]
        near = (np.minimum(x1[a], x2[a]) <= np.maximum(x1[b], x2[b])) & (np.minimum(x1[b], x2[b]) <= np.maximum(x1[a], x2[a])) & \
            (np.minimum(y1[a], y2[a]) <= np.maximum(y1[b], y2[b])) & (np.minimum(y1[b], y2[b]) <= np.maximum(y1[a], y2[a]))
        g, a, b = g[near], a[near], b[near]
        X1, Y1, X2, Y2 = x1[a], y1[a], x2[a], y2[a]
        U1, V1, U2, V2 = x1[b], y1[b], x2[b], y2[b]
        den = (X2 - X1) * (V2 - V1) - (Y2 - Y1) * (U2 - U1)
        with np.errstate(invalid="ignore", divide="ignore"):
            t = ((U1 - X1) * (V2 - V1) - (V1 - Y1) * (U2 - U1)) / den
            u = ((U1 - X1) * (Y2 - Y1) - (V1 - Y1) * (X2 - X1)) / den
        c = (den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        yield g[c], Y1[c] + t[c] * (Y2[c] - Y1[c])


def _group_reduce(v, grp, mask, n, ufunc, fill):
    out = np.full(n, fill)
    if mask.any():
        ufunc.at(out, grp[mask], v[mask])
    return out


def _edges_by_geom(g: Geoms):
    x1, y1, x2, y2, _, off = _area_edges(g)
    return x1, y1, x2, y2, off


def intersection_area(a: Geoms, b: Geoms) -> np.ndarray:
    """Area of the pairwise intersection; 0 when disjoint or only touching.

    NaN when either side is null. Axis-aligned rectangles use a closed form;
    anything else the slab decomposition.
    """
    n = a.n
    out = np.full(n, np.nan)
    ok = a.valid & b.valid
    ea = a.empty | b.empty
    out[ea & ~(~a.valid & ~a.empty) & ~(~b.valid & ~b.empty)] = 0.0
    if not ok.any():
        return out
    ra, rb = is_rectangle(a), is_rectangle(b)
    both = ok & ra & rb
    if both.any():
        axmin, aymin, axmax, aymax = bbox(a)
        bxmin, bymin, bxmax, bymax = bbox(b)
        w = np.maximum(0.0, np.minimum(axmax, bxmax) - np.maximum(axmin, bxmin))
        h = np.maximum(0.0, np.minimum(aymax, bymax) - np.maximum(aymin, bymin))
        out[both] = (w * h)[both]
    for idx, area, _ in _overlaps(a, b, np.nonzero(ok & ~both)[0]):
        out[idx] = area
    return out


def _overlaps(a: Geoms, b: Geoms, rest: np.ndarray, want_pieces: bool = False):
    """Yield (pair indices, areas, pieces) of ``rest`` in chunks by their number of edges."""
    if len(rest) == 0:
        return
    A, B = _edges_by_geom(a), _edges_by_geom(b)
    chunk = np.cumsum(((A[4][1:] - A[4][:-1]) + (B[4][1:] - B[4][:-1]))[rest]) // 200_000
    for idx in np.split(rest, np.flatnonzero(np.diff(chunk)) + 1):
        yield idx, *_slab_overlap(A, B, idx, want_pieces)


def intersection_rings(a: Geoms, b: Geoms):
    """Pairwise intersection as rings: (xy, ring offsets, pair of each ring, polygon of each ring).

    Rectangles give one rectangle, other polygons valid simple rings (shells counter-clockwise, each
    before its holes). Points and lines contribute no area, so their intersection has no ring.
    """
    ok = a.valid & b.valid
    boxes = ok & is_rectangle(a) & is_rectangle(b)
    axmin, aymin, axmax, aymax = bbox(a)
    bxmin, bymin, bxmax, bymax = bbox(b)
    x0, x1 = np.maximum(axmin, bxmin), np.minimum(axmax, bxmax)
    y0, y1 = np.maximum(aymin, bymin), np.minimum(aymax, bymax)
    i = np.nonzero(boxes & (x1 > x0) & (y1 > y0))[0]
    found = [(np.c_[x0[i], y0[i], x1[i], y0[i], x1[i], y1[i], x0[i], y1[i], x0[i], y0[i]].reshape(-1, 2), np.full(len(i), 5), i, np.arange(len(i)))]
    for idx, _, (owner, quads, sides, origin) in _overlaps(a, b, np.nonzero(ok & ~boxes)[0], want_pieces=True):
        xy, off, pair, poly = dissolve(owner, quads, sides)
        at = np.zeros((len(idx), 2))
        at[owner] = origin
        found.append((xy + np.repeat(at[pair], np.diff(off), axis=0), np.diff(off), idx[pair], poly + found[-1][3].max(initial=-1) + 1))
    xy, size, pair, poly = (np.concatenate(c) for c in zip(*found))
    return _ring_order(xy, size, pair, poly)


def _ring_order(xy, size, pair, poly):
    """Rings sorted by pair (each pair's rings keep their order)."""
    o = np.argsort(pair, kind="stable")
    start, off = np.cumsum(size) - size, np.r_[0, np.cumsum(size[o])]
    at = np.repeat(start[o] - off[:-1], size[o]) + np.arange(off[-1])
    return xy[at], off, pair[o], poly[o]


def intersection_parts(a: Geoms, b: Geoms):
    """:func:`intersection_rings` as a list of polygons (each a list of rings) per pair; None where a side is null."""
    res: list = [[] if ok else None for ok in (a.empty | a.valid) & (b.empty | b.valid)]
    xy, off, pair, poly = intersection_rings(a, b)
    for r, (i, p) in enumerate(zip(pair, poly)):
        if r == 0 or p != poly[r - 1]:
            res[i].append([])
        res[i][-1].append(xy[off[r]:off[r + 1]])
    return res


# --------------------------------------------------------------------------- generators


def points_of(g: Geoms):
    """Every coordinate of each geometry as (x, y) arrays plus per-geometry offsets."""
    return g.xy[:, 0], g.xy[:, 1], g.geom_coord_off()


def check_polygons(g: Geoms, which: np.ndarray | None = None) -> None:
    """Raises ValueError for a geometry (of ``which``) that is neither Polygon nor MultiPolygon; null and empty of either pass."""
    bad = (g.gtype != POLYGON) & (g.gtype != MULTIPOLYGON) & (g.valid | (g.empty & (g.gtype != 0)))
    if (bad if which is None else bad & which).any():
        raise ValueError("geometry is not a (multi)polygon")


def polygons_of(g: Geoms):
    """Per geometry, its polygons as lists of rings; None for null.

    Raises ValueError for a geometry that is neither Polygon nor MultiPolygon.
    """
    gro = g.geom_ring_off()
    out: list = []
    for i in range(g.n):
        if not g.valid[i]:
            if g.empty[i] and g.gtype[i] not in (0, POLYGON, MULTIPOLYGON):
                raise ValueError("explode_multipolygon: geometry is not a (multi)polygon")
            out.append(None if not g.empty[i] else [])
            continue
        if g.gtype[i] not in (POLYGON, MULTIPOLYGON):
            raise ValueError("explode_multipolygon: geometry is not a (multi)polygon")
        polys: dict = {}
        for r in range(gro[i], gro[i + 1]):
            polys.setdefault(int(g.ring_poly[r]), []).append(g.xy[g.ring_off[r]:g.ring_off[r + 1]])
        out.append(list(polys.values()))
    return out
