"""WKB decode and encode over Arrow binary arrays.

Geometry is stored as ``BinaryType`` WKB everywhere. Inside a UDF a batch is
decoded once into a flat coordinate layout (:class:`Geoms`) that the numpy
kernels in :mod:`footmark.functions.kernels` work on.

Decoding rules
--------------
* little- and big-endian, ISO (1000/2000/3000 offsets) and EWKB (flag bits,
  optional SRID) type codes; Z and M are read and dropped (XY only);
* Point, LineString, Polygon, Multi*, GeometryCollection (flattened);
* a missing, truncated, unparsable or unsupported value becomes null, and so
  does an empty geometry (no coordinates, or a NaN point).

The common shapes of this workload (little-endian points and polygons with
closed rings) are decoded with vectorised numpy gathers over the Arrow
buffers; anything else (multi-part, big-endian, Z/M, open rings, bad values)
goes through a small per-value parser.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

POINT, LINESTRING, POLYGON, MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = range(1, 8)

# ring kinds
K_POINT, K_LINE, K_SHELL, K_HOLE = 0, 1, 2, 3


class Geoms:
    """A batch of geometries in flat form.

    n          number of geometries
    valid      bool[n]
    gtype      int8[n]   top-level WKB type (0 when null)
    xy         float64[N, 2] all coordinates
    ring_off   int64[R + 1]  ring r owns xy[ring_off[r]:ring_off[r + 1]]
    ring_geom  int64[R]  geometry of each ring
    ring_kind  int8[R]   K_POINT, K_LINE, K_SHELL or K_HOLE
    ring_poly  int64[R]  polygon ordinal within the batch (-1 if not a polygon ring)

    A point is a ring of one coordinate, a line a ring of its coordinates.
    Polygon rings are closed (first coordinate repeated at the end).
    """

    __slots__ = ("n", "valid", "gtype", "xy", "ring_off", "ring_geom", "ring_kind", "ring_poly",
                 "empty")

    def __init__(self, n, valid, gtype, xy, ring_off, ring_geom, ring_kind, ring_poly, empty=None):
        self.n = n
        # parsable but without coordinates (kept apart from null: its area is 0)
        self.empty = empty if empty is not None else np.zeros(n, bool)
        self.valid = valid
        self.gtype = gtype
        self.xy = xy
        self.ring_off = ring_off
        self.ring_geom = ring_geom
        self.ring_kind = ring_kind
        self.ring_poly = ring_poly

    def geom_ring_off(self) -> np.ndarray:
        """Ring offsets per geometry (rings are sorted by geometry)."""
        return np.searchsorted(self.ring_geom, np.arange(self.n + 1)).astype(np.int64)

    def geom_coord_off(self) -> np.ndarray:
        return self.ring_off[self.geom_ring_off()]

    @property
    def ring_len(self) -> np.ndarray:
        return np.diff(self.ring_off)

    def coord_ring(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ring_geom)), self.ring_len)

    def coord_geom(self) -> np.ndarray:
        return np.repeat(self.ring_geom, self.ring_len)


# --------------------------------------------------------------------------- decode

class _Bad(Exception):
    pass


def _parse_one(buf: bytes, rings: list, gi: int, poly_counter: list) -> int:
    """Parse one WKB value into ``rings`` (list of (xy, kind, poly)). Returns type."""
    pos, first, pending = 0, None, 1
    while pending:  # a collection only adds its members: no recursion, any nesting
        pending -= 1
        if pos + 5 > len(buf) or buf[pos] not in (0, 1):
            raise _Bad()
        e = "<" if buf[pos] == 1 else ">"
        (code,) = struct.unpack_from(e + "I", buf, pos + 1)
        pos += 5
        has_z = bool(code & 0x80000000)
        has_m = bool(code & 0x40000000)
        if code & 0x20000000:
            pos += 4  # EWKB SRID
        code &= 0x0FFFFFFF
        base = code % 1000
        dim_kind = code // 1000
        if dim_kind > 3:
            raise _Bad()
        has_z |= dim_kind in (1, 3)
        has_m |= dim_kind in (2, 3)
        nd = 2 + has_z + has_m
        first = base if first is None else first

        def coords(pos, k):
            end = pos + 8 * nd * k
            if end > len(buf) or k < 0:
                raise _Bad()
            a = np.frombuffer(buf, dtype=e + "f8", count=nd * k, offset=pos).reshape(k, nd)[:, :2]
            return a.astype(np.float64), end

        def count(pos):
            if pos + 4 > len(buf):
                raise _Bad()
            return struct.unpack_from(e + "I", buf, pos)[0], pos + 4

        if base == POINT:
            a, pos = coords(pos, 1)
            if not np.isnan(a).any():
                rings.append((a, K_POINT, -1))
        elif base == LINESTRING:
            k, pos = count(pos)
            a, pos = coords(pos, k)
            if k:
                rings.append((a, K_LINE, -1))
        elif base == POLYGON:
            nr, pos = count(pos)
            pid = None
            for r in range(nr):
                k, pos = count(pos)
                a, pos = coords(pos, k)
                if k == 0:
                    continue
                if pid is None:
                    pid = poly_counter[0]
                    poly_counter[0] += 1
                if not (a[0] == a[-1]).all():
                    a = np.vstack([a, a[:1]])
                rings.append((a, K_SHELL if r == 0 else K_HOLE, pid))
        elif base in (MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION):
            k, pos = count(pos)
            pending += k
        else:
            raise _Bad()
    return first


def _walk_polygons(data: np.ndarray, start: np.ndarray, end: np.ndarray, multi: np.ndarray, u32):
    """Rings of plain (multi)polygons: (value, part, ring number, first byte, points, decoded values).

    All values advance by one ring a step; those that are done or not plain (other byte order or
    dimensions, empty parts, open or short rings, truncated) leave the walk. The latter are left to
    the per-value parser. Rings come in the order of their number within the value.
    """
    m = len(start)
    alive = np.ones(m, bool)
    pos = start + np.where(multi, 9, 0)
    parts = np.where(multi, u32(start + 5).astype(np.int64), 1)
    alive &= parts >= 1
    rings, part, num = np.zeros(m, np.int64), np.full(m, -1), np.zeros(m, np.int64)
    found = []
    act = np.nonzero(alive)[0]
    while len(act):
        # a part starts: byte order, type and number of rings
        new = act[rings[act] == 0]
        if len(new):
            good = pos[new] + 13 <= end[new]
            alive[new[~good]] = False
            new = new[good]
            head = (data[pos[new]] == 1) & (u32(pos[new] + 1) == POLYGON)
            nr = u32(pos[new] + 5).astype(np.int64)
            good = head & (nr >= 1)
            alive[new[~good]] = False
            new = new[good]
            rings[new], num[new] = nr[good], 0
            part[new] += 1
            parts[new] -= 1
            pos[new] += 9
            act = act[alive[act]]
        # one ring of each
        good = pos[act] + 4 <= end[act]
        alive[act[~good]] = False
        act = act[good]
        k = u32(pos[act]).astype(np.int64)
        good = (k >= 4) & (pos[act] + 4 + 16 * k <= end[act])
        alive[act[~good]] = False
        act, k = act[good], k[good]
        found.append((act, part[act], num[act], pos[act] + 4, k))
        pos[act] += 4 + 16 * k
        rings[act] -= 1
        num[act] += 1
        act = act[(rings[act] > 0) | (parts[act] > 0)]
    alive &= pos == end
    if not found:
        return None
    v, part, num, at, k = (np.concatenate(c) for c in zip(*found))
    closed = (data[at[:, None] + np.arange(16)] == data[(at + 16 * (k - 1))[:, None] + np.arange(16)]).all(axis=1)
    alive[v[~closed]] = False
    keep = alive[v]
    return v[keep], part[keep], num[keep], at[keep], k[keep], alive


def decode(arr) -> Geoms:
    """Decode an Arrow binary array (or list of bytes/None) into :class:`Geoms`."""
    if not isinstance(arr, (pa.Array, pa.ChunkedArray)):
        arr = pa.array(list(arr), type=pa.binary())
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
    if pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.binary())
    n = len(arr)
    if n == 0:
        return Geoms(0, np.zeros(0, bool), np.zeros(0, np.int8), np.zeros((0, 2)),
                     np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8),
                     np.zeros(0, np.int64))
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data_buf = bufs[2]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    notnull = ~np.asarray(arr.is_null())
    start = offs[:-1]
    length = offs[1:] - start

    def u32(at):
        b = data[at[:, None] + np.arange(4)]
        return b.astype(np.uint32) @ np.array([1, 256, 65536, 16777216], dtype=np.uint32)

    # fast-path candidates: little-endian 2D points (21 bytes), and 2D polygons and
    # multipolygons of closed rings; these are walked ring by ring, vectorised across values
    cand = notnull & (length >= 9)
    idx = np.nonzero(cand)[0]
    fast_pt = np.zeros(n, bool)
    fast_pg = np.zeros(n, bool)
    pg_rings = None
    pg_type = np.zeros(n, np.int8)
    if len(idx):
        le = data[start[idx]] == 1
        code = np.zeros(len(idx), np.uint32)
        code[le] = u32(start[idx][le] + 1)
        is_pt = le & (code == POINT) & (length[idx] == 21)
        fast_pt[idx[is_pt]] = True
        is_pg = le & ((code == POLYGON) | (code == MULTIPOLYGON)) & (length[idx] >= 13)
        pg_idx = idx[is_pg]
        if len(pg_idx):
            pg_type[pg_idx] = code[is_pg]
            pg_rings = _walk_polygons(data, start[pg_idx], start[pg_idx] + length[pg_idx], code[is_pg] == MULTIPOLYGON,
                                      u32)
            if pg_rings is not None:
                v, part, rn, rf, rk, alive = pg_rings
                pg_rings = (pg_idx[v], part, rn, rf, rk)
                fast_pg[pg_idx[alive]] = True

    slow = notnull & ~fast_pt & ~fast_pg

    valid = np.zeros(n, bool)
    empty = np.zeros(n, bool)
    gtype = np.zeros(n, np.int8)

    # points
    pt_idx = np.nonzero(fast_pt)[0]
    pt_xy = np.zeros((0, 2))
    if len(pt_idx):
        raw = data[start[pt_idx][:, None] + 5 + np.arange(16)]
        pt_xy = raw.copy().view("<f8").reshape(-1, 2)
        good = ~np.isnan(pt_xy).any(axis=1)
        empty[pt_idx[~good]] = True
        pt_idx, pt_xy = pt_idx[good], pt_xy[good]
        valid[pt_idx] = True
        gtype[pt_idx] = POINT

    # polygons (rings in ring-number order; assembly below sorts them by value)
    pg_idx = np.zeros(0, np.int64)
    pg_xy = np.zeros((0, 2))
    pg_len = np.zeros(0, np.int64)
    pg_kind = np.zeros(0, np.int8)
    pg_part = np.zeros(0, np.int64)
    if pg_rings is not None and len(pg_rings[0]):
        pg_idx, pg_part, rn, rf, k = pg_rings
        tot = int(k.sum())
        within = np.arange(tot) - np.repeat(np.cumsum(k) - k, k)
        byte0 = np.repeat(rf, k) + within * 16
        raw = data[byte0[:, None] + np.arange(16)]
        pg_xy = raw.copy().view("<f8").reshape(-1, 2)
        pg_len = k
        pg_kind = np.where(rn == 0, K_SHELL, K_HOLE).astype(np.int8)
        valid[pg_idx] = True
        gtype[pg_idx] = pg_type[pg_idx]

    # slow path
    slow_rings = {}
    for i in np.nonzero(slow)[0]:
        b = bytes(data[start[i]:start[i] + length[i]])
        rings = []
        try:
            t = _parse_one(b, rings, int(i), [0])
        except (_Bad, struct.error, ValueError):
            continue
        if rings:
            valid[i] = True
            gtype[i] = t
            slow_rings[int(i)] = rings
        else:
            empty[i] = True

    # assemble in geometry order
    order_geom = []
    order_xy = []
    order_kind = []
    order_localpoly = []
    order_len = []
    if len(pt_idx):
        order_geom.append(pt_idx)
        order_xy.append(pt_xy)
        order_kind.append(np.full(len(pt_idx), K_POINT, np.int8))
        order_localpoly.append(np.full(len(pt_idx), -1, np.int64))
        order_len.append(np.ones(len(pt_idx), np.int64))
    if len(pg_idx):
        order_geom.append(pg_idx)
        order_xy.append(pg_xy)
        order_kind.append(pg_kind)
        order_localpoly.append(pg_part)
        order_len.append(pg_len)
    if slow_rings:
        g, xs, ks, ps, ls = [], [], [], [], []
        for i, rings in slow_rings.items():
            for a, kind, p in rings:
                g.append(i)
                xs.append(a)
                ks.append(kind)
                ps.append(p)
                ls.append(len(a))
        order_geom.append(np.array(g, np.int64))
        order_xy.append(np.concatenate(xs))
        order_kind.append(np.array(ks, np.int8))
        order_localpoly.append(np.array(ps, np.int64))
        order_len.append(np.array(ls, np.int64))

    if not order_geom:
        return Geoms(n, valid, gtype, np.zeros((0, 2)), np.zeros(1, np.int64),
                     np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64), empty)

    ring_geom = np.concatenate(order_geom)
    ring_kind = np.concatenate(order_kind)
    local_poly = np.concatenate(order_localpoly)
    ring_len = np.concatenate(order_len)
    xy = np.concatenate(order_xy)
    # rings are grouped per source; stable-sort rings by geometry to restore order
    ring_src_off = np.concatenate([[0], np.cumsum(ring_len)])
    perm = np.argsort(ring_geom, kind="stable")
    ring_geom = ring_geom[perm]
    ring_kind = ring_kind[perm]
    local_poly = local_poly[perm]
    ring_len_p = ring_len[perm]
    src_start = ring_src_off[:-1][perm]
    coord_idx = np.repeat(src_start - np.concatenate([[0], np.cumsum(ring_len_p)[:-1]]), ring_len_p) \
        + np.arange(int(ring_len_p.sum()))
    xy = xy[coord_idx]
    ring_off = np.concatenate([[0], np.cumsum(ring_len_p)]).astype(np.int64)
    # global polygon ordinal: (geom, local poly) pairs numbered in order
    ring_poly = np.full(len(ring_geom), -1, np.int64)
    is_poly = local_poly >= 0
    if is_poly.any():
        key = ring_geom[is_poly] * (int(local_poly.max()) + 1) + local_poly[is_poly]
        _, inv = np.unique(key, return_inverse=True)
        ring_poly[is_poly] = inv
    return Geoms(n, valid, gtype, xy, ring_off, ring_geom, ring_kind, ring_poly, empty)


# --------------------------------------------------------------------------- encode

def encode_points(x: np.ndarray, y: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Little-endian WKB points; null where ``valid`` is False or x/y is NaN."""
    x = np.asarray(x, np.float64)
    y = np.asarray(y, np.float64)
    n = len(x)
    ok = ~(np.isnan(x) | np.isnan(y))
    if valid is not None:
        ok &= np.asarray(valid, bool)
    rec = np.zeros((n, 21), np.uint8)
    rec[:, 0] = 1
    rec[:, 1] = POINT
    rec[:, 5:13] = np.ascontiguousarray(x).view(np.uint8).reshape(n, 8)
    rec[:, 13:21] = np.ascontiguousarray(y).view(np.uint8).reshape(n, 8)
    offsets = np.arange(n + 1, dtype=np.int32) * 21
    return _binary_from(rec.ravel(), offsets, ok)


def encode_boxes(xmin, ymin, xmax, ymax, valid=None) -> pa.Array:
    """Little-endian WKB rectangles (one closed counter-clockwise ring)."""
    xmin, ymin, xmax, ymax = (np.asarray(v, np.float64) for v in (xmin, ymin, xmax, ymax))
    n = len(xmin)
    ok = ~(np.isnan(xmin) | np.isnan(ymin) | np.isnan(xmax) | np.isnan(ymax))
    if valid is not None:
        ok &= np.asarray(valid, bool)
    rec = np.zeros((n, 93), np.uint8)
    rec[:, 0] = 1
    rec[:, 1] = POLYGON
    rec[:, 5] = 1
    rec[:, 9] = 5
    pts = np.stack([xmin, ymin, xmax, ymin, xmax, ymax, xmin, ymax, xmin, ymin], axis=1)
    rec[:, 13:93] = np.ascontiguousarray(pts).view(np.uint8).reshape(n, 80)
    offsets = np.arange(n + 1, dtype=np.int32) * 93
    return _binary_from(rec.ravel(), offsets, ok)


def encode_rings(xy: np.ndarray, n: np.ndarray) -> pa.Array:
    """Polygons of one ring each: ``n`` points (not closed) of ``xy`` for each value, none gives null.
    One output buffer for all values."""
    ok = n > 0
    size = np.where(ok, 13 + 16 * (n + 1), 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    head = np.zeros((int(ok.sum()), 13), np.uint8)
    head[:, 0], head[:, 1], head[:, 5] = 1, POLYGON, 1
    head[:, 9:13] = np.ascontiguousarray((n[ok] + 1).astype("<u4")).view(np.uint8).reshape(-1, 4)
    first = np.cumsum(n[ok]) - n[ok]
    at = np.arange(len(xy)) + np.repeat(np.arange(len(first)), n[ok])   # a closing point after each ring
    points = np.empty((len(xy) + len(first), 2))
    points[at] = xy
    points[first + n[ok] + np.arange(len(first))] = xy[first]
    data = np.empty(int(offsets[-1]), np.uint8)
    heads = (offsets[:-1][ok][:, None] + np.arange(13)).ravel()
    rest = np.ones(len(data), bool)
    rest[heads] = False
    data[heads], data[rest] = head.ravel(), points.view(np.uint8).ravel()
    return _binary_from(data, offsets.astype(np.int32), ok)


def encode_polygons(n: int, xy: np.ndarray, ring_off: np.ndarray, ring_geom: np.ndarray, ring_poly: np.ndarray,
                    ok: np.ndarray | None = None, multi=False) -> pa.Array:
    """Polygons and MultiPolygons from closed rings that are sorted by geometry and polygon.

    A geometry of one polygon is a Polygon unless ``multi`` (a flag, or one a geometry) is set, one of
    several a MultiPolygon, one of none an empty collection; null where ``ok`` is False. One output
    buffer for all values."""
    ok = np.ones(n, bool) if ok is None else ok
    lead = np.r_[True, ring_poly[1:] != ring_poly[:-1]][:len(ring_poly)]  # the ring starts a polygon
    polys = np.bincount(ring_geom[lead], minlength=n)
    wrap = ok & ((polys != 1) | multi)
    points = np.diff(ring_off)
    size = 4 + 16 * points + 9 * lead
    total = 9 * wrap
    np.add.at(total, ring_geom, size)
    offsets = np.r_[0, np.cumsum(total)]
    first = np.searchsorted(ring_geom, np.arange(n))  # first ring of each geometry
    before = np.r_[0, np.cumsum(size)]
    at = offsets[:-1][ring_geom] + 9 * wrap[ring_geom] + before[:-1] - before[first[ring_geom]]
    rings = np.diff(np.r_[np.flatnonzero(lead), len(lead)])
    data, rest = np.empty(int(offsets[-1]), np.uint8), np.ones(int(offsets[-1]), bool)

    def put(where, *fields):
        block = np.concatenate([np.ascontiguousarray(f).view(np.uint8).reshape(len(where), f.dtype.itemsize) for f in fields], axis=1)
        cells = where[:, None] + np.arange(block.shape[1])
        data[cells], rest[cells] = block, False

    little = np.ones(max(n, len(lead)), np.uint8)
    tops = offsets[:-1][wrap]
    put(tops, little[:len(tops)], np.where(polys[wrap] > 0, MULTIPOLYGON, COLLECTION).astype("<u4"), polys[wrap].astype("<u4"))
    put(at[lead], little[:len(rings)], np.full(len(rings), POLYGON, "<u4"), rings.astype("<u4"))
    put(at + 9 * lead, points.astype("<u4"))
    data[rest] = np.ascontiguousarray(xy, "<f8").view(np.uint8).ravel()
    return _binary_from(data, offsets, ok)


def encode_multipoints(n: int, xy: np.ndarray, owner: np.ndarray) -> pa.Array:
    """MultiPoints from points sorted by owner; null where an owner has none. One output buffer."""
    count = np.bincount(owner, minlength=n)
    ok = count > 0
    offsets = np.r_[0, np.cumsum(np.where(ok, 9 + 21 * count, 0))]
    head = np.zeros((int(ok.sum()), 9), np.uint8)
    head[:, 0], head[:, 1] = 1, MULTIPOINT
    head[:, 5:9] = np.ascontiguousarray(count[ok].astype("<u4")).view(np.uint8).reshape(-1, 4)
    rec = np.zeros((len(xy), 21), np.uint8)
    rec[:, 0], rec[:, 1] = 1, POINT
    rec[:, 5:] = np.ascontiguousarray(xy, "<f8").view(np.uint8).reshape(-1, 16)
    data, rest = np.empty(int(offsets[-1]), np.uint8), np.ones(int(offsets[-1]), bool)
    cells = offsets[:-1][ok][:, None] + np.arange(9)
    data[cells], rest[cells] = head, False
    data[rest] = rec.ravel()
    return _binary_from(data, offsets, ok)


def _binary_from(data: np.ndarray, offsets: np.ndarray, ok: np.ndarray) -> pa.Array:
    n = len(offsets) - 1
    validity = pa.array(ok).buffers()[1] if not ok.all() else None
    return pa.Array.from_buffers(pa.binary(), n, [validity, pa.py_buffer(offsets.astype(np.int32)),
                                                  pa.py_buffer(data)], null_count=int((~ok).sum()))


def wkb_point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, POINT, x, y)


def wkb_polygon(rings) -> bytes:
    """WKB polygon from a list of rings (each a sequence of (x, y))."""
    out = [struct.pack("<BII", 1, POLYGON, len(rings))]
    for r in rings:
        r = np.asarray(r, np.float64).reshape(-1, 2)
        if len(r) and not (r[0] == r[-1]).all():
            r = np.vstack([r, r[:1]])
        out.append(struct.pack("<I", len(r)))
        out.append(np.ascontiguousarray(r).astype("<f8").tobytes())
    return b"".join(out)


def wkb_multipolygon(polys) -> bytes:
    return struct.pack("<BII", 1, MULTIPOLYGON, len(polys)) + b"".join(wkb_polygon(p) for p in polys)


def wkb_multipoint(points) -> bytes:
    return struct.pack("<BII", 1, MULTIPOINT, len(points)) + b"".join(wkb_point(x, y) for x, y in points)


def wkb_linestring(coords) -> bytes:
    c = np.asarray(coords, np.float64).reshape(-1, 2)
    return struct.pack("<BII", 1, LINESTRING, len(c)) + c.astype("<f8").tobytes()


EMPTY_COLLECTION = struct.pack("<BII", 1, COLLECTION, 0)


def encode(g: Geoms, xy: np.ndarray) -> pa.Array:
    """Every geometry of ``g`` with new coordinates: points and (multi)polygons by offsets, other types
    one by one (:func:`encode_geoms`)."""
    point = g.valid & (g.gtype == POINT)
    area = g.valid & ((g.gtype == POLYGON) | (g.gtype == MULTIPOLYGON))
    ring_off = g.ring_off
    first = np.zeros((g.n, 2))
    p = point[g.ring_geom]
    first[g.ring_geom[p]] = xy[ring_off[:-1][p]]
    points = encode_points(first[:, 0], first[:, 1], point)
    r = np.flatnonzero(area[g.ring_geom])
    keep = np.repeat(area[g.ring_geom], g.ring_len)
    polygons = encode_polygons(g.n, xy[keep], np.r_[0, np.cumsum(g.ring_len[r])], g.ring_geom[r], g.ring_poly[r], area, g.gtype == MULTIPOLYGON)
    out = pc.coalesce(points, polygons)
    if (point | area).all():
        return out
    other = ~(point | area)
    return pc.coalesce(out, pa.array([v if o else None for v, o in zip(encode_geoms(g, xy, other), other)], pa.binary()))


def encode_geoms(g: Geoms, xy: np.ndarray | None = None, only: np.ndarray | None = None) -> list:
    """Re-encode every geometry of ``g`` (optionally with new coordinates ``xy``, or only some: others None).

    Keeps the top-level type: Point, LineString, Polygon, Multi* and
    GeometryCollection (members flattened to points, lines and polygons).
    """
    xy = g.xy if xy is None else xy
    gro = g.geom_ring_off()
    out: list = []
    for i in range(g.n):
        if only is not None and not only[i]:
            out.append(None)
            continue
        if not g.valid[i]:
            out.append(EMPTY_COLLECTION if g.empty[i] else None)
            continue
        rs = range(gro[i], gro[i + 1])
        rings = [(xy[g.ring_off[r]:g.ring_off[r + 1]], int(g.ring_kind[r]), int(g.ring_poly[r])) for r in rs]
        t = int(g.gtype[i])
        polys: dict = {}
        for a, kind, pid in rings:
            if kind in (K_SHELL, K_HOLE):
                polys.setdefault(pid, []).append(a)
        if t == POINT:
            out.append(wkb_point(*rings[0][0][0]))
        elif t == LINESTRING:
            out.append(wkb_linestring(rings[0][0]))
        elif t == POLYGON:
            out.append(wkb_polygon(next(iter(polys.values()))))
        elif t == MULTIPOINT:
            out.append(wkb_multipoint([tuple(a[0]) for a, _, _ in rings]))
        elif t == MULTIPOLYGON:
            out.append(wkb_multipolygon(list(polys.values())))
        elif t == MULTILINESTRING:
            out.append(struct.pack("<BII", 1, MULTILINESTRING, len(rings)) +
                       b"".join(wkb_linestring(a) for a, _, _ in rings))
        else:
            parts = [wkb_point(*a[0]) for a, k, _ in rings if k == K_POINT]
            parts += [wkb_linestring(a) for a, k, _ in rings if k == K_LINE]
            parts += [wkb_polygon(p) for p in polys.values()]
            out.append(struct.pack("<BII", 1, COLLECTION, len(parts)) + b"".join(parts))
    return out


def from_geojson(obj) -> bytes | None:
    """WKB from a parsed GeoJSON geometry dict (Point, LineString, Polygon, Multi*)."""
    if not obj:
        return None
    t = obj.get("type")
    c = obj.get("coordinates")
    if t == "Point":
        return wkb_point(float(c[0]), float(c[1]))
    if t == "LineString":
        return wkb_linestring([p[:2] for p in c])
    if t == "Polygon":
        return wkb_polygon([[p[:2] for p in ring] for ring in c])
    if t == "MultiPoint":
        return wkb_multipoint([(p[0], p[1]) for p in c])
    if t == "MultiPolygon":
        return wkb_multipolygon([[[p[:2] for p in ring] for ring in poly] for poly in c])
    if t == "MultiLineString":
        return struct.pack("<BII", 1, MULTILINESTRING, len(c)) + b"".join(
            wkb_linestring([p[:2] for p in line]) for line in c)
    return None
