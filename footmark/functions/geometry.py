"""Geometry column functions over WKB ``BinaryType`` columns.

Each function is an Arrow-batched UDF (``arrow_udf``): Spark ships a batch of
WKB values as one Arrow array, the batch is decoded once and the numpy kernels
run over the whole batch. Nulls in, nulls out; NaN results become null (the
centroid of a null geometry is null here, not NaN).

Everything that does not need the coordinates themselves (bounding-box tests,
thresholds, joins) stays in JVM expressions: compute the box once per layer
with :func:`with_bbox` and filter on those columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from . import kernels as K
from . import wkb as W


def _doubles(*names) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


BBOX_TYPE = _doubles("xmin", "ymin", "xmax", "ymax")
ENVELOPE_TYPE = _doubles("xmin", "ymin", "xmax", "ymax", "area")
XY_TYPE = _doubles("x", "y")
DOUBLE = T.DoubleType()
BINARY = T.BinaryType()
BOOLEAN = T.BooleanType()
BINARY_ARRAY = T.ArrayType(T.BinaryType())


def _f64(a: np.ndarray) -> pa.Array:
    a = np.asarray(a, np.float64)
    return pa.array(a, type=pa.float64(), mask=np.isnan(a))


def _struct(names, arrays, valid=None) -> pa.Array:
    fields = [_f64(a) for a in arrays]
    mask = None if valid is None else pa.array(~np.asarray(valid, bool))
    return pa.StructArray.from_arrays(fields, names=names, mask=mask)


def _binary_list(items) -> pa.Array:
    """List<binary> from a python list of (list of bytes | None)."""
    return pa.array(items, type=pa.list_(pa.binary()))


# --------------------------------------------------------------------------- unary


@arrow_udf(DOUBLE)
def st_area(g: pa.Array) -> pa.Array:
    """Unsigned planar area; points and lines 0; null -> null."""
    return _f64(K.area(W.decode(g)))


@arrow_udf(BBOX_TYPE)
def st_bbox(g: pa.Array) -> pa.Array:
    """Bounding rectangle (xmin, ymin, xmax, ymax); null for null/empty."""
    d = W.decode(g)
    b = K.bbox(d)
    return _struct(["xmin", "ymin", "xmax", "ymax"], b, valid=d.valid)


def _envelope(g: pa.Array) -> pa.Array:
    d = W.decode(g)
    b = K.bbox(d)
    return _struct(["xmin", "ymin", "xmax", "ymax", "area"], list(b) + [K.area(d)], valid=d.valid)


# Bounding rectangle and area in one decode (used by :func:`with_bbox`).
# Marked non-deterministic only so that Catalyst keeps it in one place: a
# filter on the box is otherwise pushed below the projection and the UDF
# (and the geometry constructors under it) would run twice.
st_envelope = arrow_udf(_envelope, ENVELOPE_TYPE).asNondeterministic()


@arrow_udf(DOUBLE)
def st_centroid_x(g: pa.Array) -> pa.Array:
    """X of the centroid; null for null geometry (not NaN)."""
    return _f64(K.centroid(W.decode(g))[0])


@arrow_udf(DOUBLE)
def st_centroid_y(g: pa.Array) -> pa.Array:
    """Y of the centroid; null for null geometry (not NaN)."""
    return _f64(K.centroid(W.decode(g))[1])


@arrow_udf(XY_TYPE)
def st_centroid_xy(g: pa.Array) -> pa.Array:
    """G5+G6 in one decode: struct(x, y)."""
    d = W.decode(g)
    cx, cy = K.centroid(d)
    return _struct(["x", "y"], [cx, cy], valid=d.valid)


@arrow_udf(BINARY)
def st_centroid(g: pa.Array) -> pa.Array:
    """Centroid as a WKB point; null stays null."""
    cx, cy = K.centroid(W.decode(g))
    return W.encode_points(cx, cy)


@arrow_udf(BINARY)
def st_point(x: pa.Array, y: pa.Array) -> pa.Array:
    """WKB point from x / y columns (null when either is null)."""
    xv = np.asarray(x.to_numpy(zero_copy_only=False), np.float64)
    yv = np.asarray(y.to_numpy(zero_copy_only=False), np.float64)
    return W.encode_points(xv, yv)


@arrow_udf(BINARY)
def st_box(xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array) -> pa.Array:
    """WKB axis-aligned rectangle from its bounds."""
    vals = [np.asarray(v.to_numpy(zero_copy_only=False), np.float64) for v in (xmin, ymin, xmax, ymax)]
    return W.encode_boxes(*vals)


@arrow_udf(BINARY)
def st_polygon(ring: pa.Array) -> pa.Array:
    """WKB polygon of one ring from its coordinates x, y, x, y, ... (not closed; null where null or shorter
    than three points)."""
    n = np.where(ring.is_valid(), pa.compute.fill_null(pa.compute.list_value_length(ring), 0), 0) // 2
    ok = n >= 3
    n = np.where(ok, n, 0)
    return W.encode_rings(np.asarray(ring.filter(pa.array(ok)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, 2), n)


@arrow_udf(BOOLEAN)
def st_is_valid_wkb(g: pa.Array) -> pa.Array:
    """True when the value decodes to a non-empty geometry."""
    return pa.array(W.decode(g).valid)


@arrow_udf(BINARY_ARRAY)
def st_points(g: pa.Array) -> pa.Array:
    """G10 helper: every coordinate of the geometry as a WKB point.

    Polygon vertices count too (closing vertex included). Null -> null, so
    ``explode_outer`` keeps one null row.
    """
    d = W.decode(g)
    x, y, off = K.points_of(d)
    pts = W.encode_points(x, y)
    lens = np.diff(off)
    offsets = pa.array(off.astype(np.int32))
    mask = pa.array(~(d.valid | d.empty))
    return pa.ListArray.from_arrays(offsets, pts, mask=mask) if len(d.valid) else _binary_list([])


@arrow_udf(BINARY_ARRAY)
def st_polygons(g: pa.Array) -> pa.Array:
    """G11 helper: parts of a (multi)polygon as WKB polygons.

    A polygon gives itself; null gives null; any other type raises.
    """
    d = W.decode(g)
    K.check_polygons(d)
    lead = np.r_[True, d.ring_poly[1:] != d.ring_poly[:-1]][:len(d.ring_poly)]
    part = np.cumsum(lead) - 1
    off = np.searchsorted(d.ring_geom[lead], np.arange(d.n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), W.encode_polygons(int(lead.sum()), d.xy, d.ring_off, part, part),
                                    mask=pa.array(~(d.valid | d.empty)))


# --------------------------------------------------------------------------- binary


def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    d, _ = K.distance_and_intersects(W.decode(a), W.decode(b))
    return _f64(d)


# Planar minimum distance, 0 when the shapes intersect; null if either is null.
st_distance = arrow_udf(_distance, DOUBLE)
# The same function for operator internals: evaluated exactly once per row even
# when a filter on its result is pushed down (see :data:`st_envelope`).
st_distance_once = arrow_udf(_distance, DOUBLE).asNondeterministic()


@arrow_udf(BOOLEAN)
def st_intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact intersects (boundary contact counts); null if either is null."""
    da, db = W.decode(a), W.decode(b)
    _, hit = K.distance_and_intersects(da, db)
    return pa.array(hit, mask=~(da.valid & db.valid))


@arrow_udf(DOUBLE)
def st_intersection_area(a: pa.Array, b: pa.Array) -> pa.Array:
    """Fused ``area(intersection(a, b))`` (J4); no WKB is re-encoded."""
    return _f64(K.intersection_area(W.decode(a), W.decode(b)))


OVERLAP_TYPE = T.StructType([
    T.StructField("intersects", T.BooleanType()),
    T.StructField("area_intersection", T.DoubleType()),
    T.StructField("area_left", T.DoubleType()),
    T.StructField("area_right", T.DoubleType()),
])


def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    da, db = W.decode(a), W.decode(b)
    _, hit = K.distance_and_intersects(da, db)
    ok = da.valid & db.valid
    fields = [pa.array(hit, mask=~ok), _f64(K.intersection_area(da, db)), _f64(K.area(da)), _f64(K.area(db))]
    return pa.StructArray.from_arrays(fields, names=["intersects", "area_intersection", "area_left",
                                                      "area_right"], mask=pa.array(~ok))


# J1 refine + J4 inputs in one decode of both sides: struct(intersects,
# area_intersection, area_left, area_right); null when either side is null.
# Evaluated once per candidate pair (non-deterministic flag, see st_envelope).
st_overlap = arrow_udf(_overlap, OVERLAP_TYPE).asNondeterministic()


@arrow_udf(BINARY)
def st_intersection(a: pa.Array, b: pa.Array) -> pa.Array:
    """Pairwise intersection as WKB.

    Valid simple rings (internal edges dissolved, holes kept): a Polygon, or a MultiPolygon of several
    parts. No overlap gives an empty GeometryCollection (area 0); null if either is null.
    """
    da, db = W.decode(a), W.decode(b)
    return W.encode_polygons(da.n, *K.intersection_rings(da, db), ok=(da.empty | da.valid) & (db.empty | db.valid))


@arrow_udf(BINARY)
def st_collect(parts: pa.Array) -> pa.Array:
    """Combine an array of polygons into one MultiPolygon (points into a MultiPoint).

    Null elements are skipped; a null or empty array gives null.
    """
    flat = parts.flatten()
    n = len(parts)
    owner = np.repeat(np.arange(n), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(parts), 0)))
    there = np.asarray(flat.is_valid())
    g, owner = W.decode(flat.filter(pa.array(there))), owner[there]
    is_point = g.valid & (g.gtype == W.POINT)
    points = np.bincount(owner[is_point], minlength=n) == np.bincount(owner, minlength=n)  # nothing but points
    K.check_polygons(g, ~points[owner])
    which = points[owner[g.ring_geom]]
    keep = np.repeat(which, g.ring_len)
    rings = np.flatnonzero(~which)
    ok = np.bincount(owner[g.ring_geom[rings]], minlength=n) > 0
    return pa.compute.coalesce(
        W.encode_multipoints(n, g.xy[keep], owner[g.ring_geom[which]]),
        W.encode_polygons(n, g.xy[~keep], np.r_[0, np.cumsum(g.ring_len[rings])], owner[g.ring_geom[rings]],
                          np.cumsum(np.r_[0, np.diff(g.ring_poly[rings]) != 0])[:len(rings)], ok, multi=True))


@arrow_udf(BINARY)
def st_transform_to_5070(g: pa.Array) -> pa.Array:
    """Reproject WKB from geographic degrees (EPSG:4326, x = lon) to EPSG:5070 metres."""
    from .projection import albers_forward_np
    d = W.decode(g)
    x, y = albers_forward_np(d.xy[:, 0], d.xy[:, 1]) if len(d.xy) else (d.xy[:, 0], d.xy[:, 1])
    return W.encode(d, np.c_[x, y])


@arrow_udf(BINARY)
def st_transform_to_4326(g: pa.Array) -> pa.Array:
    """P3 inverse: EPSG:5070 metres to geographic degrees (x = lon, y = lat)."""
    from .projection import albers_inverse_np
    d = W.decode(g)
    x, y = albers_inverse_np(d.xy[:, 0], d.xy[:, 1]) if len(d.xy) else (d.xy[:, 0], d.xy[:, 1])
    return W.encode(d, np.c_[x, y])


@arrow_udf(BINARY)
def st_from_geojson(text: pa.Array) -> pa.Array:
    """WKB from GeoJSON geometry text (one small JSON parse per value)."""
    import json
    out = []
    for t in text.to_pylist():
        try:
            out.append(W.from_geojson(json.loads(t)) if t else None)
        except (ValueError, TypeError, KeyError, IndexError):
            out.append(None)
    return pa.array(out, type=pa.binary())


# --------------------------------------------------------------------------- helpers


def with_bbox(df: DataFrame, geometry: str = "geometry", prefix: str = "",
              area: bool = False) -> DataFrame:
    """Add ``xmin, ymin, xmax, ymax`` (and ``area``) columns in one UDF pass.

    Call once per layer; later filters and joins on the box run as JVM
    expressions inside whole-stage codegen.
    """
    tmp = "__env"
    out = df.withColumn(tmp, st_envelope(F.col(geometry)))
    cols = {f"{prefix}{k}": F.col(f"{tmp}.{k}") for k in ("xmin", "ymin", "xmax", "ymax")}
    if area:
        cols[f"{prefix}area"] = F.col(f"{tmp}.area")
    return out.withColumns(cols).drop(tmp)


def centroid_xy_cols(geometry: Column | str, x: str = "x", y: str = "y") -> list[Column]:
    c = st_centroid_xy(F.col(geometry) if isinstance(geometry, str) else geometry)
    return [c["x"].alias(x), c["y"].alias(y)]
