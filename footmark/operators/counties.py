"""County operators: spatial mask on read (S2), point-in-county (J9), code lookup (J10),
state geometry and bounds (A3, A4).

The county layer is a fixed reference table (about 3,200 US counties, ~11 MB
of GeoJSON), not something that grows with the data. It is cut into cells of
several grid levels; a feature looks up one cell a level. The county side
is broadcast only after its size is checked against a bound; above it
the join is a normal shuffle join.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Column

from ..functions.geometry import st_centroid, st_intersects, with_bbox
from ..functions import kernels as K
from ..functions import wkb as W
from .county_cells import CELL, FACTOR, SHIFT_X, SHIFT_Y, cell_batches, local_hit

COUNTY_GRID = 2_500.0
MAX_BROADCAST_COUNTY_CELL_BYTES = 256 * 1024 * 1024
#: Bytes of a cell row in a hash relation besides its edges: the values, the code, row and hash overhead.
CELL_ROW_BYTES = 160
MAX_BROADCAST_GEOMETRY_BYTES = 256 * 1024 * 1024
#: Cells that the finest level may take by estimate, when it follows the narrow side of the counties.
FINE_CELLS = 300_000
#: Boxes in one pushed filter; of more counties the box around all is pushed.
MAX_PUSHED_BOXES = 64


class CountyIndex:
    """Counties prepared for lookups, materialised once per job.

    ``cells``: the cover of each county on several grid levels (see
    :mod:`~footmark.operators.county_cells`): inside cells as coarse as they can be, crossed cells down
    to the finest level, where they hold the few boundary edges that cross them. ``shapes``: one
    row per county with its polygon, for features that are larger than the finest cell and lie
    on a county line.

    The finest cell defaults to a sixteenth of the median county extent (clamped to 125 m .. 4 km), for
    long and narrow counties to less (:func:`finest_cell`): a cell has to fit in to be inside.
    Both sides are broadcast only after their size is checked once (cell rows and edges, polygon
    bytes); above the bounds the joins shuffle.
    """

    def __init__(self, counties: DataFrame, grid: float | None = None):
        from .correspondence import checkpoint
        c = with_bbox(counties.select("fips", F.col("geometry").alias("county_geometry")),
                      "county_geometry", prefix="c_")
        c = checkpoint(c.filter(F.col("c_xmin").isNotNull()))
        ext = F.greatest(F.col("c_xmax") - F.col("c_xmin"), F.col("c_ymax") - F.col("c_ymin"))
        wide, high = F.col("c_xmax") - F.col("c_xmin"), F.col("c_ymax") - F.col("c_ymin")
        r = c.agg(F.percentile_approx(ext, 0.5).alias("median"), F.percentile_approx(F.least(wide, high), 0.5).alias("narrow"),
                  F.sum(wide * high).alias("area"), F.sum(2 * (wide + high)).alias("line"), F.min("c_xmin").alias("x0"), F.min("c_ymin").alias("y0"),
                  F.max("c_xmax").alias("x1"), F.max("c_ymax").alias("y1"), F.sum(F.length("county_geometry")).alias("bytes"),
                  F.countDistinct("fips").alias("n")).first()
        few = c.select("c_xmin", "c_ymin", "c_xmax", "c_ymax").limit(MAX_PUSHED_BOXES + 1).collect()
        self.bounds = (r["x0"] or 0.0, r["y0"] or 0.0, r["x1"] or 0.0, r["y1"] or 0.0)
        #: boxes around the counties for a scan to take over: one each, or one around all if they are many
        self.boxes = [tuple(b) for b in few] if len(few) <= MAX_PUSHED_BOXES else [self.bounds]
        self.grid = grid or finest_cell(r["median"] or COUNTY_GRID * 16, r["narrow"] or 0.0, r["area"] or 0.0, r["line"] or 0.0)
        whole = max(self.bounds[2] - self.bounds[0], self.bounds[3] - self.bounds[1])
        self.top = 0
        while self.grid * FACTOR ** self.top < whole:
            self.top += 1
        spread = max(1, min(int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")), r["n"]))
        cells = c.select("fips", "county_geometry").repartition(spread, "fips") \
            .mapInArrow(partial(cell_batches, base=self.grid, top=self.top), CELL)
        boxes = c.select(F.col("fips").alias("__bfips"), "c_xmin", "c_ymin", "c_xmax", "c_ymax")
        self.cells = checkpoint(cells.join(F.broadcast(boxes), F.col("fips") == F.col("__bfips")).drop("__bfips"))
        self.shapes = c.select(F.col("fips").alias("__sfips"), "county_geometry")
        n = self.cells.agg(F.count("*").alias("n"), F.sum(F.length("edges")).alias("edges"),
                           F.collect_set(F.when(F.col("inside"), F.col("lvl"))).alias("inside")).first()
        self.n_cells, self.edge_bytes, self.inside_levels = n["n"], n["edges"] or 0, sorted(n["inside"])
        self.geometry_bytes = r["bytes"] or 0
        self.broadcastable = self.n_cells * CELL_ROW_BYTES + self.edge_bytes <= MAX_BROADCAST_COUNTY_CELL_BYTES
        self.shapes_broadcastable = self.geometry_bytes <= MAX_BROADCAST_GEOMETRY_BYTES

    def side(self) -> DataFrame:
        cells = self.cells.withColumnsRenamed({c: f"__{c}" for c in ("lvl", "cx", "cy", "inside", "edges", "corner")})
        return F.broadcast(cells) if self.broadcastable else cells

    def shape_side(self) -> DataFrame:
        return F.broadcast(self.shapes) if self.shapes_broadcastable else self.shapes


def finest_cell(extent: float, narrow: float, area: float, line: float) -> float:
    """Metres of the finest cell of counties with this median extent and narrow side, and boxes of this area and outline.

    A sixteenth of the extent. Where that is more than an eighth of the narrow side, hardly a cell would be inside a
    county and every feature would need the exact test: there it is that eighth, or as much more as keeps the cells few."""
    most = min(max(extent / 16.0, 125.0), 4_000.0)
    fine = max(narrow / 8.0, 125.0)
    while fine < most and area / fine ** 2 + 3 * line / fine > FINE_CELLS:
        fine *= 1.25
    return float(min(fine, most))


def county_index(counties, grid: float | None = None) -> CountyIndex:
    return counties if isinstance(counties, CountyIndex) else CountyIndex(counties, grid)


def county_pairs(features: DataFrame, counties, *, geometry: str = "geometry",
                 grid: float | None = None, keep_bbox: bool = False) -> DataFrame:
    """(feature, county) candidate pairs; one row per pair.

    ``counties`` is a county DataFrame or a prepared :class:`CountyIndex`. A feature looks up one cell
    on its home level (the finest whose cells are as large as its box) and one on each coarser level
    that has inside cells, so a bad coordinate costs no more rows than a good one; its box counts
    where the counties are. Adds ``fips``, ``__decided`` (true where an inside cell settles the pair,
    else null), the crossed cell's ``__edges`` and, for features above the finest level only,
    ``county_geometry``.
    """
    idx = county_index(counties, grid)
    f = with_bbox(features, geometry, prefix="f_")
    x0, y0, x1, y1 = (F.lit(v) for v in idx.bounds)
    f = f.filter((F.col("f_xmin") <= x1) & (F.col("f_xmax") >= x0) & (F.col("f_ymin") <= y1) & (F.col("f_ymax") >= y0))
    left, low = F.greatest(F.col("f_xmin"), x0), F.greatest(F.col("f_ymin"), y0)
    ext = F.greatest(F.least(F.col("f_xmax"), x1) - left, F.least(F.col("f_ymax"), y1) - low)
    home = F.lit(idx.top)
    for lvl in range(idx.top - 1, -1, -1):
        home = F.when(ext <= idx.grid * FACTOR ** lvl, F.lit(lvl)).otherwise(home)
    f = f.withColumn("__home", home)
    x, y = left - SHIFT_X * idx.grid, low - SHIFT_Y * idx.grid
    probes = F.array(*[F.struct(F.lit(lvl).alias("l"), F.floor(x / (idx.grid * FACTOR ** lvl)).alias("x"),
                                F.floor(y / (idx.grid * FACTOR ** lvl)).alias("y")) for lvl in range(idx.top + 1)])
    # chosen after the explode: plain conditions run in generated code, a lambda on the array does not
    f = f.withColumn("__at", F.explode(probes)) \
        .filter((F.col("__at.l") == F.col("__home")) | ((F.col("__at.l") > F.col("__home")) & F.col("__at.l").isin(idx.inside_levels)))
    j = f.join(idx.side(), (F.col("__at.l") == F.col("__lvl")) & (F.col("__at.x") == F.col("__cx")) & (F.col("__at.y") == F.col("__cy"))) \
        .filter((F.col("__inside") | (F.col("__lvl") == F.col("__home"))) &
                (F.col("f_xmin") <= F.col("c_xmax")) & (F.col("c_xmin") <= F.col("f_xmax")) &
                (F.col("f_ymin") <= F.col("c_ymax")) & (F.col("c_ymin") <= F.col("f_ymax")))
    # what reaches beyond the counties is only known by its shape
    whole = (F.col("f_xmin") >= x0) & (F.col("f_ymin") >= y0) & (F.col("f_xmax") <= x1) & (F.col("f_ymax") <= y1)
    j = j.withColumn("__decided", F.when(F.col("__inside") & whole, F.lit(True))) \
        .withColumn("__edges", F.when(whole & ~F.col("__inside"), F.col("__edges"))).withColumn("__base", F.lit(idx.grid))
    # the polygon only for the pairs that neither settles
    j = j.join(idx.shape_side(), (F.col("fips") == F.col("__sfips")) & F.col("__decided").isNull() & F.col("__edges").isNull(), "left")
    if keep_bbox:
        j = j.withColumnsRenamed({f"f_{c}": c for c in ("xmin", "ymin", "xmax", "ymax")})
    return j.drop("__at", "__home", "__lvl", "__inside", "f_xmin", "f_ymin", "f_xmax", "f_ymax",
                  "c_xmin", "c_ymin", "c_xmax", "c_ymax", "__sfips")


#: Columns of :func:`county_pairs` that only the exact test needs.
TEST_COLUMNS = ("county_geometry", "__decided", "__edges", "__cx", "__cy", "__corner", "__base")


def _exact(p: DataFrame, geometry: str) -> Column:
    """Decided pairs by flag, pairs at a crossed cell by its edges, the rest by the county's polygon."""
    near = local_hit(F.when(F.col("__edges").isNotNull(), F.col(geometry)), F.col("__edges"), F.col("__cx"), F.col("__cy"),
                     F.col("__corner"), F.col("__base"))
    far = st_intersects(F.when(F.col("county_geometry").isNotNull(), F.col(geometry)), F.col("county_geometry"))
    return F.coalesce(F.col("__decided"), near, far)


def mask_by_county(features: DataFrame, counties, *, geometry: str = "geometry",
                   grid: float | None = None, keep_bbox: bool = False) -> DataFrame:
    """Keep features that intersect a county polygon, tagged with its ``fips``.

    A feature on a county line lands in both counties, as with one mask per
    county. Features outside every county are dropped. ``keep_bbox`` keeps the
    feature box (``xmin, ymin, xmax, ymax``) computed for the lookup.
    """
    keep_bbox = keep_bbox and not any(c in features.columns for c in ("xmin", "ymin", "xmax", "ymax"))
    p = county_pairs(features, counties, geometry=geometry, grid=grid, keep_bbox=keep_bbox)
    return p.withColumn("__hit", _exact(p, geometry)).filter("__hit").drop(*TEST_COLUMNS, "__hit")


def county_of(features: DataFrame, counties, *, geometry: str = "geometry",
              grid: float | None = None, key: str = "id") -> DataFrame:
    """The county holding each feature's centroid (left join; null outside).

    On a shared border several counties hold the point; the smallest fips is
    taken (deterministic; the reference takes whichever its tree returns last).
    ``key`` must identify a feature row.
    """
    pts = features.select(key, st_centroid(F.col(geometry)).alias("__pt"))
    p = county_pairs(pts, counties, geometry="__pt", grid=grid)
    hit = p.withColumn("__hit", _exact(p, "__pt")).filter("__hit") \
        .groupBy(key).agg(F.min("fips").alias("fips"))
    return features.join(hit.hint("merge"), key, "left")  # as many rows as features: no broadcast


def county_code(state: Column, county: Column) -> Column:
    """Five-character county code of a state number and a county number (zero-padded)."""
    return F.concat(F.lpad(state.cast("string"), 2, "0"), F.lpad(county.cast("string"), 3, "0"))


def lookup_county(df: DataFrame, counties: DataFrame, code_col: str = "fips") -> DataFrame:
    """Attach county and state names by code; 2-character codes give the state.

    Unknown codes get nulls (use :func:`check_codes` to raise instead).
    """
    c = counties.select("fips", "county_name", "state_name", "state_abbr")
    states = c.select(F.substring("fips", 1, 2).alias("__st"), "state_name", "state_abbr").distinct()
    is_state = F.length(F.col(code_col)) == 2
    a = df.filter(~is_state | F.col(code_col).isNull()).join(
        c.withColumnRenamed("fips", "__code"), F.col(code_col) == F.col("__code"), "left").drop("__code")
    b = df.filter(is_state).join(states, F.col(code_col) == F.col("__st"), "left").drop("__st") \
        .withColumn("county_name", F.lit(None).cast("string"))
    return a.unionByName(b)


def check_codes(codes: DataFrame, counties: DataFrame, code_col: str = "fips") -> None:
    """J10 strict form: raise KeyError with the number of unknown state or county codes and up to 20 of them."""
    known = counties.select(F.col("fips").alias("__k")).union(
        counties.select(F.substring("fips", 1, 2).alias("__k")))
    bad = codes.join(known, F.col(code_col) == F.col("__k"), "left_anti").select(code_col)
    shown = bad.limit(20).collect()
    if shown:
        raise KeyError(f"{bad.count()} unknown codes, among them {[r[0] for r in shown]}")


def states(counties: DataFrame) -> DataFrame:
    """A3 + A4: one row per state: fips, name, abbreviation, bounds, union geometry and area.

    Bounds are plain min/max aggregates. Counties tile the state: edges that two members share
    cancel in an aggregation on their undirected ends, with partial sums before the shuffle, and only
    the remaining outline of a state meets in one task, which chains it into rings (gaps between
    counties are holes). Its area is the sum of county areas (a coverage).
    """
    c = with_bbox(counties, "geometry", area=True).withColumn("state_fips", F.substring("fips", 1, 2))
    bounds = c.groupBy("state_fips").agg(
        F.first("state_name").alias("state_name"), F.first("state_abbr").alias("state_abbr"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        F.sum("area").alias("area"), F.count("*").alias("n_counties"))
    geoms = outline(c, "state_fips").groupBy("state_fips").applyInPandas(
        _chain, schema="state_fips string, geometry binary")
    return bounds.join(geoms, "state_fips", "left")


def outline(df: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """Edges (``key``, ax, ay, bx, by) on the outline of the coverage that the polygons of each key form.

    Shells run counter-clockwise and holes clockwise, so an edge that two members share occurs once
    in each direction and the two cancel; one that remains runs with the inside on its left. An edge
    that several polygons leave over is repeated."""
    e = df.select(F.col(key).cast("string").alias(key), geometry) \
        .mapInArrow(_edge_batches, f"`{key}` string, x0 double, y0 double, x1 double, y1 double")
    forward = (F.col("x0") < F.col("x1")) | ((F.col("x0") == F.col("x1")) & (F.col("y0") < F.col("y1")))
    ends = [F.when(forward, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in
            (("x0", "x1", "lx"), ("y0", "y1", "ly"), ("x1", "x0", "hx"), ("y1", "y0", "hy"))]
    e = e.filter((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1"))) \
        .select(key, *ends, F.when(forward, 1).otherwise(-1).alias("way"))
    left = e.groupBy(key, "lx", "ly", "hx", "hy").agg(F.sum("way").alias("way")).filter("way <> 0")
    ahead = F.col("way") > 0
    left = left.select(key, *[F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in
                              (("lx", "hx", "ax"), ("ly", "hy", "ay"), ("hx", "lx", "bx"), ("hy", "ly", "by"))],
                       F.explode(F.array_repeat(F.lit(0), F.abs("way").cast("int"))).alias("copy"))
    return left.drop("copy")


def _edge_batches(batches):
    """The directed edges of the polygons of each Arrow batch of (key, WKB)."""
    for batch in batches:
        at, edges = [np.zeros(0, np.int64)], [np.zeros((0, 4))]
        for i, parts in enumerate(K.polygons_of(W.decode(batch.column(1).to_pylist()))):
            for rings in parts or []:
                for number, ring in enumerate(rings):
                    r = np.asarray(ring, np.float64)[:, :2]
                    d = r - r[0]
                    area = float(np.sum(d[:-1, 0] * d[1:, 1] - d[1:, 0] * d[:-1, 1]))
                    if (area < 0) == (number == 0):
                        r = r[::-1]
                    edges.append(np.hstack([r[:-1], r[1:]]))
                    at.append(np.full(len(r) - 1, i))
        xy = np.concatenate(edges)
        yield pa.record_batch([batch.column(0).take(pa.array(np.concatenate(at))), *[pa.array(xy[:, k]) for k in range(4)]],
                              names=[batch.schema.names[0], "x0", "y0", "x1", "y1"])


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Polygon or multipolygon of the outline edges of one key; the order of the edges doesn't matter."""
    ends = pdf[["ax", "ay", "bx", "by"]].sort_values(["ax", "ay", "bx", "by"]).to_numpy()
    follow: dict = {}
    for ax, ay, bx, by in ends[::-1].tolist():
        follow.setdefault((ax, ay), []).append((bx, by))
    rings = []
    while follow:
        start = next(iter(follow))
        ring = [start]
        while ring[-1] in follow:
            at = ring[-1]
            ring.append(follow[at].pop())
            if not follow[at]:
                del follow[at]
            if ring[-1] == start:
                break
        if len(ring) >= 4 and ring[0] == ring[-1]:
            rings.append(ring)
    geom = W.wkb_multipolygon(_with_holes(rings)) if len(rings) > 1 else W.wkb_polygon(rings) if rings else None
    return pd.DataFrame({"state_fips": [pdf.iloc[0, 0]], "geometry": [geom]})


def _with_holes(rings: list) -> list:
    """Polygons of directed rings: counter-clockwise ones are shells, clockwise ones holes of the
    smallest shell around them."""
    arrays = [np.asarray(r, np.float64) for r in rings]
    areas = [float(np.sum((r[:-1, 0] - r[0, 0]) * (r[1:, 1] - r[0, 1])
                          - (r[1:, 0] - r[0, 0]) * (r[:-1, 1] - r[0, 1])) / 2) for r in arrays]
    shells = sorted((i for i, a in enumerate(areas) if a > 0), key=lambda i: areas[i])
    polys = {i: [rings[i]] for i in shells}
    for i, area in enumerate(areas):
        if area >= 0:
            continue
        # the middle of an edge lies on no other ring of the union
        x, y = (arrays[i][0] + arrays[i][1]) / 2
        around = (s for s in shells if areas[s] >= -area and _inside(arrays[s], x, y))
        polys[next(around, shells[-1])].append(rings[i])
    return list(polys.values())


def _inside(ring: np.ndarray, x: float, y: float) -> bool:
    """Even-odd rule."""
    x1, y1, x2, y2 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    span = (y1 > y) != (y2 > y)
    at = x1[span] + (y - y1[span]) * (x2[span] - x1[span]) / (y2[span] - y1[span])
    return bool(np.count_nonzero(at > x) % 2)
