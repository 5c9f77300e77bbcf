"""The county index on several levels against the exact kernel on all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footmark.functions import kernels as K
from footmark.functions import wkb as W
from footmark.operators.counties import CountyIndex, county_of, county_pairs, mask_by_county


def shapes(rng):
    """Counties that aren't boxes: triangles on the grid's diagonal, a star, one with a hole and one in the hole, a
    tiny one, and two that share a slanted border."""
    turn = np.linspace(0, 2 * np.pi, 41)[:-1]
    star = [(30000 + (9000 if i % 2 else 3000) * np.cos(t), 9000 + (9000 if i % 2 else 3000) * np.sin(t)) for i, t in enumerate(turn)]
    wild = [(60000 + r * np.cos(t), 10000 + r * np.sin(t)) for r, t in zip(rng.uniform(2000, 9000, 60), np.linspace(0, 2 * np.pi, 61)[:-1])]
    ring = [(0, 30000), (20000, 30000), (20000, 50000), (0, 50000)]
    hole = [(5000, 35000), (5000, 45000), (15000, 45000), (15000, 35000)]
    return {"01001": [[(0, 0), (16000, 0), (16000, 16000)]], "01002": [[(0, 0), (16000, 16000), (0, 16000)]], "02001": [star], "02003": [wild],
            "03001": [ring, hole], "03003": [[(5000, 35000), (15000, 35000), (15000, 45000), (5000, 45000)]],
            "04001": [[(40001.5, 40001.25), (40003.5, 40001.25), (40002.5, 40003.75)]],
            "05001": [[(50000, 30000), (57000, 30000), (61000, 44000), (50000, 44000)]], "05003": [[(57000, 30000), (70000, 30000), (70000, 44000), (61000, 44000)]]}


def box(x0, y0, x1, y1):
    return W.wkb_polygon([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(12)
    counties = {f: W.wkb_polygon(r) for f, r in shapes(rng).items()}
    feats = [W.wkb_point(x, y) for x, y in rng.uniform((-3000, -3000), (73000, 53000), (700, 2))]
    feats += [W.wkb_point(float(t), float(t)) for t in range(0, 16001, 250)]                 # on a diagonal border and its ends
    feats += [W.wkb_point(57000 + 4000 * t, 30000 + 14000 * t) for t in (0, 0.25, 0.5, 0.75, 1)]
    feats += [W.wkb_point(x, y) for r in shapes(np.random.default_rng(12)).values() for ring in r for x, y in ring]
    for s in (15, 300, 2500, 9000):
        feats += [box(x, y, x + s, y + s / 3) for x, y in rng.uniform((-3000, -3000), (73000, 53000), (150, 2))]
        feats += [W.wkb_polygon([[(x, y), (x + s, y + s / 2), (x + s / 3, y + s)]]) for x, y in rng.uniform((-3000, -3000), (73000, 53000), (100, 2))]
    feats += [W.wkb_linestring([(x, y), (x + 700, y + 300), (x + 100, y + 900)]) for x, y in rng.uniform((0, 0), (70000, 50000), (80, 2))]
    feats += [box(39990, 39990, 40020, 40020), box(-500000, 9000, 500000, 9050), box(-500000, -500000, 500000, 500000), box(-9000, -9000, -10, 60000),
              W.wkb_polygon([[(-90000, -90000), (90000, -90000), (90000, -89000), (-89000, -89000), (-89000, 90000), (-90000, 90000)]]), None, b"\x00bad"]
    frame = spark.createDataFrame([(i, f) for i, f in enumerate(feats)], "id int, geometry binary").repartition(4)
    layer = spark.createDataFrame(list(counties.items()), "fips string, geometry binary")
    return feats, counties, frame, layer


def hits(feats, counties):
    out = set()
    g = W.decode(pa.array(feats, pa.binary()))
    for fips, c in counties.items():
        _, hit = K.distance_and_intersects(g, W.decode(pa.array([c] * len(feats), pa.binary())))
        out |= {(int(i), fips) for i in np.flatnonzero(hit & g.valid)}
    return out


@pytest.mark.parametrize("grid", [None, 40.0, 20000.0])
def test_mask_of_slanted_counties(world, grid):
    feats, counties, frame, layer = world
    got = [(r["id"], r["fips"]) for r in mask_by_county(frame, CountyIndex(layer, grid)).collect()]
    assert len(got) == len(set(got)) and set(got) == hits(feats, counties)


def test_points_and_rows_per_feature(world):
    feats, counties, frame, layer = world
    index = CountyIndex(layer)
    got = {r["id"]: r["fips"] for r in county_of(frame, index).collect()}
    x, y = K.centroid(W.decode(pa.array(feats, pa.binary())))
    points = [None if np.isnan(a) else W.wkb_point(a, b) for a, b in zip(x, y)]
    want: dict = {}
    for i, fips in hits(points, counties):
        want[i] = min(fips, want.get(i, "99"))
    assert got == {i: want.get(i) for i in range(len(feats))}
    pairs = county_pairs(frame, index)
    assert pairs.groupBy("id", "fips").count().filter("count > 1").count() == 0
    # what goes to the exact test of a small feature is a few edges, not a county
    sent = pairs.filter(F.col("__edges").isNotNull()).agg(F.avg(F.length("__edges"))).first()[0]
    assert sent < 32 * 12
    assert pairs.filter(F.col("county_geometry").isNotNull() & (F.length("geometry") == 21)).count() == 0


def test_empty_layers(spark, world):
    _, _, frame, layer = world
    assert mask_by_county(frame, CountyIndex(layer.limit(0))).count() == 0
    assert mask_by_county(frame.limit(0), CountyIndex(layer)).count() == 0
