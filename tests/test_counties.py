"""County mask, lookup, names and state bounds on hand-made counties (leading zeros kept)."""

import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.functions.geometry import st_area
from footmark.operators import counties as C
from footmark.operators.counties import (check_codes, county_index, county_of, lookup_county, mask_by_county,
                                         states)

SAC = (-2173811.0344732204, 2020779.6029776197)
SB = (-2152236.043699582, 1532664.814801817)


def box(x0, y0, x1, y1):
    return W.wkb_polygon([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])


@pytest.fixture(scope="module")
def counties(spark):
    rows = [("06067", "Sacramento", "California", "CA", box(-2180000, 2010000, -2172000, 2030000)),
            ("06061", "Placer", "California", "CA", box(-2172000, 2010000, -2160000, 2030000)),
            ("06083", "Santa Barbara", "California", "CA", box(-2160000, 1520000, -2140000, 1540000))]
    return spark.createDataFrame(rows, "fips string, county_name string, state_name string, state_abbr string, "
                                 "geometry binary")


def test_point_lookup(spark, counties):
    pts = spark.createDataFrame([("sac", W.wkb_point(*SAC)), ("sb", W.wkb_point(*SB)),
                                 ("none", W.wkb_point(10407017.312142532, 3395226.1665611123)),
                                 ("border", W.wkb_point(-2172000.0, 2020000.0))], "id string, geometry binary")
    got = {r["id"]: r["fips"] for r in county_of(pts, counties).collect()}
    assert got == {"sac": "06067", "sb": "06083", "none": None, "border": "06061"}


def test_mask_keeps_border_features_in_both(spark, counties):
    feats = spark.createDataFrame([("a", box(-2172010, 2020000, -2171990, 2020010)),
                                   ("b", box(-2175000, 2020000, -2174990, 2020010)),
                                   ("c", box(0, 0, 1, 1))], "id string, geometry binary")
    got = sorted((r["id"], r["fips"]) for r in mask_by_county(feats, counties).collect())
    assert got == [("a", "06061"), ("a", "06067"), ("b", "06067")]


def test_lookup_names_and_codes(spark, counties):
    codes = spark.createDataFrame([("06083",), ("06",), ("99999",)], "fips string")
    got = {r["fips"]: (r["county_name"], r["state_abbr"]) for r in lookup_county(codes, counties).collect()}
    assert got == {"06083": ("Santa Barbara", "CA"), "06": (None, "CA"), "99999": (None, None)}
    check_codes(spark.createDataFrame([("06",), ("06067",)], "fips string"), counties)
    with pytest.raises(KeyError):
        check_codes(spark.createDataFrame([("00",), ("06999",)], "fips string"), counties)


def test_state_bounds_and_union(spark, counties):
    from footmark.functions.geometry import st_area
    r = states(counties).withColumn("union_area", st_area("geometry")).collect()[0]
    assert r["state_fips"] == "06" and r["n_counties"] == 3
    assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) == (-2180000, 1520000, -2140000, 2030000)
    assert r["union_area"] == pytest.approx(r["area"])


def test_read_counties_geojson(spark, tmp_path):
    import gzip
    import json

    from footmark.functions.geometry import st_bbox
    from footmark.functions.projection import albers_inverse_np
    import numpy as np
    lon, lat = albers_inverse_np(np.array([-2180000.0, -2172000.0]), np.array([2010000.0, 2030000.0]))
    ring = [[lon[0], lat[0]], [lon[1], lat[0]], [lon[1], lat[1]], [lon[0], lat[1]], [lon[0], lat[0]]]
    feat = {"type": "Feature", "properties": {"fips": "06067", "name": "Sacramento", "state": "California",
                                              "abbr": "CA"},
            "geometry": {"type": "Polygon", "coordinates": [ring]}}
    p = tmp_path / "fips.geojson.gz"
    with gzip.open(p, "wt") as f:
        f.write(json.dumps(feat) + "\n")
    from footmark.sources.counties import read_counties
    df = read_counties(spark, str(p))
    from footmark.functions.geometry import st_centroid_xy, st_points
    r = df.select("fips", "county_name",
                  st_centroid_xy(F.element_at(st_points("geometry"), 1)).alias("p")).collect()[0]
    assert r["fips"] == "06067" and r["county_name"] == "Sacramento"
    # the first corner comes back to the metres it was made from (sub-millimetre)
    assert r["p"]["x"] == pytest.approx(-2180000.0, abs=1e-3)
    assert r["p"]["y"] == pytest.approx(2010000.0, abs=1e-3)


def test_state_union_keeps_gaps_as_holes(spark):
    # eight unit squares around a gap, and one more square by itself
    cells = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)] + [(7, 7)]
    rows = [(f"01{i:03d}", "c", "s", "ST", box(x, y, x + 1, y + 1)) for i, (x, y) in enumerate(cells)]
    cs = spark.createDataFrame(rows, "fips string, county_name string, state_name string, state_abbr string, geometry binary")
    r = states(cs).select("area", st_area("geometry").alias("union_area")).collect()
    assert [tuple(x) for x in r] == [(9.0, 9.0)]


def test_county_sides_above_the_broadcast_bound(spark, counties, monkeypatch):
    feats = spark.createDataFrame([("a", box(-2172010, 2020000, -2171990, 2020010)), ("c", box(0, 0, 1, 1))],
                                  "id string, geometry binary")
    small = county_index(counties)
    monkeypatch.setattr(C, "MAX_BROADCAST_COUNTY_CELL_BYTES", 0)
    monkeypatch.setattr(C, "MAX_BROADCAST_GEOMETRY_BYTES", 0)
    large = county_index(counties)
    assert small.broadcastable and not large.broadcastable and not large.shapes_broadcastable
    got = [sorted((r["id"], r["fips"]) for r in mask_by_county(feats, i).collect()) for i in (small, large)]
    assert got[0] == got[1] == [("a", "06061"), ("a", "06067")]


def test_state_union_of_slanted_counties(spark):
    from footmark.functions.geometry import st_bbox
    from footmark.operators.counties import outline
    # a square in four triangles, one of them clockwise; a triangle with a hole in another state
    mid, corners = (5, 4), [(0, 0), (10, 0), (10, 10), (0, 10)]
    rings = [[corners[i], corners[(i + 1) % 4], mid, corners[i]] for i in range(4)]
    rings[2] = rings[2][::-1]
    rows = [(f"01{i:03d}", "c", "s", "ST", W.wkb_polygon([r])) for i, r in enumerate(rings)]
    rows.append(("02001", "c", "t", "TT", W.wkb_polygon([[(0, 0), (20, 0), (0, 20), (0, 0)], [(2, 2), (4, 2), (2, 4), (2, 2)]])))
    rows.append(("03001", "c", "u", "UU", None))
    cs = spark.createDataFrame(rows, "fips string, county_name string, state_name string, state_abbr string, geometry binary")
    got = {r["state_fips"]: r for r in states(cs).select("state_fips", "area", st_area("geometry").alias("u"), st_bbox("geometry").alias("b")).collect()}
    assert (got["01"]["area"], got["01"]["u"], tuple(got["01"]["b"])[:4]) == (100.0, 100.0, (0.0, 0.0, 10.0, 10.0))
    assert (got["02"]["area"], got["02"]["u"]) == (198.0, 198.0) and got["03"]["u"] is None
    # only the outline is left for the task that chains it, and inner edges have partial sums before the shuffle
    left = outline(cs.filter("fips < '02'").withColumn("s", F.substring("fips", 1, 2)), "s")
    assert sorted(tuple(r)[1:] for r in left.collect()) == sorted((*map(float, a), *map(float, b)) for a, b in zip(corners, corners[1:] + corners[:1]))
    assert "partial_sum" in left._jdf.queryExecution().executedPlan().toString()
