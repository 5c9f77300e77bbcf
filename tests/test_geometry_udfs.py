"""Geometry column functions through Spark (Arrow UDFs)."""

import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.functions.geometry import (st_area, st_bbox, st_centroid_xy, st_collect, st_distance,
                                         st_intersection, st_intersects, st_is_valid_wkb, st_points,
                                         st_polygons, st_transform_to_4326, st_transform_to_5070)

CONCAVE = W.wkb_polygon([[(0, 0), (10, 0), (10, 10), (5, 5), (0, 10)]])
BOX = W.wkb_polygon([[(0, 5), (10, 5), (10, 10), (0, 10)]])


def test_intersection_of_general_polygons(spark):
    df = spark.createDataFrame([(CONCAVE, BOX), (BOX, W.wkb_point(50, 50)), (None, BOX)], "a binary, b binary")
    i = st_intersection("a", "b")
    rows = df.select(st_area(i).alias("area"), st_centroid_xy(i).alias("c"),
                     st_intersects("a", "b").alias("hit"), st_distance("a", "b").alias("d")).collect()
    assert rows[0]["area"] == pytest.approx(25)
    assert rows[0]["hit"] is True and rows[0]["d"] == 0
    assert rows[1]["area"] is None or rows[1]["area"] == 0
    assert rows[1]["hit"] is False and rows[1]["d"] == pytest.approx(((50 - 10) ** 2 + (50 - 10) ** 2) ** 0.5)
    assert rows[2]["area"] is None and rows[2]["hit"] is None and rows[2]["d"] is None


def test_transform_round_trip(spark):
    g = W.wkb_polygon([[(-2174000, 2020000), (-2173980, 2020000), (-2173980, 2020012), (-2174000, 2020012)]])
    df = spark.createDataFrame([(g,)], "g binary")
    b = df.select(st_bbox(st_transform_to_5070(st_transform_to_4326("g"))).alias("b")).collect()[0]["b"]
    assert b["xmin"] == pytest.approx(-2174000, abs=1e-6) and b["ymax"] == pytest.approx(2020012, abs=1e-6)
    ll = df.select(st_bbox(st_transform_to_4326("g")).alias("b")).collect()[0]["b"]
    assert -122 < ll["xmin"] < -121 and 38 < ll["ymin"] < 39


def test_collect_explode_and_validity(spark):
    p1 = W.wkb_polygon([[(0, 0), (1, 0), (1, 1), (0, 1)]])
    p2 = W.wkb_polygon([[(5, 5), (7, 5), (7, 7), (5, 7)]])
    df = spark.createDataFrame([(1, p1), (1, p2), (2, None)], "k int, g binary")
    mp = df.groupBy("k").agg(st_collect(F.collect_list("g")).alias("mp"))
    parts = mp.select("k", F.explode_outer(st_polygons("mp")).alias("p")) \
        .select("k", st_area("p").alias("a")).orderBy("k", "a").collect()
    assert [(r["k"], r["a"]) for r in parts] == [(1, 1.0), (1, 4.0), (2, None)]
    pts = df.select(F.size(st_points("g")).alias("n"), st_is_valid_wkb("g").alias("v")).collect()
    assert [(r["n"], r["v"]) for r in pts] == [(5, True), (5, True), (None, False)]
