"""Correspondence (J7) and merge (J8) on hand-made layers, one case per quirk."""

import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.operators.correspondence import (merge_footprints_and_addresses, no_materialize,
                                               spatial_correspondence)

SCHEMA = "id string, provider string, classification string, address string, height double, " \
         "levels int, geometry binary, fips string"


def box(x0, y0, x1, y1):
    return W.wkb_polygon([[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])


def df(spark, rows, provider):
    full = [(r[0], provider, r[1], r[2], None, None, r[-1], "06067") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def refs(row):
    return sorted((f["provider"], f["key"]) for f in row["foreign"])


def test_overlap_cases(spark):
    left = df(spark, [("L1", "house", None, box(0, 0, 10, 10)),          # matched twice (Q10)
                      ("L2", None, None, box(100, 0, 110, 10)),          # touching only -> no match
                      ("L3", None, None, box(200, 0, 210, 10)),          # overlap exactly 0.3 -> no match
                      ("L4", None, None, box(300, 0, 310, 10)),          # contains a point -> NaN -> match
                      ("L5", None, None, None)], "openstreetmap")        # null geometry survives
    right = df(spark, [("R1", None, "1 main st", box(1, 1, 9, 9)),
                       ("R2", "garage", None, box(2, 0, 10, 8)),
                       ("R3", None, None, box(110, 0, 120, 10)),
                       ("R4", None, None, box(207, 0, 217, 10)),
                       ("R5", None, None, W.wkb_point(305, 5)),
                       ("R6", None, None, None)], "microsoft")
    out = spatial_correspondence(left, right, materialize=no_materialize).collect()
    by = {}
    for r in out:
        by.setdefault(r["id"], []).append(r)
    assert len(by["L1"]) == 2
    assert sorted(tuple(refs(r)) for r in by["L1"]) == [(("microsoft", "R1"),), (("microsoft", "R2"),)]
    assert {r["classification"] for r in by["L1"]} == {"house"}
    assert {r["address"] for r in by["L1"]} == {"1 main st", None}
    assert refs(by["L2"][0]) == [] and refs(by["L3"][0]) == []
    assert refs(by["L4"][0]) == [("microsoft", "R5")]
    assert "L5" in by and "R6" in by and "R3" in by and "R4" in by
    assert "R1" not in by and "R2" not in by and "R5" not in by
    assert len(out) == 2 + 1 + 1 + 1 + 1 + 3


def test_distance_cases(spark):
    left = df(spark, [("A1", None, "1 main", W.wkb_point(0, 0)), ("A2", None, None, W.wkb_point(100, 0))],
              "nad")
    right = df(spark, [("B1", "Res", None, W.wkb_point(6, 8)),      # exactly 10 m -> no match
                       ("B2", None, None, W.wkb_point(3, 4)),       # 5 m -> match
                       ("B3", None, None, W.wkb_point(100, 9.5))],  # 9.5 m -> match
                      "openaddresses")
    out = spatial_correspondence(left, right, use_distance=True, materialize=no_materialize).collect()
    ids = sorted((r["id"], tuple(refs(r))) for r in out)
    assert ids == [("A1", (("openaddresses", "B2"),)), ("A2", (("openaddresses", "B3"),)), ("B1", ())]


def test_collapse_mode(spark):
    left = df(spark, [("L1", None, None, box(0, 0, 10, 10))], "openstreetmap")
    right = df(spark, [("R1", None, None, box(1, 1, 9, 9)), ("R2", None, None, box(2, 0, 10, 8))], "microsoft")
    out = spatial_correspondence(left, right, multi="collapse", materialize=no_materialize).collect()
    assert len(out) == 1 and len(out[0]["foreign"]) == 2


def test_merge_cases(spark):
    fps = df(spark, [("F1", "house", None, box(0, 0, 10, 10)),
                     ("F2", None, None, box(100, 0, 110, 10)),
                     ("F3", None, None, box(200, 0, 210, 10)),
                     ("F4", None, "9 oak dr", box(300, 0, 310, 10)),
                     ("F5", None, None, box(400, 0, 410, 10))], "openstreetmap")
    ads = df(spark, [("A1", None, "1 Main St", W.wkb_point(5, 5)),          # inside F1 (distance 0)
                     ("A2", None, "2 main st", W.wkb_point(105, 13)),       # 3 m from F2
                     ("A3", None, "3 main st", W.wkb_point(105, -3)),       # also 3 m from F2: tie, both kept
                     ("A4", None, "9 Oak Dr", W.wkb_point(600, 600)),       # same address as F4 -> one entity
                     ("A5", None, None, W.wkb_point(900, 900)),             # null addresses stay apart
                     ("A6", None, None, W.wkb_point(950, 950))], "nad")
    out = merge_footprints_and_addresses(fps, ads, materialize=no_materialize).collect()
    addrs = sorted([r["address"] for r in out], key=lambda a: (a is None, a))
    assert addrs == ["1 main street", "2 main street", "3 main street", "9 oak drive", None, None, None, None]
    one = [r for r in out if r["address"] == "1 main street"][0]
    assert (one["x"], one["y"]) == (5.0, 5.0)                        # address point on the footprint
    assert sorted((f["provider"], f["key"]) for f in one["foreign"]) == [("nad", "A1"), ("openstreetmap", "F1")]
    assert one["classification"] == "house"
    two = [r for r in out if r["address"] == "2 main street"][0]
    assert (two["x"], two["y"]) == (105.0, 5.0)                      # footprint centroid
    oak = [r for r in out if r["address"] == "9 oak drive"][0]
    assert [f["key"] for f in oak["foreign"]] == ["A4"]              # first by provider: nad before osm
    assert all(len(r["id"]) == 14 and r["id"][8] == "+" for r in out)


def test_merge_collapse_null_address(spark):
    fps = df(spark, [("F1", None, None, box(0, 0, 10, 10))], "openstreetmap")
    ads = df(spark, [("A5", None, None, W.wkb_point(900, 900)), ("A6", None, None, W.wkb_point(950, 950))],
             "nad")
    out = merge_footprints_and_addresses(fps, ads, materialize=no_materialize, collapse_null_address=True)
    assert out.count() == 1


def test_nearest_places_with_many_rows_at_one_place(spark, tmp_path):
    """10,000 addresses at one place are one node: the narrow pairs are one a footprint, and hold no payload."""
    from footmark.operators import correspondence as C
    from footmark.functions.geometry import st_point, with_bbox
    addr = spark.range(10_000).select(F.concat(F.lit("a"), "id").alias("id"), F.lit("nad").alias("provider"), F.lit(None).cast("string").alias("classification"),
                                      F.concat(F.col("id").cast("string"), F.lit(" main st")).alias("address"), F.lit(None).cast("double").alias("height"),
                                      F.lit(None).cast("int").alias("levels"), st_point(F.lit(5.0), F.lit(5.0)).alias("geometry"))
    far = spark.range(2).select(F.concat(F.lit("far"), "id").alias("id"), F.lit("nad").alias("provider"), F.lit(None).cast("string").alias("classification"),
                                F.lit("9 oak st").alias("address"), F.lit(None).cast("double").alias("height"), F.lit(None).cast("int").alias("levels"),
                                st_point(F.lit(13.0) + F.col("id"), F.lit(5.0)).alias("geometry"))
    fp = spark.createDataFrame([(f"f{i}", "openstreetmap", "house", None, 3.0, 1, box(x, 0, x + 4, 10)) for i, x in enumerate((6, 20, 100))],
                               "id string, provider string, classification string, address string, height double, levels int, geometry binary")
    cut = []

    def keep(df):
        cut.append(C.checkpoint(df))
        return cut[-1]
    rows = C.nearest_places(with_bbox(fp), with_bbox(addr.union(far)), [], 10.0, materialize=keep)
    assert "address_right" not in cut[0].columns and cut[0].count() == 5
    got = {(r["id_left"], round(r["metric"], 6)) for r in rows.collect()}
    assert got == {("f0", 1.0), ("f1", 6.0)}
    ent = C.merge_footprints_and_addresses(fp, addr.union(far))
    by_class = {r["classification"]: r["n"] for r in ent.groupBy("classification").agg(F.count("*").alias("n")).collect()}
    # f0 with 10,000 addresses and f2 alone; f1's match shares its address with far0, which is near no footprint's minimum and comes first
    assert by_class == {"house": 10_001, None: 1}


def test_distance_metric_of_two_geometries(spark):
    from footmark.functions import wkb as W
    from footmark.functions.geometry import with_bbox
    from footmark.operators.correspondence import distance_metric
    rows = [(1, W.wkb_point(0, 0), W.wkb_point(3, 4)), (2, W.wkb_point(0, 0), W.wkb_point(6, 8)), (3, W.wkb_point(0, 0), box(9.5, -1, 12, 1)),
            (4, box(0, 0, 1, 1), box(1, 1, 2, 2)), (5, W.wkb_point(0, 0), W.wkb_polygon([[(0, 12), (12, 0), (12, 12)]])), (6, None, W.wkb_point(0, 0))]
    df = spark.createDataFrame(rows, "k int, geometry_left binary, geometry_right binary")
    want = {1: (5.0, True), 2: (10.0, False), 3: (9.5, True), 4: (0.0, True), 5: (round(72 ** 0.5, 9), True), 6: (None, None)}
    boxed = with_bbox(with_bbox(df, "geometry_left").withColumnsRenamed({c: f"{c}_left" for c in ("xmin", "ymin", "xmax", "ymax")}), "geometry_right") \
        .withColumnsRenamed({c: f"{c}_right" for c in ("xmin", "ymin", "xmax", "ymax")})
    for pairs in (df, boxed):
        got = {r["k"]: (None if r["metric"] is None else round(r["metric"], 9), r["corresponds"]) for r in distance_metric(pairs).collect()}
        assert got == want
