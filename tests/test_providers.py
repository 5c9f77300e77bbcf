"""Provider conforms and the registry."""

import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.providers import get_provider, list_providers, register_provider
from footmark.providers.conform import NULL_UUID
from footmark.providers.registry import unregister_provider


def test_registry():
    assert set(list_providers()) >= {"microsoft", "nad", "openaddresses", "openstreetmap", "usa_structures"}
    with pytest.raises(KeyError):
        register_provider("nad")(lambda df: df)
    register_provider("tmp_test")(lambda df: df)
    register_provider("tmp_test", overwrite=True)(lambda df: df)
    unregister_provider("tmp_test")
    with pytest.raises(KeyError):
        get_provider("tmp_test")


def test_microsoft_and_nad_ids(spark):
    import base64
    import hashlib
    g = W.wkb_point(1.0, 2.0)
    want = hashlib.sha256(base64.b64encode(g)).hexdigest()
    big = W.wkb_polygon([[(i, i * i) for i in range(20)]])  # > 57 bytes: base64 would wrap in Spark
    want_big = hashlib.sha256(base64.b64encode(big)).hexdigest()
    ms = spark.createDataFrame([(5.0, 0.9, g), (-1.0, 0.5, big)], "height double, confidence double, geometry binary")
    rows = ms.transform(get_provider("microsoft").conform).collect()
    assert rows[0]["id"] == want and rows[0]["height"] == 5.0
    assert rows[1]["id"] == want_big and rows[1]["height"] is None
    nad = spark.createDataFrame([
        (NULL_UUID, "Unknown", "12", "Main St", None, g),
        (None, "Residential", None, " Oak Dr ", "Apt 1", g),
        ("u-1", "Other", None, None, None, g)],
        "UUID string, Addr_Type string, AddNo_Full string, StNam_Full string, SubAddress string, geometry binary")
    r = nad.transform(get_provider("nad").conform).collect()
    assert r[0]["id"] == want and r[0]["classification"] is None and r[0]["address"] == "12 main st"
    assert r[1]["id"] is None and r[1]["classification"] == "Residential" and r[1]["address"] == "oak dr  apt 1"
    assert r[2]["address"] == "" and r[2]["classification"] is None


def test_openstreetmap_rules(spark):
    g = W.wkb_point(0, 0)
    rows = [("a", None, "yes", "school", None, None, "1", "Main St", None, "2", "12", None, g),
            (None, "w", "parking", None, None, None, None, None, None, None, None, None, g),
            ("b", None, "house", None, None, "Hall", None, None, "U1", "1,2", "30 ft", "UniversityPly", g),
            ("c", None, None, "school", None, None, None, None, None, None, None, None, g),
            ("d", "w2", "school", None, None, None, None, None, None, "1,2", None, None, g)]
    df = spark.createDataFrame(rows, "osm_id string, osm_way_id string, building string, amenity string, "
                               "leisure string, name string, addr_housenumber string, addr_street string, "
                               "addr_unit string, building_levels string, height string, dataset string, "
                               "geometry binary")
    out = {r["id"]: r for r in df.transform(get_provider("openstreetmap").conform).collect()}
    assert set(out) == {"a", "d"}                    # parking, UniversityPly, no building dropped
    assert out["a"]["classification"] is None        # 'yes' -> null, never falls through to amenity
    assert out["a"]["address"] == "1 Main St" and out["a"]["levels"] == 2 and out["a"]["height"] == 12.0
    assert out["d"]["levels"] is None                # comma list for a school


def test_openaddresses_groups(spark):
    p1, p2 = W.wkb_point(0, 0), W.wkb_point(5, 5)
    rows = [("1", "r", "h2", "10", "Main St", None, p1), ("2", "r", "h1", "10", "Main St", "A", p1),
            ("3", "r", "h3", "11", "Main St", None, p1), ("4", "r", "h4", "0", None, None, p2),
            ("5", "r", "h5", "7", "Oak", None, p2), ("5", "r", "h5", "7", "Oak", None, p2)]
    df = spark.createDataFrame(rows, "id string, region string, hash string, number string, street string, "
                               "unit string, geometry binary")
    got = sorted((r["id"], r["address"]) for r in df.transform(get_provider("openaddresses").conform).collect())
    # p1: two rows of '10 main st' collapse (smallest hash) + single '11 main st'; p2: '0' dropped,
    # exact duplicate removed
    assert got == [("h1", "10 main st"), ("h3", "11 main st"), ("h5", "7 oak")]


def test_usa_structures(spark):
    g = W.wkb_point(0, 0)
    df = spark.createDataFrame([("u", " Commercial ", " 1 Main ", 3.5, g), ("v", "", None, None, g)],
                               "UUID string, OCC_CLS string, PROP_ADDR string, HEIGHT double, geometry binary")
    r = df.transform(get_provider("usa_structures").conform).orderBy("id").collect()
    assert (r[0]["classification"], r[0]["address"], r[0]["height"]) == ("commercial", "1 main", 3.5)
    assert r[1]["classification"] is None and r[1]["address"] is None
