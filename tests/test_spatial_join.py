"""Grid-cell joins equal a brute-force nested loop, for several cell sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.functions.geometry import with_bbox
from footmark.operators.spatial_join import (_cells, _grown, _level, _levels_of, dwithin_join, intersects_join,
                                             salts, suffixed)


def layer(spark, rng, n, big=0, prefix="a"):
    rows = []
    for i in range(n):
        x, y = rng.uniform(0, 400, 2)
        w, h = rng.uniform(1, 30, 2)
        rows.append((f"{prefix}{i}", W.wkb_polygon([[(x, y), (x + w, y), (x + w, y + h), (x, y + h)]]),
                     (x, y, x + w, y + h)))
    for j in range(big):  # large shapes span many cells (multi-level grid)
        x, y = rng.uniform(0, 200, 2)
        rows.append((f"{prefix}B{j}", W.wkb_polygon([[(x, y), (x + 300, y + 20), (x + 250, y + 260)]]), None))
    rows.append((f"{prefix}null", None, None))
    return rows


def brute(la, lb, dist=None):
    import pyarrow as pa
    from footmark.functions import kernels as K
    ids_a = [r[0] for r in la]
    ids_b = [r[0] for r in lb]
    ga = [r[1] for r in la]
    gb = [r[1] for r in lb]
    A = W.decode(pa.array([g for g in ga for _ in gb], pa.binary()))
    B = W.decode(pa.array([g for _ in ga for g in gb], pa.binary()))
    d, hit = K.distance_and_intersects(A, B)
    out = set()
    k = 0
    for a in ids_a:
        for b in ids_b:
            if (dist is None and hit[k]) or (dist is not None and d[k] < dist):
                out.add((a, b))
            k += 1
    return out


@pytest.mark.parametrize("cell", [5.0, 50.0, 400.0])
def test_intersects_join_matches_brute_force(spark, cell):
    rng = np.random.default_rng(1)
    la, lb = layer(spark, rng, 60, big=2, prefix="a"), layer(spark, rng, 60, big=1, prefix="b")
    A = spark.createDataFrame([(r[0], r[1]) for r in la], "id string, geometry binary")
    B = spark.createDataFrame([(r[0], r[1]) for r in lb], "id string, geometry binary")
    got = {(r[0], r[1]) for r in intersects_join(A, B, cell=cell).select("id_left", "id_right").collect()}
    assert got == brute(la, lb)


@pytest.mark.parametrize("cell", [8.0, 50.0])
def test_dwithin_join_matches_brute_force(spark, cell):
    rng = np.random.default_rng(2)
    la = [(f"p{i}", W.wkb_point(*rng.uniform(0, 300, 2)), None) for i in range(80)] + [("pnull", None, None)]
    lb = layer(spark, rng, 50, big=1, prefix="b")
    A = spark.createDataFrame([(r[0], r[1]) for r in la], "id string, geometry binary")
    B = spark.createDataFrame([(r[0], r[1]) for r in lb], "id string, geometry binary")
    got = {(r[0], r[1]) for r in dwithin_join(A, B, 10.0, cell=cell).select("id_left", "id_right").collect()}
    assert got == brute(la, lb, 10.0)


def test_pairs_are_reported_once(spark):
    # two identical boxes spanning many cells: one pair, not one per shared cell
    g = W.wkb_polygon([[(0, 0), (500, 0), (500, 500), (0, 500)]])
    A = spark.createDataFrame([("a", g)], "id string, geometry binary")
    B = spark.createDataFrame([("b", g)], "id string, geometry binary")
    assert intersects_join(A, B, cell=50.0).count() == 1


def test_keys_restrict_pairs(spark):
    g = W.wkb_point(1, 1)
    A = spark.createDataFrame([("a", "01", g)], "id string, fips string, geometry binary")
    B = spark.createDataFrame([("b", "02", g), ("c", "01", g)], "id string, fips string, geometry binary")
    got = intersects_join(A, B, keys=("fips",)).select("id_right").collect()
    assert [r[0] for r in got] == ["c"]


def test_hot_cell_keeps_every_pair(spark):
    # a third of one side sits on a single point: every pair is a real match and must be kept
    hot = [(f"h{i}", W.wkb_point(10.0, 10.0)) for i in range(300)]
    cold = [(f"c{i}", W.wkb_point(1000.0 + 37 * i, 500.0)) for i in range(600)]
    A = spark.createDataFrame(hot + cold, "id string, geometry binary")
    B = spark.createDataFrame([("b0", W.wkb_point(12.0, 10.0)), ("b1", W.wkb_point(10.0, 19.0)),
                               ("b2", W.wkb_point(10.0, 21.0))], "id string, geometry binary")
    got = dwithin_join(A, B, 10.0).groupBy("id_right").count().orderBy("id_right").collect()
    assert [(r[0], r[1]) for r in got] == [("b0", 300), ("b1", 300)]


def test_outlier_costs_one_salted_row_each(spark):
    # one shape of 1,000 km above 4,000 small ones: an up row each on its level only, spread over slots
    rng = np.random.default_rng(5)
    pts = [(f"p{i}", W.wkb_point(*rng.uniform(0, 20_000, 2))) for i in range(4000)]
    huge = W.wkb_polygon([[(-5e5, -5e5), (5e5, -5e5), (5e5, 5e5), (-5e5, 5e5)]])
    A = spark.createDataFrame(pts, "id string, geometry binary")
    B = spark.createDataFrame([("huge", huge)] + [(f"b{i}", g) for i, (_, g) in enumerate(pts[:50])],
                              "id string, geometry binary")
    got = intersects_join(A, B).groupBy("id_right").count().collect()
    n = {r[0]: r[1] for r in got}
    assert n.pop("huge") == 4000 and set(n.values()) == {1} and len(n) == 50

    L = suffixed(with_bbox(A), "_left").withColumn("__lhome", _level(*_grown("_left", 0.0), 50.0))
    R = suffixed(with_bbox(B), "_right").withColumn("__rhome", _level(*_grown("_right", 0.0), 50.0))
    llv, rlv = _levels_of(L, R)
    assert llv == {0} and len(rlv) == 2
    rows = L.select(F.explode(_cells(_grown("_left", 0.0), F.col("__lhome"), llv, rlv, 1, 50.0)).alias("c"))
    per_key = [r["count"] for r in rows.groupBy("c").count().collect()]
    assert sum(per_key) == 2 * 4000
    # the outlier's corner cells hold all points; no slot holds more than about its share
    assert max(per_key) <= 2 * 4000 / salts(max(rlv), 0)


def test_layers_are_not_broadcast(spark):
    """Small files of keys become layers of any size: no side of the join, of the anti join or of the county
    lookup passes through the driver on the planner's guess."""
    from footmark.operators.correspondence import anti_join
    from footmark.operators.counties import county_of
    rng = np.random.default_rng(3)
    a = spark.createDataFrame([r[:2] for r in layer(spark, rng, 20)], "k string, geometry binary")
    b = spark.createDataFrame([r[:2] for r in layer(spark, rng, 20, prefix="b")], "k string, geometry binary")
    origin = a.select(F.col("k").alias("id"), F.lit("p").alias("provider"), *[F.lit(None).cast("string").alias(c) for c in (
        "classification", "address")], F.lit(None).cast("double").alias("height"), F.lit(None).cast("int").alias("levels"), "geometry")
    square = spark.createDataFrame([("01001", W.wkb_polygon([[(-1, -1), (900, -1), (900, 900), (-1, 900)]]))], "fips string, geometry binary")

    def joins(df):
        df.collect()
        return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    found = joins(dwithin_join(a, b, 10.0))
    assert found and all("SortMergeJoin" in j for j in found)
    found = joins(anti_join(origin, origin.limit(5), ["provider", "id"], ["provider", "id"], []))
    assert found and all("SortMergeJoin" in j for j in found)
    last = joins(county_of(a, square, key="k"))
    assert any("SortMergeJoin" in j and "LeftOuter" in j for j in last) and not any("BroadcastHashJoin [k#" in j for j in last)
