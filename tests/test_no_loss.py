"""Data that must not get lost: reruns of single counties, mixed geometry types, missing ids and hashes."""

import json

import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.functions.geometry import st_area
from footmark.functions.text import parse_levels
from footmark.plans.catalog import conformed
from footmark.plans.conflate import conflate, conflate_job
from footmark.plans.conform import conform_all, conform_job
from footmark.providers.conform import conform_openaddresses, to_conform
from footmark.session import ensure_checkpoint_dir
from footmark.sources import fixtures as fx
from footmark.sources.counties import read_counties
from footmark.sources.io import existing_partitions, read_conformed, read_raw, write_conformed, write_partitioned

SF = "/root/testdata/sf0.001"
BOX = ["xmin", "ymin", "xmax", "ymax"]


def counts(spark, path):
    return {r["fips"]: r["count"] for r in spark.read.parquet(path).groupBy(F.col("fips").cast("string").alias("fips")).count().collect()}


def test_one_county_run_leaves_the_others(spark, tmp_path):
    conf = conformed(spark, SF).drop(*BOX)
    write_conformed(conf, f"{tmp_path}/conform")
    conflate_job(spark, str(tmp_path), str(tmp_path))
    tables = [f"{tmp_path}/conflate/{t}" for t in ("entities", "crossref", "footprints")]
    before = [counts(spark, t) for t in tables]
    one = sorted(before[0])[0]
    conflate_job(spark, str(tmp_path), str(tmp_path), fips=[one])
    assert [counts(spark, t) for t in tables] == before and len(before[0]) > 1


def test_requested_county_without_rows_is_removed(spark, tmp_path):
    df = spark.createDataFrame([("a", "01001"), ("b", "01003"), ("c", "01005")], "id string, fips string")
    path = f"{tmp_path}/t"
    write_partitioned(df, path)
    write_partitioned(df.filter("id = 'a'"), path, fips=["01001", "01003"])
    assert sorted(counts(spark, path)) == ["01001", "01005"]
    write_partitioned(df.filter("id = 'b'"), path)
    assert sorted(counts(spark, path)) == ["01003"]


def test_conform_job_skips_what_is_there(spark, tmp_path):
    reads = []

    def read(p):
        reads.append(p)
        return fx.raw_layer(spark, SF, p).drop("fixture_key")
    cs = fx.counties(spark, SF)
    args = (spark, read, list(fx.RAW_LAYERS), cs, str(tmp_path))
    first = conform_job(*args)
    n = read_conformed(spark, f"{tmp_path}/conform").count()
    assert n == first.count() == conformed(spark, SF).count() and len(reads) == 5
    some = [r[0] for r in existing_partitions(spark, f"{tmp_path}/conform").select("fips").distinct().collect()]
    conform_job(*args, fips=some[:1])  # nothing to do for providers that have this county
    assert read_conformed(spark, f"{tmp_path}/conform").count() == n
    assert existing_partitions(spark, f"{tmp_path}/none") is None


def test_geojson_with_mixed_types(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]
    rows = [("a", "Polygon", [ring]), ("b", "MultiPolygon", [[ring], [[[x + 10, y] for x, y in ring]]]), ("c", "Point", [1, 2])]
    path = str(tmp_path / "m.geojson")
    with open(path, "w") as f:
        for name, kind, xy in rows:
            f.write(json.dumps({"type": "Feature", "properties": {"UUID": name, "HEIGHT": 1.5}, "geometry": {"type": kind, "coordinates": xy}}) + "\n")
    got = {r["UUID"]: r["a"] for r in read_raw(spark, path, "geojson").select("UUID", st_area("geometry").alias("a")).collect()}
    assert got == {"a": 8.0, "b": 16.0, "c": 0.0}
    from pyspark.sql import types as T
    typed = read_raw(spark, path, "geojson", T.StructType([T.StructField("HEIGHT", T.DoubleType()), T.StructField("geometry", T.BinaryType())]))
    assert typed.dtypes == [("HEIGHT", "double"), ("geometry", "binary")] and typed.first()["HEIGHT"] == 1.5


def test_county_file_with_mixed_types(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]
    path = str(tmp_path / "c.geojson")
    with open(path, "w") as f:
        for code, kind, xy in ((1001, "Polygon", [ring]), (6083, "MultiPolygon", [[ring]])):
            f.write(json.dumps({"properties": {"fips": code, "name": "n", "state": "s", "abbr": "x"}, "geometry": {"type": kind, "coordinates": xy}}) + "\n")
    got = read_counties(spark, path, epsg=5070).select("fips", st_area("geometry").alias("a")).collect()
    assert {tuple(r) for r in got} == {("01001", 8.0), ("06083", 8.0)}


def test_rows_without_a_hash_stay_and_have_ids(spark):
    pts = [(None, "1", "Main St", 0.0), ("h", "2", "Main St", 1000.0), (None, "3", "Oak St", 2000.0), (None, "4", "Oak St", 2000.0)]
    df = spark.createDataFrame([("i", "r", h, n, s, None, W.wkb_point(x, 0.0)) for h, n, s, x in pts],
                               "id string, region string, hash string, number string, street string, unit string, geometry binary")
    rows = to_conform(conform_openaddresses(df)).collect()
    assert len(rows) == 4 and len({r["id"] for r in rows}) == 4 and all(r["id"] for r in rows)


def test_levels_do_not_overflow(spark):
    df = spark.createDataFrame([("2147483647.5",), ("2.5",), ("1 1/2",)], "lv string")
    assert df.select(parse_levels("lv", F.lit("x"))).collect()[0][0] is None


def test_counties_grow_with_the_layers(spark, tmp_path):
    """Ten times the slots, ten times the conformed rows."""
    for t in ("nation", "region", "customer", "orders"):
        spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    n = part.agg(F.max("p_partkey")).first()[0] + 1
    part.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn("p_partkey", F.col("p_partkey") + F.col("m") * n).drop("m") \
        .write.parquet(f"{tmp_path}/part.parquet")

    def rows(sf):
        layers = {"microsoft": fx.raw_microsoft(spark, sf).drop("fixture_key")}
        return conform_all(layers, fx.counties(spark, sf)).select("id").distinct().count()
    assert rows(str(tmp_path)) == 20 * part.count()


def test_conflate_has_its_own_thresholds(spark):
    conf = conformed(spark, SF)
    ent, xref, fp = conflate(conf, multi="collapse", overlap=0.5, address_distance=5.0, merge_distance=8.0)
    assert ent.count() > 0 and xref.count() >= ent.count() and fp.count() > 0


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_declared_projection_is_used(spark):
    from footmark.functions.projection import albers_inverse_np
    lon, lat = albers_inverse_np(-2175000.0, 2020000.0)
    raw = fx.raw_layer(spark, SF, "microsoft").drop("fixture_key", "geometry").limit(1) \
        .withColumn("geometry", F.lit(W.wkb_point(float(lon), float(lat))))
    for epsg in ("declared", {"microsoft": 4326}, 4326):
        r = conform_all({"microsoft": raw}, source_epsg=epsg).first()
        assert (r["xmin"], r["ymin"]) == pytest.approx((-2175000.0, 2020000.0), abs=1e-3)
