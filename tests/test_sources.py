"""Raw layer readers (S1) in parquet, CSV (hex WKB), JSON and GeoJSON lines."""

import gzip
import json

from footmark.functions import wkb as W
from footmark.functions.geometry import st_centroid_xy
from footmark.sources.io import read_raw


def test_read_raw_formats(spark, tmp_path):
    g = W.wkb_polygon([[(0, 0), (4, 0), (4, 2), (0, 2)]])
    spark.createDataFrame([("a", 1.5, g)], "UUID string, HEIGHT double, geometry binary") \
        .write.parquet(str(tmp_path / "p"))
    (tmp_path / "c.csv").write_text("UUID,HEIGHT,geometry\na,1.5," + g.hex() + "\n")
    (tmp_path / "j.json").write_text(json.dumps({"UUID": "a", "HEIGHT": 1.5, "geometry": g.hex()}) + "\n")
    feat = {"type": "Feature", "properties": {"UUID": "a", "HEIGHT": "1.5"},
            "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]]}}
    with gzip.open(tmp_path / "f.geojson.gz", "wt") as f:
        f.write(json.dumps(feat) + "\n")
    for fmt, path in [("parquet", "p"), ("csv", "c.csv"), ("json", "j.json"), ("geojson", "f.geojson.gz")]:
        df = read_raw(spark, str(tmp_path / path), fmt)
        r = df.select("UUID", st_centroid_xy("geometry").alias("c")).collect()[0]
        assert r["UUID"] == "a" and (r["c"]["x"], r["c"]["y"]) == (2.0, 1.0), fmt


def test_raw_layers_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    """A table of one row group is dealt over tasks by the size of its files; null and repeated keys stay."""
    from footmark.sources import fixtures as fx
    keys = [*range(500), 7, 7, None, None]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, 3) for k in keys], "p_partkey long, p_size long").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    few = {p: fx.raw_layer(spark, str(tmp_path), p) for p in fx.RAW_LAYERS}
    monkeypatch.setattr(fx, "TASK_BYTES", 256)
    for p, df in few.items():
        many = fx.raw_layer(spark, str(tmp_path), p)
        assert df.rdd.getNumPartitions() == 1 < many.rdd.getNumPartitions(), p
        assert sorted(map(str, many.collect())) == sorted(map(str, df.collect())), p


def test_small_tasks_are_preferred_but_not_forced(spark):
    from footmark.session import PREFERRED_CONF, prefer_small_tasks
    for k, v in PREFERRED_CONF.items():
        before = spark.conf.get(k, None)
        try:
            spark.conf.unset(k)
            prefer_small_tasks(spark)
            assert spark.conf.get(k) == v
            spark.conf.set(k, "7m")
            prefer_small_tasks(spark)
            assert spark.conf.get(k) == "7m"
        finally:
            spark.conf.unset(k) if before is None else spark.conf.set(k, before)
