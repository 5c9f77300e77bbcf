"""Layers along a curve, reads by window, the manifest, and tables that a job leaves behind."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from footmark.functions import wkb as W
from footmark.functions.curve import hilbert_key
from footmark.operators.correspondence import TableScope, checkpoint, settled
from footmark.plans.conflate import conflate_job
from footmark.plans.conform import conform_job
from footmark.session import ensure_checkpoint_dir
from footmark.sources import fixtures as fx
from footmark.sources.io import existing_partitions, path_exists, read_conformed, read_raw, write_conformed, write_raw_layer
from footmark.sources.manifest import read_manifest, verify_partitions

SF = "/root/testdata/sf0.001"
COLS = "id string, classification string, address string, height double, levels int, geometry binary, fips string, provider string"


def points(spark, n=4000, fips="01001"):
    rows = [(f"p{i}", None, None, None, None, W.wkb_point((i * 7919 % 1000) * 100.0, (i * 104729 % 997) * 100.0), fips, "nad") for i in range(n)]
    return spark.createDataFrame(rows, COLS)


def tables(spark):
    return set(glob.glob(ensure_checkpoint_dir(spark).replace("file:", "") + "/footmark-tables/*"))


def test_hilbert_key_visits_neighbours(spark):
    df = spark.range(256).select((F.col("id") % 16 - 8).cast("double").alias("x"), (F.floor(F.col("id") / 16) - 8).cast("double").alias("y"))
    got = sorted(df.select(hilbert_key(F.col("x"), F.col("y"), 1.0, 4).alias("k"), "x", "y").collect())
    assert [r[0] for r in got] == list(range(256))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(got, got[1:]))
    odd = spark.createDataFrame([(1e300, -1e300), (float("nan"), 0.0), (None, 1.0)], "x double, y double")
    assert [r[0] is None for r in odd.select(hilbert_key(F.col("x"), F.col("y"))).collect()] == [False, False, True]


def test_window_reads_a_fraction_of_the_row_groups(spark, tmp_path):
    path, window = f"{tmp_path}/conform", (20000.0, 20000.0, 29000.0, 29000.0)
    write_conformed(points(spark).unionByName(points(spark, 50, "01003").withColumn("id", F.concat("id", F.lit("b")))), path, block_bytes=20000)
    touched = total = 0
    for f in glob.glob(f"{path}/fips=01001/*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            x, y = (meta.row_group(g).column(names.index(c)).statistics for c in ("xmin", "ymin"))
            total += 1
            touched += x.min <= window[2] and x.max >= window[0] and y.min <= window[3] and y.max >= window[1]
    assert total >= 10 and touched <= total / 3
    df = read_conformed(spark, path, within=[window])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(xmin), IsNotNull(xmax)" in plan or "LessThanOrEqual(xmin,29000.0)" in plan
    want = read_conformed(spark, path, keep_bbox=True).filter("xmin between 20000 and 29000 and ymin between 20000 and 29000")
    assert sorted(r["id"] for r in df.collect()) == sorted(r["id"] for r in want.collect()) and want.count() > 10
    far = read_conformed(spark, path, within=[(5e6, 5e6, 6e6, 6e6)])
    assert far.count() == 0 and read_conformed(spark, path, within=[]).count() == 0


def test_raw_layer_by_window(spark, tmp_path):
    df = points(spark, 500).select("id", "geometry").unionByName(
        spark.createDataFrame([("null", None)], "id string, geometry binary"))
    write_raw_layer(df, f"{tmp_path}/raw")
    back = read_raw(spark, f"{tmp_path}/raw")
    assert back.columns == ["id", "geometry", "bbox"] and back.count() == 501
    got = read_raw(spark, f"{tmp_path}/raw", within=[(0, 0, 30000, 30000), (90000, 90000, 99000, 99000)])
    assert "bbox.xmin" in got._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    b = "(bbox.xmin <= {2} and bbox.xmax >= {0} and bbox.ymin <= {3} and bbox.ymax >= {1})"
    want = back.filter(f"bbox.xmin is null or {b.format(0, 0, 30000, 30000)} or {b.format(90000, 90000, 99000, 99000)}")
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect()) and 1 < got.count() < 500
    with pytest.raises(ValueError):
        write_raw_layer(back, f"{tmp_path}/again")


def test_manifest_finds_what_changed(spark, tmp_path):
    path = f"{tmp_path}/conform"
    parts = [points(spark, 30, f) for f in ("01001", "01003", "01005", "01007")]
    write_conformed(parts[0].unionByName(parts[1]).unionByName(parts[2]), path)
    assert {r["state"] for r in verify_partitions(spark, path).collect()} == {"ok"}
    assert all("/conform_manifest/" in f for f in existing_partitions(spark, path).inputFiles())  # no scan of the layers
    # one partition loses a row, one its files, one is written by a job that never recorded it
    write_conformed(parts[0].limit(29), f"{tmp_path}/other")
    for f in glob.glob(f"{path}/fips=01001/provider=nad/*") + glob.glob(f"{path}/fips=01003/provider=nad/*"):
        os.remove(f)
    new = glob.glob(f"{tmp_path}/other/fips=01001/provider=nad/*.parquet")[0]
    os.rename(new, f"{path}/fips=01001/provider=nad/{os.path.basename(new)}")
    write_conformed(parts[3], f"{tmp_path}/third")
    os.rename(f"{tmp_path}/third/fips=01007", f"{path}/fips=01007")
    got = {r["fips"]: r["state"] for r in verify_partitions(spark, path).collect()}
    assert got == {"01001": "damaged", "01003": "missing", "01005": "ok", "01007": "unlisted"}
    # a rerun replaces what was not finished: no row twice
    write_conformed(parts[3], path, F.col("fips") == "01007")
    assert {r["fips"]: r["n"] for r in read_manifest(spark, path).collect()} == {"01001": 30, "01003": 30, "01005": 30, "01007": 30}
    assert read_conformed(spark, path).filter("fips = '01007'").count() == 30
    parts[0].drop("fips", "provider").write.parquet(f"{tmp_path}/bare")
    with pytest.raises(ValueError):
        write_conformed(parts[0], f"{tmp_path}/bare")


def test_scopes_remove_their_tables(spark):
    before = tables(spark)
    with TableScope():
        one = settled(lambda: checkpoint(spark.range(5)).union(checkpoint(spark.range(3))))
        assert one.count() == 8 and len(tables(spark) - before) == 1  # the result only
        with pytest.raises(RuntimeError), TableScope():
            checkpoint(spark.range(2))
            raise RuntimeError
        assert len(tables(spark) - before) == 1
    assert tables(spark) == before
    kept = checkpoint(spark.range(4))
    assert len(tables(spark) - before) == 1 and kept.count() == 4


def test_jobs_leave_only_their_output(spark, tmp_path):
    before = tables(spark)
    cs, out = fx.counties(spark, SF), str(tmp_path)
    for p in fx.RAW_LAYERS:
        write_raw_layer(fx.raw_layer(spark, SF, p).drop("fixture_key"), f"{out}/raw/{p}")

    def read(p):
        return read_raw(spark, f"{out}/raw/{p}")
    some = sorted(r[0] for r in cs.select("fips").collect())[:2]
    part = conform_job(spark, read, list(fx.RAW_LAYERS), cs, out, fips=some, covering="bbox")
    n = part.count()
    whole = conform_job(spark, lambda p: read(p).drop("bbox"), list(fx.RAW_LAYERS), cs, f"{out}/whole")
    assert n == whole.filter(F.col("fips").isin(some)).count() > 0
    rest = conform_job(spark, read, list(fx.RAW_LAYERS), cs, out, covering="bbox")
    assert n + rest.count() == whole.count() == read_conformed(spark, f"{out}/conform").count()
    assert conform_job(spark, read, ["nad"], cs.limit(0), out).count() == 0
    ent, xref, fp = conflate_job(spark, out, out)
    assert tables(spark) == before and path_exists(spark, f"{out}/conform_manifest")
    assert 0 < ent.count() <= xref.count() and fp.count() > 0
