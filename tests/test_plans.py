"""Physical plan shape: equi-joins (no nested loops), one UDF pass per pair, pruning."""

from footmark.functions import wkb as W


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _layers(spark):
    a = spark.createDataFrame([(f"a{i}", "06067", W.wkb_polygon([[(i, 0), (i + 5, 0), (i + 5, 5), (i, 5)]]))
                               for i in range(20)], "id string, fips string, geometry binary")
    b = spark.createDataFrame([(f"b{i}", "06067", W.wkb_polygon([[(i, 1), (i + 4, 1), (i + 4, 4), (i, 4)]]))
                               for i in range(20)], "id string, fips string, geometry binary")
    return a, b


def test_spatial_join_is_an_equi_join(spark):
    from footmark.operators.spatial_join import intersects_join
    a, b = _layers(spark)
    p = plan_text(intersects_join(a, b, keys=("fips",)))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "SortMergeJoin" in p or "HashJoin" in p


def test_pair_udf_runs_once(spark):
    from footmark.operators.correspondence import correspondence_pairs
    a, b = _layers(spark)
    a = a.withColumn("provider", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("openstreetmap"))
    b = b.withColumn("provider", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("microsoft"))
    for c in ("classification", "address"):
        a = a.withColumn(c, a["id"].substr(1, 0))
        b = b.withColumn(c, b["id"].substr(1, 0))
    a = a.withColumn("height", a["fips"].cast("double")).withColumn("levels", a["fips"].cast("int"))
    b = b.withColumn("height", b["fips"].cast("double")).withColumn("levels", b["fips"].cast("int"))
    df = correspondence_pairs(a, b)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("_overlap(") == 1
    assert df.count() > 0


def test_conformed_scan_prunes_partitions_and_columns(spark, tmp_path):
    from pyspark.sql import functions as F
    from footmark.sources.io import read_conformed
    rows = [("x", None, None, None, None, W.wkb_point(0, 0), "06067", "nad"),
            ("y", None, None, None, None, W.wkb_point(1, 1), "06083", "microsoft")]
    df = spark.createDataFrame(rows, "id string, classification string, address string, height double, "
                               "levels int, geometry binary, fips string, provider string")
    df.write.partitionBy("fips", "provider").parquet(str(tmp_path / "conform"))
    q = read_conformed(spark, str(tmp_path / "conform")).filter(F.col("provider") == "nad").select("id")
    p = plan_text(q)
    assert "PartitionFilters: [isnotnull(provider" in p and "nad" in p
    assert "ReadSchema: struct<id:string>" in p
    assert [r[0] for r in q.collect()] == ["x"]


def test_county_index_is_broadcast_after_check(spark):
    from footmark.operators.counties import county_index, mask_by_county
    counties = spark.createDataFrame([("06067", W.wkb_polygon([[(0, 0), (100, 0), (100, 100), (0, 100)]]))],
                                     "fips string, geometry binary")
    idx = county_index(counties)
    assert idx.broadcastable and idx.n_cells > 0
    feats = spark.createDataFrame([("a", W.wkb_point(5, 5))], "id string, geometry binary")
    p = plan_text(mask_by_county(feats, idx))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
