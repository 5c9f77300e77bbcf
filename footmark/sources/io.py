"""Readers and writers (S1, S4-S9); layers clustered by place and read by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.curve import box_key
from ..functions.geometry import with_bbox
from ..schema import CONFORM, CROSSREF, ENTITIES, FOOTPRINTS, PROVIDERS
from .manifest import BOX, begin, manifest_path, read_manifest, record

#: Bytes of a row group: the unit that a window leaves out, besides the pages within it.
BLOCK_BYTES = 32 << 20


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             schema: T.StructType | None = None, geometry: str = "geometry",
             within=None, covering: str = "bbox") -> DataFrame:
    """Read a raw provider layer with geometry as WKB binary.

    parquet: the geometry column must already be WKB. csv / json: the geometry
    column holds hex WKB and is decoded with ``unhex``. geojson: one GeoJSON
    feature per line (gzip is read natively); properties become columns and
    the geometry is encoded to WKB. An explicit ``schema`` skips inference.

    ``within``: boxes (xmin, ymin, xmax, ymax) of which a feature's box must touch one. It needs a
    parquet layer with the struct column ``covering`` (see :func:`write_raw_layer`) and is pushed
    into the scan. Rows with a null covering are kept.
    """
    if within is not None:
        if fmt != "parquet":
            raise ValueError("a window needs a parquet layer with a covering column")
        return covered(read_raw(spark, path, fmt, schema, geometry), within, covering)
    r = spark.read
    if fmt == "geojson":
        return read_geojson(spark, path, schema, geometry)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "parquet":
        return r.parquet(path)
    if fmt == "csv":
        df = r.option("header", True).csv(path)
        return df.withColumn(geometry, F.unhex(F.col(geometry)))
    if fmt == "json":
        df = r.json(path)
        return df.withColumn(geometry, F.unhex(F.col(geometry)))
    raise ValueError(f"unsupported format {fmt!r}")


def read_geojson(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 geometry: str = "geometry") -> DataFrame:
    """GeoJSON features, one a line, of any mix of geometry types.

    The geometry is parsed from its own text, so that types with different nesting do not have to
    share one inferred schema. ``schema`` gives the properties and their types (a field named as
    the geometry column is skipped) and saves the pass that infers their names; without it all
    properties are strings.
    """
    from ..functions.geometry import st_from_geojson
    text = spark.read.text(path).filter(F.trim("value") != "")
    if schema is None:
        seen = spark.read.option("primitivesAsString", "true").json(path).schema
        fields = [T.StructField(f.name, T.StringType()) for f in seen["properties"].dataType.fields] \
            if "properties" in seen.names else []
    else:
        fields = [f for f in schema.fields if f.name != geometry]
    props = F.from_json(F.get_json_object("value", "$.properties"), T.StructType(fields)) if fields else F.lit(None)
    rows = text.select(props.alias("p"), F.get_json_object("value", "$.geometry").alias("g"))
    return rows.select(*[F.col("p").getField(f.name).alias(f.name) for f in fields], st_from_geojson("g").alias(geometry))


def touches(boxes, prefix: str = "") -> Column:
    """Whether the box of the columns ``xmin``, ``ymin``, ``xmax``, ``ymax`` touches one of ``boxes``.

    Plain comparisons of columns and literals, which the parquet scan takes over."""
    x0, y0, x1, y1 = (F.col(f"{prefix}{c}") for c in BOX)
    hit = F.lit(False)
    for a, b, c, d in boxes:
        hit = hit | ((x0 <= F.lit(float(c))) & (x1 >= F.lit(float(a))) & (y0 <= F.lit(float(d))) & (y1 >= F.lit(float(b))))
    return hit


def covered(df: DataFrame, boxes, covering: str = "bbox") -> DataFrame:
    """Rows whose covering touches one of ``boxes`` or is null."""
    return df.filter(F.col(f"{covering}.xmin").isNull() | touches(boxes, f"{covering}."))


def write_raw_layer(df: DataFrame, path: str, geometry: str = "geometry", covering: str = "bbox",
                    block_bytes: int = BLOCK_BYTES) -> None:
    """Write a raw layer once for many reads by window: along a Hilbert curve, with each geometry's
    box in the struct column ``covering``. Rows with a null geometry are kept, with a null box."""
    if covering in df.columns:
        raise ValueError(f"the layer has a column {covering!r} already")
    names = [F.col(f"`{c}`") for c in df.columns]
    boxed = with_bbox(df.select(*names), geometry, prefix="__c_")
    out = boxed.withColumn("__curve", box_key("__c_")).repartitionByRange("__curve").sortWithinPartitions("__curve") \
        .select(*names, F.struct(*[F.col(f"__c_{c}").alias(c) for c in BOX]).alias(covering))
    out.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", block_bytes).parquet(path)


def write_conformed(df: DataFrame, path: str, only: Column | None = None, block_bytes: int = BLOCK_BYTES) -> None:
    """Zstd parquet partitioned by fips and provider, and their manifest.

    Partitions of ``df`` replace those on disk, so that a rerun of a job that was lost half way leaves
    no row twice; all others stay. Rows keep their box (computed where ``df`` lacks it) and lie along a
    Hilbert curve, so a window reads few row groups. ``only``: condition on fips and provider that
    holds for the partitions of ``df``; the manifest is brought up to date for these (default: all).

    ``rebalance`` keeps files per partition few but splits skewed ones.
    """
    spark = df.sparkSession
    if not path_exists(spark, manifest_path(path)):
        if path_exists(spark, path):
            raise ValueError(f"{path} has layers without a manifest and without boxes; write to a new folder")
        begin(spark, path)
    if not all(c in df.columns for c in BOX):
        df = with_bbox(df)
    cols = [f.name for f in CONFORM.fields]
    (df.select(*cols, *BOX, "fips", "provider").withColumn("__curve", box_key())
       .hint("rebalance", "fips", "provider")
       # by fips and provider first: else the writer sorts by them once more, and this order is lost
       .sortWithinPartitions("fips", "provider", "__curve").drop("__curve")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd").option("parquet.block.size", block_bytes)
       .partitionBy("fips", "provider").parquet(path))
    back = read_conformed(spark, path, keep_bbox=True)
    record(back if only is None else back.filter(only), path)


def existing_partitions(spark: SparkSession, path: str) -> DataFrame | None:
    """The (fips, provider) partitions already written under ``path``.

    From the manifest, without a scan; a folder without one is listed."""
    if not path_exists(spark, path):
        return None
    if path_exists(spark, manifest_path(path)):
        return read_manifest(spark, path).select("fips", "provider")
    return read_conformed(spark, path).select("fips", "provider").distinct()


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    fs, jpath = _hadoop(spark, path)
    return fs.getContentSummary(jpath).getLength()


def read_conformed(spark: SparkSession, path: str, within=None, keep_bbox: bool = False,
                   skip_corrupt: bool = False) -> DataFrame:
    """Scan conformed layers; fips/provider stay strings (Q25).

    ``within``: boxes (xmin, ymin, xmax, ymax); only rows whose box touches one. The manifest gives the
    counties to open, the scan leaves out row groups by their statistics. ``keep_bbox`` keeps the
    box columns. Both compute the boxes where the folder has no manifest (and so no boxes).
    """
    boxed = (keep_bbox or within is not None) and path_exists(spark, manifest_path(path))
    keys = [T.StructField("fips", T.StringType()), T.StructField("provider", T.StringType())]
    schema = T.StructType(CONFORM.fields + ([T.StructField(c, T.DoubleType()) for c in BOX] if boxed else []) + keys)
    df = spark.read.schema(schema).option("basePath", path).option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(path)
    if within is not None:
        if boxed:
            met = read_manifest(spark, path).filter(touches(within)).select("fips").distinct()
            df = df.filter(F.col("fips").isin([r[0] for r in met.collect()]))  # county codes
        df = (df if boxed else with_bbox(df)).filter(touches(within))
    elif keep_bbox and not boxed:
        df = with_bbox(df)
    names = [f.name for f in CONFORM.fields] + ["fips", "provider"]
    return df.select(*names, *(BOX if keep_bbox else ()))


def provider_rank(col: str = "provider"):
    """Declaration order of providers, for sorting (O1)."""
    expr = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(PROVIDERS))):
        expr = F.when(F.col(col) == p, F.lit(i)).otherwise(expr)
    return expr


def entities_table(conflated: DataFrame) -> DataFrame:
    """Id, classification, address, height, levels, x, y (+ fips)."""
    keys = [c for c in ("fips",) if c in conflated.columns]
    return conflated.select("id", "classification", "address", "height", "levels", "x", "y", *keys)


def crossref_table(conflated: DataFrame) -> DataFrame:
    """One row per reference: entity_id, provider, provider_id (+ fips).

    Every entity carries at least its own reference, so ``explode_outer``
    yields no null rows in practice.
    """
    keys = [c for c in ("fips",) if c in conflated.columns]
    return conflated.select(F.col("id").alias("entity_id"), *keys,
                            F.explode_outer("foreign").alias("f")) \
        .select("entity_id", F.col("f.provider").alias("provider"),
                F.col("f.key").alias("provider_id"), *keys)


def footprints_table(footprints: DataFrame) -> DataFrame:
    """Provider, id, geometry (+ fips), one row per (provider, id)."""
    keys = [c for c in ("fips",) if c in footprints.columns]
    fp = footprints.select("provider", "id", "geometry", *keys)
    return fp.groupBy(*keys, "provider", "id").agg(F.min("geometry").alias("geometry")) \
        .select("provider", "id", "geometry", *keys)


def write_partitioned(df: DataFrame, path: str, sort_cols: list | None = None, fips=None) -> None:
    """Write one output table partitioned by fips (zstd), sorted within files.

    Without ``fips`` the whole table is replaced. With it only these counties are: the others stay,
    and of these the ones that have no rows any more are removed.

    The ``rebalance`` hint clusters rows by fips (few files per county) while
    adaptive execution splits a county too large for one task.
    """
    w = df.hint("rebalance", "fips")
    if sort_cols:
        # by fips first: else the writer sorts by it once more, and this order is lost
        w = w.sortWithinPartitions("fips", *sort_cols)
    out = w.write.mode("overwrite").option("compression", "zstd").partitionBy("fips")
    if fips is None:
        out.parquet(path)
        return
    spark = df.sparkSession
    now = {r[0] for r in df.select("fips").distinct().collect()}  # at most the requested counties
    out.option("partitionOverwriteMode", "dynamic").parquet(path)
    for f in sorted(set(fips) - now):
        fs, gone = _hadoop(spark, f"{path}/fips={f}")
        fs.delete(gone, True)


def write_outputs(entities: DataFrame, crossref: DataFrame, footprints: DataFrame, output: str,
                  fips=None) -> None:
    """The three conflate tables under ``output/conflate``; ``fips``: replace only these counties."""
    fips = None if fips is None else list(fips)
    write_partitioned(entities, f"{output}/conflate/entities", fips=fips)
    write_partitioned(crossref.withColumn("__r", provider_rank()), f"{output}/conflate/crossref",
                      [F.asc_nulls_last("entity_id"), F.asc_nulls_last("__r")], fips=fips)
    write_partitioned(footprints, f"{output}/conflate/footprints", fips=fips)


def read_outputs(spark: SparkSession, output: str, fips=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, crossref and footprints as written under ``output`` (of these counties only)."""
    def table(name: str, schema: T.StructType) -> DataFrame:
        df = spark.read.schema(T.StructType(schema.fields + [T.StructField("fips", T.StringType())])).parquet(f"{output}/conflate/{name}")
        return df if fips is None else df.filter(F.col("fips").isin(list(fips)))

    return table("entities", ENTITIES), table("crossref", CROSSREF), table("footprints", FOOTPRINTS)
