"""Manifest of the conformed layers: one row per written (fips, provider) partition.

It stands beside the layers (``<path>_manifest``) and is appended after the rows are on disk, from
the rows on disk: a partition without an entry was not finished and is written anew. Skipping (S5)
and the choice of the counties that a window touches read the manifest and start no scan of the
layers; its column ``n`` has the counts of A1 (``provider_counts`` counts any rows, written or not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CONFORM

BOX = ("xmin", "ymin", "xmax", "ymax")
MANIFEST = T.StructType([T.StructField("fips", T.StringType()), T.StructField("provider", T.StringType()),
                         T.StructField("n", T.LongType())]
                        + [T.StructField(c, T.DoubleType()) for c in BOX]
                        + [T.StructField("digest", T.StringType()), T.StructField("written", T.TimestampType())])


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}_manifest"


def describe(rows: DataFrame) -> DataFrame:
    """Rows, box and digest of each partition of conformed ``rows`` (with box columns).

    The digest is the sum of the rows' hashes: any order gives the same, a repeated row counts twice."""
    row_hash = F.xxhash64(*[f.name for f in CONFORM.fields], *BOX).cast("decimal(20,0)")
    return rows.groupBy("fips", "provider").agg(
        F.count(F.lit(1)).alias("n"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), F.sum(row_hash).cast("string").alias("digest"))


def begin(spark: SparkSession, path: str) -> None:
    """Make the (empty) manifest of a new folder of layers."""
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(manifest_path(path))


def record(rows: DataFrame, path: str) -> None:
    """Append the entries of the partitions of ``rows``, which are read from the layers on disk."""
    out = describe(rows).withColumn("written", F.current_timestamp())
    out.select(*MANIFEST.names).coalesce(1).write.mode("append").parquet(manifest_path(path))  # a row a partition


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each partition of the layers under ``path``."""
    m = spark.read.schema(MANIFEST).parquet(manifest_path(path))
    last = F.max_by(F.struct(*[c for c in MANIFEST.names if c not in ("fips", "provider")]), "written").alias("e")
    return m.groupBy("fips", "provider").agg(last).select("fips", "provider", "e.*")


def verify_partitions(spark: SparkSession, path: str) -> DataFrame:
    """fips, provider, state of every partition on disk or in the manifest.

    ``ok``; ``damaged``: rows, box or digest differ, or a file can't be read; ``missing``: listed, but
    no rows on disk; ``unlisted``: on disk, but never finished. Reads all rows of the layers."""
    from .io import read_conformed
    now = describe(read_conformed(spark, path, keep_bbox=True, skip_corrupt=True))
    listed = read_manifest(spark, path).drop("written").withColumn("listed", F.lit(True))
    values = ("n", *BOX, "digest")
    j = now.withColumnsRenamed({c: f"now_{c}" for c in values}).join(listed, ["fips", "provider"], "full")
    same = F.lit(True)
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"now_{c}"))
    state = F.when(F.col("listed").isNull(), "unlisted").when(F.col("now_n").isNull(), "missing").when(same, "ok").otherwise("damaged")
    return j.select("fips", "provider", state.alias("state"))
