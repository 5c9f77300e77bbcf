"""County reference layer (S10): GeoJSON lines (gzip is read natively) -> counties table.

Output: ``fips, county_name, state_name, state_abbr, geometry`` (WKB, EPSG:5070).
The file is a fixed reference layer (~3,200 rows); it is read once per job and
indexed by :class:`footmark.operators.counties.CountyIndex`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import st_transform_to_5070
from .io import read_geojson


def read_counties(spark: SparkSession, path: str, *, fips: str = "fips", name: str = "name",
                  state: str = "state", abbr: str = "abbr", epsg: int = 4326) -> DataFrame:
    """Read GeoJSON features (one per line) with the given property names.

    Geometry in degrees (``epsg=4326``) is projected to EPSG:5070; ``epsg=5070``
    keeps it. The fips code is read as text and zero-padded to 5 characters.
    """
    fields = T.StructType([T.StructField(c, T.StringType()) for c in dict.fromkeys((fips, name, state, abbr))])
    raw = read_geojson(spark, path, fields)
    geom = F.col("geometry")
    if epsg == 4326:
        geom = st_transform_to_5070(geom)
    elif epsg != 5070:
        raise ValueError(f"unsupported EPSG {epsg}")
    return raw.select(
        F.lpad(F.col(f"{fips}").cast("string"), 5, "0").alias("fips"),
        F.col(f"{name}").cast("string").alias("county_name"),
        F.col(f"{state}").cast("string").alias("state_name"),
        F.col(f"{abbr}").cast("string").alias("state_abbr"),
        geom.alias("geometry"),
    )
