"""Built-in provider conforms.

Each maps a raw layer to the CONFORM schema ``id, classification, address,
height, levels, geometry`` as a DataFrame plan. A ``fips`` column, when the
raw layer carries one (after the county mask), is passed through and used as
an extra grouping key, so all counties conform in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import st_centroid_xy, st_points
from ..functions.text import (concat_str, normalize_str, null_if_empty_str, parse_height,
                              parse_levels)
from ..schema import CONFORM
from .registry import register_provider

# Fixed value: the all-zero GUID some NAD rows carry instead of an id.
NULL_UUID = "00000000-0000-0000-0000-000000000000"



def _null(t: str) -> Column:
    """A typed null literal."""
    return F.lit(None).cast(t)


def geometry_hash(geometry: Column) -> Column:
    """sha256 hex of the base64 text of the WKB.

    Spark's ``base64`` wraps lines (CRLF every 76 characters); the line breaks
    are removed so the text is the plain base64 the id is defined on.
    """
    return F.sha2(F.regexp_replace(F.base64(geometry), r"[\r\n]", ""), 256)


def _extra(df: DataFrame) -> list[str]:
    """Pass-through columns: ``fips`` and, for geometry-preserving conforms, the box."""
    return [c for c in ("fips", "xmin", "ymin", "xmax", "ymax") if c in df.columns]


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("fips",) if c in df.columns]


def to_conform(df: DataFrame) -> DataFrame:
    """Strict cast to the CONFORM schema (plus ``fips`` when present).

    A row without an id gets one made from its geometry and address, so that
    every later step (minimum per footprint, one row per id, anti joins) can
    tell it from other rows without an id.
    """
    made = F.sha2(F.concat(F.regexp_replace(F.base64("geometry"), r"[\r\n]", ""), F.coalesce("address", F.lit(""))), 256)
    df = df.withColumn("id", F.coalesce(F.col("id").cast("string"), made))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CONFORM.fields],
                     *_extra(df))


MICROSOFT_SCHEMA = T.StructType([
    T.StructField("height", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("geometry", T.BinaryType()),
])


@register_provider("microsoft", source_schema=MICROSOFT_SCHEMA, epsg=4326)
def conform_microsoft(df: DataFrame) -> DataFrame:
    """C1 Microsoft building footprints: id = T7 hash of the geometry; negative height -> null."""
    return df.select(
        geometry_hash(F.col("geometry")).alias("id"),
        _null("string").alias("classification"),
        _null("string").alias("address"),
        F.when(F.col("height") < 0, _null("double")).otherwise(F.col("height")).alias("height"),
        _null("int").alias("levels"),
        F.col("geometry"),
        *_extra(df),
    )


@register_provider("nad")
def conform_nad(df: DataFrame) -> DataFrame:
    """C2 National Address Database points.

    id = UUID, or the T7 geometry hash when UUID is the all-zero GUID; a null
    UUID stays null (Q7). Addr_Type 'Unknown'/'Other' -> null. address =
    number, street and sub-address joined, stripped and lowercased.
    """
    uuid = F.col("UUID")
    return df.select(
        F.when(uuid == F.lit(NULL_UUID), geometry_hash(F.col("geometry"))).otherwise(uuid).alias("id"),
        F.when(F.col("Addr_Type").isin("Unknown", "Other"), _null("string"))
        .otherwise(F.col("Addr_Type")).alias("classification"),
        normalize_str(concat_str("AddNo_Full", "StNam_Full", "SubAddress")).alias("address"),
        _null("double").alias("height"),
        _null("int").alias("levels"),
        F.col("geometry"),
        *_extra(df),
    )


@register_provider("openaddresses")
def conform_openaddresses(df: DataFrame, mode: str = "per_address") -> DataFrame:
    """C3 OpenAddresses points, one row per address point.

    ``id``/``region`` are dropped and exact duplicates removed (D1); X/Y is the
    centroid; address = number + street (unit left out), stripped and
    lowercased; rows without an address or with address '0' are dropped (F5).

    mode="per_address" (default): rows are counted per (X, Y, number,
    street); a row alone in its group is kept with its hash as id; groups of
    several rows collapse to one row per point (X, Y), the one with the
    smallest hash (rows without one last), whose hash becomes the id.
    mode="per_point": the literal reading of the source rule (Q8): one row
    per point.

    Built from aggregations (no windows), so a point holding a large share of
    all rows is reduced map-side before any shuffle.
    """
    keys = _keys(df)   # the geometry is re-made below, so no box passes through
    base = df.drop("id", "region", "xmin", "ymin", "xmax", "ymax").distinct()
    c = st_centroid_xy(F.col("geometry"))
    base = base.select("*", c["x"].alias("X"), c["y"].alias("Y")) \
        .withColumn("address", normalize_str(concat_str("number", "street"))) \
        .filter(F.col("address").isNotNull() & (F.col("address") != "0"))
    row = F.struct(F.col("hash").isNull(), F.col("hash"), F.col("address"), F.col("geometry"))  # rows without a hash last
    if mode == "per_point":
        one = base.groupBy(*keys, "X", "Y").agg(F.min(row).alias("row"))
    elif mode == "per_address":
        g = base.groupBy(*keys, "X", "Y", "number", "street").agg(
            F.count(F.lit(1)).alias("cnt"), F.min(row).alias("row"))
        singles = g.filter(F.col("cnt") == 1).select(*keys, "row")
        multis = g.filter(F.col("cnt") > 1).groupBy(*keys, "X", "Y").agg(F.min("row").alias("row")) \
            .select(*keys, "row")
        one = singles.unionByName(multis)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return one.select(
        F.col("row.hash").alias("id"),
        _null("string").alias("classification"),
        F.col("row.address").alias("address"),
        _null("double").alias("height"),
        _null("int").alias("levels"),
        F.explode_outer(st_points(F.col("row.geometry"))).alias("geometry"),
        *keys,
    )


def address_units(df: DataFrame, point: list[str], order: str, fill: list[str]) -> DataFrame:
    """One row per ``point`` with ``unit_count`` rows, the first hash, and each ``fill`` column's
    first value in ``order`` that isn't null.

    That is what the first row of a group holds once its columns are filled backward. It is a partial
    aggregation, not a window, so a point that holds a large share of all rows is no task of its own.
    """
    def filled(c):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))["v"].alias(c)
    return df.groupBy(*point).agg(F.count(F.lit(1)).alias("unit_count"), F.min("hash").alias("hash"), *[filled(c) for c in fill])


@register_provider("openstreetmap")
def conform_openstreetmap(df: DataFrame) -> DataFrame:
    """C4 OpenStreetMap buildings.

    Only features with a ``building`` key (F1). id = osm_id else osm_way_id.
    classification = building, amenity or leisure, then 'yes' -> null (after
    the coalesce, so building=yes never falls through to amenity). address =
    name, house number, street and unit joined (case kept). Parking and
    parking_space features and the 'UniversityPly' dataset are dropped (F2).
    height by :func:`parse_height` (C4h), levels by :func:`parse_levels` (C4l).
    """
    d = df.filter(F.col("building").isNotNull())
    cls = F.nullif(F.coalesce(F.col("building"), F.col("amenity"), F.col("leisure")), F.lit("yes"))
    d = d.select(
        F.coalesce(F.col("osm_id"), F.col("osm_way_id")).alias("id"),
        cls.alias("classification"),
        concat_str("name", "addr_housenumber", "addr_street", "addr_unit").alias("address"),
        F.col("height").alias("height_text"),
        F.col("building_levels").alias("levels_text"),
        F.col("dataset"),
        F.col("geometry"),
        *_extra(df),
    )
    c = F.col("classification")
    d = d.filter((c.isNull() | ~c.isin("parking", "parking_space")) &
                 (F.col("dataset").isNull() | (F.col("dataset") != "UniversityPly")))
    return d.select(
        "id", "classification", "address",
        parse_height(F.col("height_text")).alias("height"),
        parse_levels(F.col("levels_text"), F.col("classification")).alias("levels"),
        "geometry",
        *_extra(df),
    )


@register_provider("usa_structures")
def conform_usa_structures(df: DataFrame) -> DataFrame:
    """C5 FEMA USA Structures: id = UUID; OCC_CLS normalised ('' -> null); PROP_ADDR normalised."""
    return df.select(
        F.col("UUID").alias("id"),
        null_if_empty_str(normalize_str(F.col("OCC_CLS"))).alias("classification"),
        normalize_str(F.col("PROP_ADDR")).alias("address"),
        F.col("HEIGHT").cast("double").alias("height"),
        _null("int").alias("levels"),
        F.col("geometry"),
        *_extra(df),
    )
