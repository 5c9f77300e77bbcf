"""Raw provider layers and counties derived from the driver's tables.

The real provider files are not available, so each raw layer is derived
deterministically from the TPC-H-style tables (see FIXTURES.md): boxes from
``part``, address points from ``customer`` and ``orders``, counties from
``nation`` and ``region``. All coordinates are integer metres in EPSG:5070,
so areas, overlaps and distances are exact and a plain SQL engine can check
them with box arithmetic.

Every layer is a pure DataFrame plan over the input tables: it scales with
them and needs no driver-side data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import st_bbox, st_box, st_point, st_polygon
from ..operators.counties import county_code
from .io import path_exists, size_of

X0 = -2174000
Y0 = 2020000
PITCH = 40
MOVE = 20
#: Bytes of a table's files for one task that makes raw rows of them.
TASK_BYTES = 256 << 10

# ---------------------------------------------------------------------------
# Parser inputs that hit every branch of the height and levels
# rules, plus the street, type and unit vocabularies used for addresses.
HEIGHT_TEXT = ["12", " 12.5 ", "0", "0.0", "3;9;x", "30 ft", "10 m", "10 meters", "30'", "-4",
               "10f", "abc", None]
LEVELS_TEXT = ["3", "0", "Default", "Bi-Level", "Split", "1,2", "2.5", ".5", "1 1/2", "1,2,3",
               "1;4;2", "2; 3", "1-3", "-1", "3+", ">3", "PK2", "3.0", "111", "110", None]
BUILDING = ["yes", "house", "residential", "school", "parking", "garage", "commercial",
            "apartments", None]
AMENITY = [None, "school", "parking_space", "place_of_worship"]
LEISURE = [None, "sports_centre"]
NAMES = [None, "Town Hall", None, "Oak Plaza"]
STREETS = ["Main St", "Oak Dr", "Pine Ct", "Elm Ln", "Maple Ave", "Cedar Rd", "N 1st St",
           "Sunset Blvd"]
UNITS = [None, None, "Apt 2", "Unit B"]
NAD_TYPES = ["Residential", "Unknown", "Commercial", "Other", None]
NAD_SUB = [None, "Apt 1", None, "Unit 3"]
ADDRESS_FORMS = ["St Marys Ave", "E St", "Avenue E", "Ave B Apt 3", "N 1st St", "Main St N", "Hwy 101", "Mt Hope Rd SW, Ste 5",
                 "e main st.", "Broadway", "Old St Rd", "W St Unit W", "St", "Ft Worth Blvd # 12", "", "5", "Sw", "Apt 4", "N Way",
                 "S North St", "1/2 Oak Ct", "Plaza Way Bldg C Fl 2", None]
OCC_CLS = ["Residential", " Commercial ", "", None, "Agriculture"]
DATASETS = [None, "UniversityPly", "Other"]
NULL_UUID = "00000000-0000-0000-0000-000000000000"
# ---------------------------------------------------------------------------


def pick(values: list, idx: Column) -> Column:
    """values[idx] as a column (null entries stay null)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (idx % F.lit(len(values))).cast("int") + 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, name: str, sf_dir: str) -> DataFrame:
    """The few columns read of a table, dealt over tasks by the size of its files.

    A file of a few MB is one row group and so one task, but each of its rows becomes geometries,
    addresses and cells; the keys alone are cheap to move."""
    n = -(-size_of(df.sparkSession, f"{sf_dir}/{name}.parquet") // TASK_BYTES)
    return df.repartition(n) if n > 1 else df


def tasks_of(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that raw rows are made in, over the tables that there are."""
    files = [f"{sf_dir}/{t}.parquet" for t in ("part", "customer", "orders")]
    return sum(-(-size_of(spark, f) // TASK_BYTES) for f in files if path_exists(spark, f))


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read_table(spark, sf_dir, "part").select("p_partkey", "p_size"), "part", sf_dir)
    k = F.col("p_partkey")
    return p.select(
        k.alias("k"),
        (F.lit(X0) + (k % 100) * PITCH).cast("double").alias("gx"),
        (F.lit(Y0) + F.floor(k / 100) * PITCH).cast("double").alias("gy"),
        (F.lit(10) + F.col("p_size") % 10).cast("double").alias("w"),
        (F.lit(8) + k % 5).cast("double").alias("h"),
    )


def _moved(slots: DataFrame, away: Column) -> DataFrame:
    """Boxes without a counterpart: moved up by half the pitch, not left out."""
    return slots.withColumn("gy", F.col("gy") + F.when(away, F.lit(MOVE)).otherwise(F.lit(0)))


def raw_openstreetmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OpenStreetMap raw layer: every part, box (gx, gy, gx+w, gy+h), moved up where k % 5 = 0."""
    s = _moved(_slots(spark, sf_dir), F.col("k") % 5 == 0)
    k = F.col("k")
    num = F.when(k % 6 != 0, (k % 50 + 1).cast("string"))
    return s.select(
        F.when(k % 7 != 0, F.concat(F.lit("osm-"), k.cast("string"))).alias("osm_id"),
        F.concat(F.lit("way-"), k.cast("string")).alias("osm_way_id"),
        pick(BUILDING, k).alias("building"),
        pick(AMENITY, k).alias("amenity"),
        pick(LEISURE, k).alias("leisure"),
        pick(NAMES, k).alias("name"),
        num.alias("addr_housenumber"),
        pick(STREETS, k).alias("addr_street"),
        pick(UNITS, k).alias("addr_unit"),
        pick(LEVELS_TEXT, k).alias("building_levels"),
        pick(HEIGHT_TEXT, k).alias("height"),
        F.when(k % 11 == 3, F.lit("UniversityPly")).when(k % 11 == 4, F.lit("Other")).alias("dataset"),
        st_box(F.col("gx"), F.col("gy"), F.col("gx") + F.col("w"), F.col("gy") + F.col("h")).alias("geometry"),
        k.alias("fixture_key"),
    )


def raw_microsoft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microsoft raw layer: every part, box shifted by dx = (k % 7) * 2, moved up where k % 3 = 0."""
    s = _moved(_slots(spark, sf_dir), F.col("k") % 3 == 0)
    k = F.col("k")
    dx = (k % 7 * 2).cast("double")
    return s.select(
        (k % 9 - 2).cast("double").alias("height"),
        ((k % 10) / 10.0).alias("confidence"),
        st_box(F.col("gx") + dx, F.col("gy"), F.col("gx") + dx + F.col("w"), F.col("gy") + F.col("h")).alias("geometry"),
        k.alias("fixture_key"),
    )


def raw_usa_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """USA Structures raw layer: every part, box shifted by (-3, (k % 4) * 3), moved up where k is odd."""
    s = _moved(_slots(spark, sf_dir), F.col("k") % 2 != 0)
    k = F.col("k")
    dy = (k % 4 * 3).cast("double")
    addr = F.when(k % 3 != 0, F.concat_ws(" ", (k % 50 + 1).cast("string"), pick(STREETS, k)))
    return s.select(
        F.concat(F.lit("usa-"), k.cast("string")).alias("UUID"),
        pick(OCC_CLS, k).alias("OCC_CLS"),
        addr.alias("PROP_ADDR"),
        F.when(k % 6 != 0, (k % 12) * 1.5).alias("HEIGHT"),
        st_box(F.col("gx") - 3, F.col("gy") + dy, F.col("gx") - 3 + F.col("w"),
               F.col("gy") + dy + F.col("h")).alias("geometry"),
        k.alias("fixture_key"),
    )


def raw_nad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAD raw layer: one point per customer."""
    c = F.col("c_custkey")
    cu = spread(read_table(spark, sf_dir, "customer").select("c_custkey"), "customer", sf_dir)
    x = (F.lit(X0) + (c % 100) * PITCH + c % 13).cast("double")
    y = (F.lit(Y0) + F.floor(c / 100) * PITCH - (c % 8) * 2).cast("double")
    uuid = F.when(c % 10 == 0, F.lit(NULL_UUID)).when(c % 10 == 5, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("nad-"), c.cast("string")))
    return cu.select(
        uuid.alias("UUID"),
        pick(NAD_TYPES, c).alias("Addr_Type"),
        F.when(c % 9 != 0, (c % 50 + 1).cast("string")).alias("AddNo_Full"),
        pick(STREETS, c).alias("StNam_Full"),
        pick(NAD_SUB, c).alias("SubAddress"),
        st_point(x, y).alias("geometry"),
        c.alias("fixture_key"),
    )


def raw_openaddresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OpenAddresses raw layer: every order; up to eight rows per point, some without a hash."""
    o = spread(read_table(spark, sf_dir, "orders").select("o_orderkey"), "orders", sf_dir)
    ok = F.col("o_orderkey")
    b = F.floor(ok / 8)
    x = (F.lit(X0) + (b % 100) * PITCH + b % 13 + (b % 6) * 3).cast("double")
    y = (F.lit(Y0) + F.floor(b / 100) * PITCH - (b % 8) * 2).cast("double")
    number = F.when(ok % 24 == 4, b + 1).otherwise(b).cast("string")
    return o.select(
        F.concat(F.lit("oa-"), ok.cast("string")).alias("id"),
        F.lit("CA").alias("region"),
        F.when(ok % 56 != 9, ok.cast("string")).alias("hash"),
        number.alias("number"),
        F.when(b % 50 != 0, pick(STREETS, b)).alias("street"),
        F.when(b % 4 == 1, F.lit("Apt 1")).alias("unit"),
        st_point(x, y).alias("geometry"),
        ok.alias("fixture_key"),
    )


def halved(layer: DataFrame, upper: Column) -> DataFrame:
    """A footprint layer as (fixture_key, geometry) with each box cut along the diagonal from its lower
    left corner: the upper left triangle where ``upper``, else the lower right one."""
    b = layer.select("fixture_key", st_bbox("geometry").alias("b"))
    x0, y0, x1, y1 = (F.col(f"b.{k}") for k in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.when(upper, F.array(x0, y0, x1, y1, x0, y1)).otherwise(F.array(x0, y0, x1, y0, x1, y1))
    return b.select("fixture_key", st_polygon(ring).alias("geometry"))


RAW_LAYERS = {
    "openstreetmap": raw_openstreetmap,
    "microsoft": raw_microsoft,
    "usa_structures": raw_usa_structures,
    "nad": raw_nad,
    "openaddresses": raw_openaddresses,
}


def raw_layer(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    return RAW_LAYERS[provider](spark, sf_dir)


def county_height(spark: SparkSession, sf_dir: str) -> float:
    """Height of a county from the largest keys (three one-row aggregates over one column each)."""
    top = 0
    for table, key, per in (("part", "p_partkey", 1), ("customer", "c_custkey", 1), ("orders", "o_orderkey", 8)):
        top = max(top, (read_table(spark, sf_dir, table).agg(F.max(key)).first()[0] or 0) // per)
    return max(2000.0, 1000.0 * math.ceil((Y0 + (top // 100 + 2) * PITCH - 2018000) / 6000))


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic county layer, one rectangle per ``nation`` row.

    Nations 0..23 tile a 4 x 6 grid around the slots (split lines at
    x = -2174000 and -2172000 run through the data): 2 km wide, and as high as
    it takes for the six rows to cover the layers, which grow to the north with
    the tables (2 km at least, in whole km). Nation 24 is a 20 km square far to
    the south with nothing in it. fips = state (region + 1,
    two digits) ++ county (4 * nationkey + 1, three digits), so codes keep
    leading zeros ("01001").
    """
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("n_nationkey")
    far = k >= 24
    xmin = F.when(far, F.lit(-2160000.0)).otherwise(F.lit(-2176000.0) + (k % 4) * 2000.0)
    high = county_height(spark, sf_dir)
    ymin = F.when(far, F.lit(1520000.0)).otherwise(F.lit(2018000.0) + F.floor(k / 4) * high)
    size = F.when(far, F.lit(20000.0)).otherwise(F.lit(2000.0))
    high = F.when(far, F.lit(20000.0)).otherwise(F.lit(high))
    return (n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(county_code(F.col("n_regionkey") + 1, k * 4 + 1).alias("fips"),
                    F.col("n_name").alias("county_name"),
                    F.col("r_name").alias("state_name"),
                    F.upper(F.substring(F.col("r_name"), 1, 2)).alias("state_abbr"),
                    st_box(xmin, ymin, xmin + size, ymin + high).alias("geometry")))


def slanted_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counties cut in two along the diagonal from their lower left corner: the lower right triangle
    keeps the code, the upper left one has the next number."""
    c = counties(spark, sf_dir).select("*", st_bbox("geometry").alias("b"))
    x0, y0, x1, y1 = (F.col(f"b.{k}") for k in ("xmin", "ymin", "xmax", "ymax"))
    halves = F.array(F.struct(F.lit(0).alias("n"), F.array(x0, y0, x1, y0, x1, y1).alias("ring")),
                     F.struct(F.lit(1).alias("n"), F.array(x0, y0, x1, y1, x0, y1).alias("ring")))
    c = c.select("*", F.explode(halves).alias("half"))
    number = F.substring("fips", 3, 3).cast("int") + F.col("half.n")
    return c.select(county_code(F.substring("fips", 1, 2), number).alias("fips"), "county_name", "state_name", "state_abbr",
                    st_polygon("half.ring").alias("geometry"))


def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strips of 1,000 km by 50 m through the counties, one per nation: features with bad coordinates."""
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    y = (F.lit(2018000.0) + F.col("k") * 100).cast("double")
    return n.select(F.col("k").alias("fixture_key"), st_box(F.lit(-2676000.0), y, F.lit(-1676000.0), y + 50).alias("geometry"))
