"""Cells in narrow counties."""

from pyspark.sql import functions as F

from footmark.functions.geometry import st_box, st_point
from footmark.operators.counties import CountyIndex, county_pairs, finest_cell, mask_by_county


def _strips(spark, high=80_000.0):
    """Four counties of 2 km by ``high``, side by side."""
    k = F.col("id")
    return spark.range(4).select(F.format_string("010%02d", k).alias("fips"), st_box(k * 2000.0, F.lit(0.0), k * 2000.0 + 2000.0, F.lit(high)).alias("geometry"))


def test_narrow_counties_have_inside_cells(spark):
    layer = _strips(spark)
    points = spark.range(4000).select("id", st_point(((F.col("id") * 37) % 8000).cast("double"), ((F.col("id") * 1013) % 80_000).cast("double")).alias("geometry"))
    index = CountyIndex(layer)
    assert county_pairs(points, index).filter("__decided").select("id").distinct().count() > 2000
    got = {(r["id"], r["fips"]) for r in mask_by_county(points, index).select("id", "fips").collect()}
    x = [(i, i * 37 % 8000) for i in range(4000)]
    assert got == {(i, f"010{c:02d}") for i, at in x for c in range(4) if c * 2000 <= at <= c * 2000 + 2000}


def test_finest_cell_is_the_extents_sixteenth_for_wide_counties_and_bounded_for_many():
    assert finest_cell(40_000.0, 40_000.0, 24 * 1.6e9, 24 * 160_000.0) == 2500.0
    assert finest_cell(80_000.0, 2000.0, 24 * 1.6e8, 24 * 164_000.0) == 250.0
    wide = finest_cell(60_000.0, 20_000.0, 3200 * 1.2e9, 3200 * 160_000.0)  # a country's counties keep the coarse cells
    assert wide == 3750.0
    fine = finest_cell(480_000.0, 2000.0, 24 * 9.6e8, 24 * 964_000.0)
    assert 250.0 < fine < 1000.0 and 24 * 9.6e8 / fine ** 2 + 3 * 24 * 964_000.0 / fine <= 300_000
