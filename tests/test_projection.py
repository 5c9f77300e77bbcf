"""Albers (EPSG:5070) and plus codes: golden points."""

import numpy as np
import pytest

import math

from footmark.functions import plus_codes as PC
from footmark.functions import projection as P


def plus_code_py(lat: float, lon: float, length: int = 13) -> str:
    """Plain-Python twin of the Column version."""
    grid = length - 10
    lat = min(max(lat, -90.0), 90.0)
    lat_v = min(math.floor((lat + 90) * PC.LAT_CELLS_PER_DEGREE), 180 * PC.LAT_CELLS_PER_DEGREE - 1)
    lon_v = math.floor(((lon + 180) % 360) * PC.LON_CELLS_PER_DEGREE)
    lat_v //= 5 ** (PC.MAX_GRID_DIGITS - grid)
    lon_v //= 4 ** (PC.MAX_GRID_DIGITS - grid)
    g = ""
    for _ in range(grid):
        g = PC.ALPHABET[(lat_v % 5) * 4 + lon_v % 4] + g
        lat_v //= 5
        lon_v //= 4
    p = ""
    for _ in range(5):
        p = PC.ALPHABET[lat_v % 20] + PC.ALPHABET[lon_v % 20] + p
        lat_v //= 20
        lon_v //= 20
    return p[:8] + "+" + p[8:] + g

SACRAMENTO = (-2173811.0344732204, 2020779.6029776197)
SANTA_BARBARA = (-2152236.043699582, 1532664.814801817)


def test_constants():
    assert P.N == pytest.approx(0.6029027690657601, abs=1e-15)
    assert P.C == pytest.approx(1.3491820315609704, abs=1e-15)
    assert P.RHO0 == pytest.approx(9928937.004248781, abs=1e-6)


def test_inverse_golden_points():
    lon, lat = P.albers_inverse_np(np.array([SACRAMENTO[0], SANTA_BARBARA[0]]),
                                   np.array([SACRAMENTO[1], SANTA_BARBARA[1]]))
    assert lat[0] == pytest.approx(38.576560152892, abs=1e-9)
    assert lon[0] == pytest.approx(-121.493284211688, abs=1e-9)
    assert lat[1] == pytest.approx(34.413579, abs=1e-6)
    assert lon[1] == pytest.approx(-119.84664, abs=1e-6)


def test_round_trip():
    lon = np.linspace(-124, -67, 50)
    lat = np.linspace(25, 49, 50)
    x, y = P.albers_forward_np(lon, lat)
    lon2, lat2 = P.albers_inverse_np(x, y)
    x2, y2 = P.albers_forward_np(lon2, lat2)
    assert np.max(np.hypot(x2 - x, y2 - y)) < 1e-6


def test_plus_codes():
    lon, lat = P.albers_inverse_np(np.array([SACRAMENTO[0]]), np.array([SACRAMENTO[1]]))
    assert plus_code_py(lat[0], lon[0]) == "84CWHGG4+JMGH4"
    assert len(plus_code_py(lat[0], lon[0])) == 14
    assert plus_code_py(47.0000625, 8.0000625)[:11] == "8FVC2222+22"
    assert plus_code_py(20.3700625, 2.7821875)[:11] == "7FG49QCJ+2V"
    lon, lat = P.albers_inverse_np(np.array([SANTA_BARBARA[0]]), np.array([SANTA_BARBARA[1]]))
    assert plus_code_py(lat[0], lon[0]).startswith("8562C573+")


def test_column_forms_match_numpy(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([SACRAMENTO, SANTA_BARBARA], "x double, y double")
    lon, lat = P.albers_inverse(F.col("x"), F.col("y"))
    rows = df.select(lon.alias("lon"), lat.alias("lat"), PC.plus_code(lat, lon).alias("code")).collect()
    assert rows[0]["code"] == "84CWHGG4+JMGH4"
    assert rows[1]["code"] == "8562C573+C8Q4R"
    assert rows[0]["lat"] == pytest.approx(38.576560152892, abs=1e-9)
