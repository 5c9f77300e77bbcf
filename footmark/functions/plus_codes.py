"""Open Location Code ("plus code") of a point, as Column math.

Integer form: latitude and longitude are turned into counts of the finest
cells of a 15-digit code, ``floor((lat + 90) * 25e6)`` and
``floor((lon + 180) * 8.192e6)``, and divided down: 10 pair digits (base 20)
then grid digits (5 rows x 4 columns each). The default length is 13 digits
plus the '+' separator after the eighth, i.e. 14 characters (Q21).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code alphabet and the grid steps of the 15-digit form.
ALPHABET = "23456789CFGHJMPQRVWX"
LAT_CELLS_PER_DEGREE = 25_000_000
LON_CELLS_PER_DEGREE = 8_192_000
MAX_GRID_DIGITS = 5


def _digit(v: Column) -> Column:
    return F.substring(F.lit(ALPHABET), (v + 1).cast("int"), 1)


def plus_code(lat: Column, lon: Column, length: int = 13) -> Column:
    """Plus code of (lat, lon) degrees with ``length`` digits (10 < length <= 15)."""
    if not 10 < length <= 15:
        raise ValueError("length must be in 11..15")
    grid = length - 10
    lat_c = F.least(F.greatest(lat, F.lit(-90.0)), F.lit(90.0))
    lon_n = F.pmod(lon + F.lit(180.0), F.lit(360.0))
    lat_v = F.floor((lat_c + F.lit(90.0)) * F.lit(float(LAT_CELLS_PER_DEGREE)))
    lat_v = F.least(lat_v, F.lit(180 * LAT_CELLS_PER_DEGREE - 1))
    lon_v = F.floor(lon_n * F.lit(float(LON_CELLS_PER_DEGREE)))
    drop = MAX_GRID_DIGITS - grid
    lat_v = F.floor(lat_v / F.lit(5 ** drop))
    lon_v = F.floor(lon_v / F.lit(4 ** drop))
    grid_digits = []
    for i in range(grid):
        lat_d = F.floor(lat_v / F.lit(5 ** (grid - 1 - i))) % 5
        lon_d = F.floor(lon_v / F.lit(4 ** (grid - 1 - i))) % 4
        grid_digits.append(_digit(lat_d * 4 + lon_d))
    lat_p = F.floor(lat_v / F.lit(5 ** grid))
    lon_p = F.floor(lon_v / F.lit(4 ** grid))
    pairs = []
    for i in range(5):
        div = 20 ** (4 - i)
        pairs.append(_digit(F.floor(lat_p / F.lit(div)) % 20))
        pairs.append(_digit(F.floor(lon_p / F.lit(div)) % 20))
    code = F.concat(*pairs[:8], F.lit("+"), *pairs[8:], *grid_digits)
    return F.when(lat.isNotNull() & lon.isNotNull(), code)
