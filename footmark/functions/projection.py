"""EPSG:5070 (NAD83 / Conus Albers) <-> geographic degrees, as Column math.

Albers equal-area conic on the GRS80 ellipsoid, standard parallels 29.5 and
45.5, origin 23 N 96 W, no false easting/northing (Snyder, "Map Projections
- A Working Manual", USGS PP 1395, 1987, eqs. 14-1 to 14-21 and 3-16).
The inverse uses the latitude series plus one Newton step on q(phi), which
brings the round trip under a micrometre. NAD83 is taken as WGS84.

The same formulas are provided for numpy arrays (geometry reprojection
inside Arrow UDFs).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 and EPSG:5070 parameters.
A = 6378137.0
INV_F = 298.257222101
LAT1, LAT2, LAT0, LON0 = 29.5, 45.5, 23.0, -96.0

_f = 1.0 / INV_F
E2 = 2 * _f - _f * _f
E = math.sqrt(E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - (1 / (2 * E)) * math.log((1 - E * s) / (1 + E * s)))


def _m(phi: float) -> float:
    s = math.sin(phi)
    return math.cos(phi) / math.sqrt(1 - E2 * s * s)


_p1, _p2, _p0 = map(math.radians, (LAT1, LAT2, LAT0))
N = (_m(_p1) ** 2 - _m(_p2) ** 2) / (_q(_p2) - _q(_p1))
C = _m(_p1) ** 2 + N * _q(_p1)
RHO0 = A * math.sqrt(C - N * _q(_p0)) / N
QP = 1 - (1 - E2) / (2 * E) * math.log((1 - E) / (1 + E))
E4, E6 = E2 * E2, E2 * E2 * E2
S2 = E2 / 3 + 31 * E4 / 180 + 517 * E6 / 5040
S4 = 23 * E4 / 360 + 251 * E6 / 3780
S6 = 761 * E6 / 45360


def _lit(v: float) -> Column:
    return F.lit(float(v))


def _q_col(phi: Column) -> Column:
    s = F.sin(phi)
    return _lit(1 - E2) * (s / (_lit(1) - _lit(E2) * s * s)
                           - _lit(1 / (2 * E)) * F.ln((_lit(1) - _lit(E) * s) / (_lit(1) + _lit(E) * s)))


def albers_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(lon, lat) degrees -> (x, y) metres in EPSG:5070."""
    phi = F.radians(lat)
    rho = _lit(A) * F.sqrt(_lit(C) - _lit(N) * _q_col(phi)) / _lit(N)
    theta = _lit(N) * (F.radians(lon) - _lit(math.radians(LON0)))
    return rho * F.sin(theta), _lit(RHO0) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """(x, y) metres in EPSG:5070 -> (lon, lat) degrees."""
    dy = _lit(RHO0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy)
    q = (_lit(C) - rho * rho * _lit(N * N) / _lit(A * A)) / _lit(N)
    beta = F.asin(q / _lit(QP))
    phi = beta + _lit(S2) * F.sin(beta * 2) + _lit(S4) * F.sin(beta * 4) + _lit(S6) * F.sin(beta * 6)
    s = F.sin(phi)
    w = _lit(1) - _lit(E2) * s * s
    phi = phi + w * w / (_lit(2) * F.cos(phi)) * (
        q / _lit(1 - E2) - s / w + _lit(1 / (2 * E)) * F.ln((_lit(1) - _lit(E) * s) / (_lit(1) + _lit(E) * s)))
    lon = _lit(LON0) + F.degrees(theta / _lit(N))
    return lon, F.degrees(phi)


def albers_forward_np(lon: np.ndarray, lat: np.ndarray):
    phi = np.radians(lat)
    s = np.sin(phi)
    q = (1 - E2) * (s / (1 - E2 * s * s) - (1 / (2 * E)) * np.log((1 - E * s) / (1 + E * s)))
    rho = A * np.sqrt(C - N * q) / N
    theta = N * (np.radians(lon) - math.radians(LON0))
    return rho * np.sin(theta), RHO0 - rho * np.cos(theta)


def albers_inverse_np(x: np.ndarray, y: np.ndarray):
    dy = RHO0 - y
    rho = np.sqrt(x * x + dy * dy)
    theta = np.arctan2(x, dy)
    q = (C - rho * rho * N * N / (A * A)) / N
    beta = np.arcsin(q / QP)
    phi = beta + S2 * np.sin(2 * beta) + S4 * np.sin(4 * beta) + S6 * np.sin(6 * beta)
    s = np.sin(phi)
    w = 1 - E2 * s * s
    phi = phi + w * w / (2 * np.cos(phi)) * (
        q / (1 - E2) - s / w + (1 / (2 * E)) * np.log((1 - E * s) / (1 + E * s)))
    return LON0 + np.degrees(theta / N), np.degrees(phi)
