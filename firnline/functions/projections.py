"""Map projections as plain columns (WGS84 / GRS80 closed forms).

UTM uses the third-order transverse Mercator series, LAEA the ellipsoidal
azimuthal equal-area formulas of the European grid (10 E, 52 N).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: ellipsoid and grid constants
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
GRS80_FLATTENING = 1 / 298.257222101
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
LAEA_LON0 = 10.0
LAEA_LAT0 = 52.0
LAEA_FALSE_EASTING = 4321000.0
LAEA_FALSE_NORTHING = 3210000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)


def utm_zone(lon: Column) -> Column:
    return F.least(F.lit(60), F.floor((lon + F.lit(180.0)) / F.lit(6.0)) + F.lit(1))


# The formulas take the function set as a parameter: ``pyspark.sql.functions``
# for columns, ``numpy`` for whole arrays of pixels inside a task.
def _zone_offsets(m, epsg):
    """Central meridian in radians and false northing of 326zz / 327zz."""
    return m.radians((epsg % 100) * 6.0 - 183.0), (m.floor((epsg % 1000) / 100) - 6.0) * UTM_FALSE_NORTHING_SOUTH


def utm_forward(m, lon, lat, epsg):
    meridian, northing = _zone_offsets(m, epsg)
    s = m.sin(m.radians(lat))
    lam = m.radians(lon) - meridian
    c = 2 * math.sqrt(_N) / (1 + _N)
    t = m.sinh(m.atanh(s) - c * m.atanh(c * s))
    xi = m.atan2(t, m.cos(lam))
    eta = m.atanh(m.sin(lam) / m.sqrt(1.0 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        x = x + a * m.cos(2.0 * j * xi) * m.sinh(2.0 * j * eta)
        y = y + a * m.sin(2.0 * j * xi) * m.cosh(2.0 * j * eta)
    scale = UTM_SCALE * _RADIUS
    return UTM_FALSE_EASTING + scale * x, northing + scale * y


def utm_inverse(m, x, y, epsg):
    meridian, northing = _zone_offsets(m, epsg)
    scale = UTM_SCALE * _RADIUS
    xi = (y - northing) / scale
    eta = (x - UTM_FALSE_EASTING) / scale
    xi2, eta2 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi2 = xi2 - b * m.sin(2.0 * j * xi) * m.cosh(2.0 * j * eta)
        eta2 = eta2 - b * m.cos(2.0 * j * xi) * m.sinh(2.0 * j * eta)
    chi = m.asin(m.sin(xi2) / m.cosh(eta2))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * m.sin(2.0 * j * chi)
    return m.degrees(meridian + m.atan2(m.sinh(eta2), m.cos(xi2))), m.degrees(phi)


_E2 = GRS80_FLATTENING * (2 - GRS80_FLATTENING)
_E = math.sqrt(_E2)


def _authalic(m, s):
    return (1 - _E2) * (s / (1 - _E2 * s * s) - m.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_QP = _authalic(math, 1.0)
_RQ = SEMI_MAJOR * math.sqrt(_QP / 2)
_SIN0 = math.sin(math.radians(LAEA_LAT0))
_COS0 = math.cos(math.radians(LAEA_LAT0))
_BETA0 = math.asin(_authalic(math, _SIN0) / _QP)
_SB0, _CB0 = math.sin(_BETA0), math.cos(_BETA0)
_D = SEMI_MAJOR * _COS0 / math.sqrt(1 - _E2 * _SIN0**2) / (_RQ * _CB0)


def laea_forward(m, lon, lat):
    beta = m.asin(_authalic(m, m.sin(m.radians(lat))) / _QP)
    lam = m.radians(lon - LAEA_LON0)
    b = _RQ * m.sqrt(2.0 / (1.0 + _SB0 * m.sin(beta) + _CB0 * m.cos(beta) * m.cos(lam)))
    x = b * _D * m.cos(beta) * m.sin(lam)
    y = (b / _D) * (_CB0 * m.sin(beta) - _SB0 * m.cos(beta) * m.cos(lam))
    return LAEA_FALSE_EASTING + x, LAEA_FALSE_NORTHING + y


def laea_inverse(m, x, y):
    dx, dy = x - LAEA_FALSE_EASTING, y - LAEA_FALSE_NORTHING
    # the tiny term keeps the origin itself defined
    rho = m.sqrt(dx * dx / _D**2 + dy * dy * _D**2 + 1e-18)
    c = 2.0 * m.asin(rho / (2 * _RQ))
    beta = m.asin(m.cos(c) * _SB0 + _D * dy * m.sin(c) * _CB0 / rho)
    e2, e4, e6 = _E2, _E2**2, _E2**3
    phi = (
        beta
        + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * m.sin(2.0 * beta)
        + (23 * e4 / 360 + 251 * e6 / 3780) * m.sin(4.0 * beta)
        + (761 * e6 / 45360) * m.sin(6.0 * beta)
    )
    lam = m.atan2(dx * m.sin(c), _D * rho * _CB0 * m.cos(c) - _D**2 * dy * _SB0 * m.sin(c))
    return LAEA_LON0 + m.degrees(lam), m.degrees(phi)


def _pair(values: tuple[Column, Column], first: str, second: str) -> Column:
    return F.struct(values[0].alias(first), values[1].alias(second))


def lonlat_to_utm(lon: Column, lat: Column, epsg: Column) -> Column:
    """Struct x, y in the UTM zone of ``epsg`` (326zz north, 327zz south)."""
    return _pair(utm_forward(F, lon, lat, epsg), "x", "y")


def utm_to_lonlat(x: Column, y: Column, epsg: Column) -> Column:
    """Struct lon, lat in degrees."""
    return _pair(utm_inverse(F, x, y, epsg), "lon", "lat")


def lonlat_to_laea(lon: Column, lat: Column) -> Column:
    """Struct x, y on the European equal-area grid."""
    return _pair(laea_forward(F, lon, lat), "x", "y")


def laea_to_lonlat(x: Column, y: Column) -> Column:
    """Struct lon, lat in degrees."""
    return _pair(laea_inverse(F, x, y), "lon", "lat")


def densify(ring: Column, points_per_edge: int) -> Column:
    """Ring with ``points_per_edge`` points on every edge (start included)."""
    n = F.size(ring)
    edges = F.sequence(F.lit(0), n - F.lit(1))

    def along(i: Column) -> Column:
        a = F.get(ring, i)
        b = F.get(ring, (i + F.lit(1)) % n)
        return F.transform(
            F.sequence(F.lit(0), F.lit(points_per_edge - 1)),
            lambda k: F.struct(
                (a["x"] + (b["x"] - a["x"]) * k / F.lit(float(points_per_edge))).alias("x"),
                (a["y"] + (b["y"] - a["y"]) * k / F.lit(float(points_per_edge))).alias("y"),
            ),
        )

    return F.flatten(F.transform(edges, along))


def pixel_centre(row: Column, col: Column, ulx: Column, uly: Column, size: Column) -> Column:
    return F.struct(
        (ulx + (col + F.lit(0.5)) * size).alias("x"), (uly - (row + F.lit(0.5)) * size).alias("y")
    )


def pixel_index(x: Column, y: Column, ulx: Column, uly: Column, size: Column) -> Column:
    return F.struct(
        F.floor((uly - y) / size).cast("int").alias("row"),
        F.floor((x - ulx) / size).cast("int").alias("col"),
    )


def rescale_grid(ulx: Column, uly: Column, lrx: Column, lry: Column, size: Column) -> Column:
    """Rows and columns of a grid after changing its pixel size."""
    return F.struct(
        F.round((uly - lry) / size).cast("int").alias("nrows"),
        F.round((lrx - ulx) / size).cast("int").alias("ncols"),
    )
