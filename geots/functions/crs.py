"""UTM projection of WGS84 coordinates as Column expressions (Krüger series of sixth order).

The series is Krüger's, with the coefficients that Karney (2011) gives in the third flattening n.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid and the UTM grid.
A, FLATTENING, K0, EASTING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
RADIUS = K0 * A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)


def _series(*rows: tuple[float, ...]) -> list[float]:
    """Row j (from 1) holds the factors of n**j, n**(j+1), ..."""
    return [sum(c * N ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]


# Coefficients of the series, to the sixth power of n.
FORWARD = _series(
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
BACKWARD = _series(
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
LATITUDE = _series(
    (2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    (7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    (56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    (4279 / 630, -332 / 35, -399572 / 14175),
    (4174 / 315, -144838 / 6237),
    (601676 / 22275,),
)


def central_meridian(epsg: Column | int) -> Column:
    """Degrees; EPSG 326zz and 327zz name the northern and southern UTM zone zz."""
    code = F.lit(epsg) if isinstance(epsg, int) else epsg
    return (F.pmod(code, F.lit(100)) * 6 - 183).cast("double")


def _northing(epsg: Column | int) -> Column:
    code = F.lit(epsg) if isinstance(epsg, int) else epsg
    return F.when(code >= 32700, F.lit(10_000_000.0)).otherwise(F.lit(0.0))


def _sum(terms) -> Column:
    return functools.reduce(operator.add, terms)


def to_utm(lon: Column, lat: Column, epsg: Column | int) -> tuple[Column, Column]:
    """(x, y) in metres of a longitude and latitude in degrees."""
    phi, lam = F.radians(lat), F.radians(lon - central_meridian(epsg))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - ECCENTRICITY * F.atanh(ECCENTRICITY * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x = eta + _sum(c * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, c in enumerate(FORWARD, 1))
    y = xi + _sum(c * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, c in enumerate(FORWARD, 1))
    return EASTING + RADIUS * x, _northing(epsg) + RADIUS * y


def to_lonlat(x: Column, y: Column, epsg: Column | int) -> tuple[Column, Column]:
    """(lon, lat) in degrees of UTM metres."""
    xi0, eta0 = (y - _northing(epsg)) / RADIUS, (x - EASTING) / RADIUS
    xi = xi0 - _sum(c * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0) for j, c in enumerate(BACKWARD, 1))
    eta = eta0 - _sum(c * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0) for j, c in enumerate(BACKWARD, 1))
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi + _sum(c * F.sin(2 * j * chi) for j, c in enumerate(LATITUDE, 1))
    return central_meridian(epsg) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def reprojected(parts: Column, epsg: Column | int, forward: bool = True) -> Column:
    """Polygon parts with every vertex projected."""
    project = to_utm if forward else to_lonlat

    def vertex(v: Column) -> Column:
        x, y = project(v["x"], v["y"], epsg)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(parts, lambda rings: F.transform(rings, lambda ring: F.transform(ring, vertex)))


def zone_of(mean_lon: Column, boundary: float = 102.0) -> Column:
    """EPSG of the zone for a mean longitude: 48 north from ``boundary`` on, else 47 north."""
    return F.when(mean_lon >= boundary, F.lit(32648)).otherwise(F.lit(32647))
