"""Map projections as closed-form expressions.

NAD83 and WGS84 are treated as the same datum (they differ by a metre or two).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G

# Sphere radius of Web Mercator, metres.
MERCATOR_RADIUS = 6378137.0

# EPSG:2272 (Pennsylvania South, US survey feet) on GRS80.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
PHI_1 = math.radians(40 + 58 / 60)
PHI_2 = math.radians(39 + 56 / 60)
PHI_0 = math.radians(39 + 20 / 60)
LAMBDA_0 = math.radians(-77.75)
FALSE_EASTING_M = 600000.0
US_FOOT_M = 1200.0 / 3937.0

_E2 = (2 - 1 / GRS80_INV_F) / GRS80_INV_F
_E = math.sqrt(_E2)


def mercator_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    lon = F.degrees(x / F.lit(MERCATOR_RADIUS))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(MERCATOR_RADIUS))) - F.lit(math.pi / 2))
    return lon, lat


def lonlat_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    x = F.radians(lon) * F.lit(MERCATOR_RADIUS)
    y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0))) * F.lit(MERCATOR_RADIUS)
    return x, y


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)


def _t(phi: float) -> float:
    s = _E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


# The cone constants follow from the parameters above.
CONE_N = (math.log(_m(PHI_1)) - math.log(_m(PHI_2))) / (math.log(_t(PHI_1)) - math.log(_t(PHI_2)))
CONE_F = _m(PHI_1) / (CONE_N * _t(PHI_1) ** CONE_N)
CONE_RHO_0 = GRS80_A * CONE_F * _t(PHI_0) ** CONE_N


def lonlat_to_state_plane(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Lambert conformal conic with two standard parallels, in US survey feet."""
    phi = F.radians(lat)
    s = F.sin(phi) * F.lit(_E)
    t = F.tan(F.lit(math.pi / 4) - phi / F.lit(2.0)) / F.pow((F.lit(1.0) - s) / (F.lit(1.0) + s), F.lit(_E / 2))
    rho = F.lit(GRS80_A * CONE_F) * F.pow(t, F.lit(CONE_N))
    theta = F.lit(CONE_N) * (F.radians(lon) - F.lit(LAMBDA_0))
    x = (F.lit(FALSE_EASTING_M) + rho * F.sin(theta)) / F.lit(US_FOOT_M)
    y = (F.lit(CONE_RHO_0) - rho * F.cos(theta)) / F.lit(US_FOOT_M)
    return x, y


def measured_area(lonlat_parts: Column) -> Column:
    """Square US survey feet of a geometry given in degrees."""
    return G.area(G.map_points(lonlat_parts, lonlat_to_state_plane))


def measured_length(lonlat_parts: Column) -> Column:
    return G.length(G.map_points(lonlat_parts, lonlat_to_state_plane))
