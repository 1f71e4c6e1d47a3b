"""Geographic to UTM coordinates as column expressions: the transverse Mercator series in the third flattening."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of WGS 84 and UTM: half axis, flattening, scale, false easting.
AXIS, FLATTENING, SCALE, EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0


def to_utm(lon: Column, lat: Column, meridian: float) -> tuple[Column, Column]:
    """Easting and northing of degrees on the northern half, to about a millimetre within a zone."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    e = 2 * math.sqrt(n) / (1 + n)
    s, d = F.sin(F.radians(lat)), F.radians(lon - meridian)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(series, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EAST + SCALE * radius * x, SCALE * radius * y


def bounds_to_utm(west: Column, south: Column, east: Column, north: Column, meridian: float, between: int = 21) -> Column:
    """Box (xmin, ymin, xmax, ymax) around a box of degrees, whose sides have so many points between their ends."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(between + 1)), lambda i: i / (between + 1))
    at = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    sides = F.concat(
        F.transform(steps, lambda f: at(west + (east - west) * f, south)), F.transform(steps, lambda f: at(west + (east - west) * f, north)),
        F.transform(steps, lambda f: at(west, south + (north - south) * f)), F.transform(steps, lambda f: at(east, south + (north - south) * f)),
    )
    on = lambda axis: F.transform(sides, lambda p: to_utm(p["lon"], p["lat"], meridian)[axis])
    ends = (("xmin", F.array_min, 0), ("ymin", F.array_min, 1), ("xmax", F.array_max, 0), ("ymax", F.array_max, 1))
    return F.struct(*(f(on(axis)).alias(name) for name, f, axis in ends))
