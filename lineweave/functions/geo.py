"""Great-circle distance in whole metres, as a column expression (no UDF).

The operation order is kept fixed so that the integer result is bit-stable: radians as
``d * pi / 180``; haversine on a sphere of radius 6378.137 km; round half up to 4 decimals of
a kilometre; times 1000; truncated to an integer metre *per segment* before any summing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radius in km and rounding step (1e-4 km) of the distance.
EARTH_RADIUS_KM = 6378.137
ROUND_SCALE = 10000.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def radians(d: Column | str) -> Column:
    return _col(d) * F.lit(math.pi) / F.lit(180.0)


def _hav(from_deg, to_deg) -> Column:
    """Haversine of the angle between two bearings given in degrees: sin squared of its half."""
    return F.pow(F.sin((radians(from_deg) - radians(to_deg)) / F.lit(2.0)), F.lit(2.0))


def _round_half_up(km: Column) -> Column:
    return F.floor(km * F.lit(ROUND_SCALE) + F.lit(0.5)) / F.lit(ROUND_SCALE)


def distance_km(lng1, lat1, lng2, lat2) -> Column:
    shrink = F.cos(radians(lat1)) * F.cos(radians(lat2))
    central_angle = F.lit(2.0) * F.asin(F.sqrt(_hav(lat1, lat2) + shrink * _hav(lng1, lng2)))
    return _round_half_up(central_angle * F.lit(EARTH_RADIUS_KM))


def distance_m(lng1, lat1, lng2, lat2) -> Column:
    """Segment length in whole metres (int); null if any coordinate is null."""
    return (distance_km(lng1, lat1, lng2, lat2) * F.lit(1000.0)).cast("int")


def point(lng: Column | str, lat: Column | str) -> Column:
    """struct(lng, lat), null unless both coordinates are present."""
    lng, lat = _col(lng), _col(lat)
    return F.when(lng.isNotNull() & lat.isNotNull(), F.struct(lng.alias("lng"), lat.alias("lat")))


def point_distance_m(p: Column, q: Column) -> Column:
    return distance_m(p["lng"], p["lat"], q["lng"], q["lat"])
