"""Distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: mean radius of the earth in metres.
EARTH_M = 6_371_000.0


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))
