"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6_371_000


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along the great circle."""
    a = F.pow(F.sin(F.radians(lat1 - lat2) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon1 - lon2) / 2), 2)
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(a))
