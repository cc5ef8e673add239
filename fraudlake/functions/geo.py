"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points in degrees; NULL if any coordinate is NULL.

    Rounding can lift the haversine of near-antipodal points above 1, where asin is NaN, and
    Spark orders NaN above every threshold. ``least`` would clip that but also skips NULLs,
    so the clip is a CASE that lets NULL and NaN through.
    """
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    hav = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    clipped = F.when((hav > 1.0) & ~F.isnan(hav), 1.0).otherwise(hav)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clipped))
