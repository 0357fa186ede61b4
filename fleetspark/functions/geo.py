"""Geography as column expressions (L1, L4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetspark.constants import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km (R = 6371 km)."""
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def interpolate(a: Column, b: Column, fraction: Column) -> Column:
    """Linear interpolation: fraction 0 -> a, 1 -> b."""
    return a + (b - a) * fraction
