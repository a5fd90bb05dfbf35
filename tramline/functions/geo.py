"""Distances, boxes and coordinate repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000
METRES_PER_DEGREE = 111_320

# The box survey answers must fall in to be linked to a location.
BOX = {"lat": (49.4, 51.6), "lon": (2.5, 6.5)}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord))


def in_box(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(*BOX["lat"]) & lon.between(*BOX["lon"]), F.lit(False))


def repair_latitude(value: Column) -> Column:
    """Latitudes that lost their decimal point: 5 digits are thousandths, 6 are ten-thousandths.

    Digits are counted without the point and one trailing zero.
    """
    digits = F.length(F.regexp_replace(F.replace(value.cast("string"), F.lit("."), F.lit("")), "0$", ""))
    number = value.cast("double")
    return F.when(digits == 5, number / 1000).when(digits == 6, number / 10000).otherwise(number)
