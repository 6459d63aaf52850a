"""Coordinates and distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def valid_coordinates(latitude: Column, longitude: Column) -> Column:
    """True where both lie on the globe; a missing one is not valid."""
    inside = latitude.between(-90.0, 90.0) & longitude.between(-180.0, 180.0)
    return F.coalesce(inside, F.lit(False))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of the mean earth radius."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2.0))
    # Antipodal points can push the sum a hair above 1.
    chord = F.least(chord, F.lit(1.0))
    return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)
