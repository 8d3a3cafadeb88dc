"""Great-circle distance and the cheap box that bounds it, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEG_LAT = math.pi * EARTH_RADIUS_KM / 180.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in km between two points given in degrees."""
    lat1, lng1, lat2, lng2 = _c(lat1), _c(lng1), _c(lat2), _c(lng2)
    a = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def bounding_box(lat: float, lng: float, radius_km: float) -> tuple[float, float, float, float]:
    """(lat_min, lat_max, lng_min, lng_max) that contains every point within radius_km.

    Used as plain range predicates ahead of the haversine filter so Parquet can
    skip row groups by min/max statistics.  Near the poles the box widens to
    the full longitude range.
    """
    dlat = radius_km / KM_PER_DEG_LAT
    lat_min, lat_max = lat - dlat, lat + dlat
    if lat_min <= -90 or lat_max >= 90:
        return max(lat_min, -90.0), min(lat_max, 90.0), -180.0, 180.0
    coslat = min(math.cos(math.radians(lat_min)), math.cos(math.radians(lat_max)))
    dlng = radius_km / (KM_PER_DEG_LAT * max(coslat, 1e-9))
    if dlng >= 180:
        return lat_min, lat_max, -180.0, 180.0
    return lat_min, lat_max, lng - dlng, lng + dlng


def box_predicate(lat_col: str, lng_col: str, lat: float, lng: float, radius_km: float) -> Column:
    lat_min, lat_max, lng_min, lng_max = bounding_box(lat, lng, radius_km)
    pred = F.col(lat_col).between(lat_min, lat_max)
    if lng_min > -180 or lng_max < 180:
        if lng_min < -180:
            pred = pred & ((F.col(lng_col) >= lng_min + 360) | (F.col(lng_col) <= lng_max))
        elif lng_max > 180:
            pred = pred & ((F.col(lng_col) >= lng_min) | (F.col(lng_col) <= lng_max - 360))
        else:
            pred = pred & F.col(lng_col).between(lng_min, lng_max)
    return pred


def grid_cell_deg(radius_km: float, max_abs_lat: float = 80.0) -> tuple[float, float]:
    """Cell size (dlat, dlng) in degrees so any pair within radius_km is in
    the same or an adjacent cell, valid up to max_abs_lat."""
    dlat = radius_km / KM_PER_DEG_LAT
    dlng = radius_km / (KM_PER_DEG_LAT * math.cos(math.radians(max_abs_lat)))
    return dlat, dlng
