"""Distance on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col

EARTH_RADIUS_KM = 6371


def point_parts(c: str | Column) -> tuple[Column, Column]:
    """(latitude, longitude) of text such as "(-6.9, 107.6)"; null where it does not parse."""
    number = r"(-?[0-9]+(?:\.[0-9]+)?)"
    pattern = rf"\(\s*{number}\s*,\s*{number}\s*\)"
    return tuple(F.regexp_extract(col(c), pattern, g).try_cast("double") for g in (1, 2))


def haversine_km(
    lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column, legacy: bool = False
) -> Column:
    """Great-circle distance in kilometres.

    `legacy=True` gives the figures of the older reports, which read the pair as
    (longitude, latitude) and multiplied the two haversine terms.
    """
    a_lat, a_lon, b_lat, b_lon = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    if legacy:
        a_lat, a_lon, b_lat, b_lon = a_lon, a_lat, b_lon, b_lat
    half_lat = F.pow(F.sin((b_lat - a_lat) / 2), F.lit(2))
    half_lon = F.pow(F.sin((b_lon - a_lon) / 2), F.lit(2))
    scale = F.cos(a_lat) * F.cos(b_lat)
    chord = half_lat * scale * half_lon if legacy else half_lat + scale * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
