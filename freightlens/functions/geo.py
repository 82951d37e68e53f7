"""Points on a sphere as (longitude, latitude) doubles in degrees (F-26 … F-28, A-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_010.0


def great_circle_metres(lng_a: str, lat_a: str, lng_b: str, lat_b: str) -> Column:
    """Haversine distance in metres; null where a coordinate is."""
    rise = f"sin(radians({lat_b} - {lat_a}) / 2)"
    turn = f"sin(radians({lng_b} - {lng_a}) / 2)"
    h = f"{rise} * {rise} + cos(radians({lat_a})) * cos(radians({lat_b})) * {turn} * {turn}"
    # Rounding may lift h a hair above 1 for antipodes; least() would skip a null.
    return F.expr(f"{2 * EARTH_RADIUS_M}D * asin(sqrt(CASE WHEN {h} > 1 THEN 1D ELSE {h} END))")


def unit_vector(lng: str, lat: str) -> list[str]:
    """Cartesian x, y, z of a point on the unit sphere, as SQL."""
    phi, lam = f"radians({lat})", f"radians({lng})"
    return [f"cos({phi}) * cos({lam})", f"cos({phi}) * sin({lam})", f"sin({phi})"]


def direction_lng(x: str, y: str) -> Column:
    """Longitude of the direction of a vector of any length."""
    return F.expr(f"degrees(atan2({y}, {x}))")


def direction_lat(x: str, y: str, z: str) -> Column:
    return F.expr(f"degrees(atan2({z}, sqrt({x} * {x} + {y} * {y})))")
