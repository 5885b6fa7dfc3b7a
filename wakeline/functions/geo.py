"""Distances, boxes and grid cells as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import refdata as ref


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere. The root is clamped so antipodes never leave asin's domain."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2.0)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.asin(F.least(F.lit(1.0), F.sqrt(chord))) * (2.0 * ref.EARTH_RADIUS_KM)


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2) / ref.KM_PER_NAUTICAL_MILE


def flat_km(dlat: Column, dlon: Column) -> Column:
    """Rough distance: the same length for a degree on both axes."""
    y = dlat * ref.FLAT_KM_PER_DEGREE
    x = dlon * ref.FLAT_KM_PER_DEGREE
    return F.sqrt(y * y + x * x)


def _sql_text(value: str | float) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value!r}D"


def _first_match(tests: list[str], values: list[str], otherwise: str) -> Column:
    """CASE over many boxes, handed over as one SQL text: one call instead of hundreds."""
    branches = " ".join(f"WHEN {test} THEN {value}" for test, value in zip(tests, values))
    return F.expr(f"CASE {branches} ELSE {otherwise} END")


def ocean_region(lat: str = "latitude", lon: str = "longitude") -> Column:
    tests = [
        f"({lat} BETWEEN {south!r}D AND {north!r}D AND {lon} BETWEEN {west!r}D AND {east!r}D)"
        for south, north, west, east, _ in ref.OCEAN_BOXES
    ]
    return _first_match(tests, [_sql_text(box[4]) for box in ref.OCEAN_BOXES], _sql_text(ref.OCEAN_FALLBACK))


def port_number(lat: str = "latitude", lon: str = "longitude") -> Column:
    """1-based position in the port table, null outside every box; a later entry wins an overlap."""
    numbered = list(enumerate(ref.PORT_BOXES, start=1))[::-1]
    tests = [
        f"(abs({lat} - {plat!r}D) <= {half!r}D AND abs({lon} - {plon!r}D) <= {half!r}D)"
        for _, (plat, plon, half, _, _) in numbered
    ]
    return _first_match(tests, [str(number) for number, _ in numbered], "CAST(NULL AS INT)")


def port_attribute(number: str, field: int) -> Column:
    """One field of the port table by port number (null in, null out)."""
    values = ", ".join(_sql_text(port[field]) for port in ref.PORT_BOXES)
    return F.expr(f"get(array({values}), {number} - 1)")


def grid_cell(value: Column, step: float) -> Column:
    """Nearest multiple of ``step``; adding 0.0 turns -0.0 into 0.0."""
    return F.round(value / step) * step + F.lit(0.0)


def tenth_degree(value: Column) -> Column:
    return F.round(value, 1) + F.lit(0.0)
