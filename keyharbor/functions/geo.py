"""Geography as Column expressions: distances, radius, polygon, geohash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres of the sphere's radius.
RADIUS_M = 6372797.560856
#: Metres of a unit (fixed values).
UNITS = {"m": 1.0, "meters": 1.0, "km": 1000.0, "kilometers": 1000.0, "mi": 1609.34, "miles": 1609.34, "ft": 0.3048, "feet": 0.3048}
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def unit_metres(unit: str) -> float:
    if unit.lower() not in UNITS:
        raise ValueError(f"unknown unit {unit!r}: one of {', '.join(UNITS)}")
    return UNITS[unit.lower()]


def distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column, unit: str = "km") -> Column:
    """Great-circle distance by the haversine formula."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a))) / unit_metres(unit)


def near_box(lon: Column, lat: Column, at_lon: float, at_lat: float, radius: float, unit: str) -> Column:
    """A cheap necessary condition of being within the radius: a range of latitude, which Parquet statistics can skip by."""
    degrees = radius * unit_metres(unit) / RADIUS_M * 57.29577951308232 + 1e-9
    return lat.between(at_lat - degrees, at_lat + degrees)


def within_radius(lon: Column, lat: Column, at_lon: float, at_lat: float, radius: float, unit: str = "km") -> Column:
    return near_box(lon, lat, at_lon, at_lat, radius, unit) & (distance(lon, lat, F.lit(float(at_lon)), F.lit(float(at_lat)), unit) <= radius)


def within_polygon(lon: Column, lat: Column, points: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the polygon's edges above a point; a bounding box comes first. Of the outline, lower edges and left ends belong to the polygon, upper edges and right ends don't."""
    if len(points) < 3:
        raise ValueError("a polygon has three points at least")
    ring = points if points[0] != points[-1] else points[:-1]
    crossings = F.lit(0)
    for a, b in zip(ring, [*ring[1:], ring[0]], strict=True):
        (x1, y1), (x2, y2) = sorted((a, b))  # from its left end, whichever way the ring goes
        if x1 == x2:
            continue
        spans = (lon >= F.lit(float(x1))) & (lon < F.lit(float(x2)))
        crossings = crossings + F.when(spans & (lat - float(y1) < (lon - float(x1)) * float(y2 - y1) / float(x2 - x1)), 1).otherwise(0)
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return lon.between(float(min(xs)), float(max(xs))) & lat.between(float(min(ys)), float(max(ys))) & (crossings % 2 == 1)


def geohash(lon: Column, lat: Column, length: int = 11) -> Column:
    """The standard geohash of up to 12 characters, by interleaving the bits of the two cell numbers."""
    bits = length * 5
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    cell = lambda x, low, high, n: F.least(F.floor((x - low) / (high - low) * float(1 << n)).cast("long"), F.lit((1 << n) - 1).cast("long"))
    x, y = cell(lon, -180.0, 180.0, lon_bits), cell(lat, -90.0, 90.0, lat_bits)
    letters = []
    for k in range(length):
        value = F.lit(0).cast("long")
        for b in range(5 * k, 5 * k + 5):
            source, at = (x, lon_bits - 1 - b // 2) if b % 2 == 0 else (y, lat_bits - 1 - b // 2)
            value = value * 2 + F.shiftright(source, at).bitwiseAND(F.lit(1).cast("long"))
        letters.append(F.substring(F.lit(BASE32), value.cast("int") + 1, F.lit(1)))
    return F.when(lon.between(-180, 180) & lat.between(-90, 90), F.concat(*letters))
