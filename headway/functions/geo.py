"""Geometry on plain columns: points are doubles, lines and rings arrays of (lon, lat)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius in metres, feet per metre.
EARTH_RADIUS_M = 6_371_008.8
FT_PER_M = 1 / 0.3048


def haversine_ft(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_M * FT_PER_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def in_bounds(lat: Column, lon: Column, bounds) -> Column:
    """Both ends inclusive; null coordinates are outside."""
    return F.coalesce(lat.between(bounds.min_lat, bounds.max_lat) & lon.between(bounds.min_lon, bounds.max_lon), F.lit(False))


def project_on_line(lon: Column, lat: Column, line: Column) -> Column:
    """Fraction (0 to 1) of the planar length of a line at its point nearest to (lon, lat); null under two points.

    Linear in the number of segments: one pass finds each segment's distance and running length.
    """
    segment = F.zip_with(F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    zero = F.lit(0.0)
    start = F.struct(zero.alias("run"), F.lit(float("inf")).alias("best"), zero.alias("at"))

    def step(acc: Column, s: Column) -> Column:
        dx, dy = s["b"]["lon"] - s["a"]["lon"], s["b"]["lat"] - s["a"]["lat"]
        square = dx * dx + dy * dy
        t = F.when(square > 0, F.greatest(zero, F.least(F.lit(1.0), ((lon - s["a"]["lon"]) * dx + (lat - s["a"]["lat"]) * dy) / square))).otherwise(zero)
        ex, ey = s["a"]["lon"] + t * dx - lon, s["a"]["lat"] + t * dy - lat
        distance, length = ex * ex + ey * ey, F.sqrt(square)
        better = distance < acc["best"]
        return F.struct(
            (acc["run"] + length).alias("run"), F.when(better, distance).otherwise(acc["best"]).alias("best"),
            F.when(better, acc["run"] + t * length).otherwise(acc["at"]).alias("at"),
        )

    return F.when(F.size(line) >= 2, F.aggregate(segment, start, step, lambda acc: F.when(acc["run"] > 0, acc["at"] / acc["run"])))


def ring_covers(lon: Column, lat: Column, ring: Column) -> Column:
    """Ray casting over one closed ring; its boundary is inside."""
    edges = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"])

    def touches(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["lon"] - a["lon"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lon - a["lon"])
        return (cross == 0) & lon.between(F.least(a["lon"], b["lon"]), F.greatest(a["lon"], b["lon"])) & lat.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"]))

    return F.exists(edges, touches) | (F.size(F.filter(edges, crosses)) % 2 == 1)


def polygon_covers(lon: Column, lat: Column, polygons: Column) -> Column:
    """polygons: array of array of rings; in a polygon the first ring is the outside, others are holes (their edge counts as inside)."""

    def one(rings: Column) -> Column:
        hole = F.exists(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: ring_covers(lon, lat, r) & ~_on_edge(lon, lat, r))
        return ring_covers(lon, lat, rings[0]) & ~hole

    return F.exists(polygons, one)


def _on_edge(lon: Column, lat: Column, ring: Column) -> Column:
    edges = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    cross = lambda a, b: (b["lon"] - a["lon"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lon - a["lon"])
    between = lambda a, b: lon.between(F.least(a["lon"], b["lon"]), F.greatest(a["lon"], b["lon"])) & lat.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"]))
    return F.exists(edges, lambda e: (cross(e["a"], e["b"]) == 0) & between(e["a"], e["b"]))


def grid_cell(lon: Column, lat: Column, size: float = 0.01) -> Column:
    return F.struct(F.floor(lon / size).alias("x"), F.floor(lat / size).alias("y"))
