"""Points, lines and lengths as plain columns.

A line is ``array<struct<m, lon, lat>>`` sorted by ``m``, the distance along
the run. Array functions below are for lines of a known, bounded size;
``operators.lines`` works on vertex tables of any size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis in metres and first eccentricity squared.
WGS84_A = 6378137.0
WGS84_E2 = 0.0066943799901413165


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def planar_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dx, dy = lon2 - lon1, lat2 - lat1
    return F.sqrt(dx * dx + dy * dy)


def geodesic_segment(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between two near points, by the radii at their middle latitude."""
    mid = F.radians((lat1 + lat2) / 2)
    w = F.lit(1.0) - F.lit(WGS84_E2) * F.sin(mid) * F.sin(mid)
    meridian = F.lit(WGS84_A * (1 - WGS84_E2)) / (w * F.sqrt(w))
    transverse = F.lit(WGS84_A) / F.sqrt(w)
    north = meridian * F.radians(lat2 - lat1)
    east = transverse * F.cos(mid) * F.radians(lon2 - lon1)
    return F.sqrt(north * north + east * east)


def make_line(m: Column, lon: Column, lat: Column) -> Column:
    """Aggregate: vertices of a bounded group in order of ``m``."""
    vertex = F.struct(m.alias("m"), lon.alias("lon"), lat.alias("lat"))
    return F.array_sort(F.collect_list(vertex))


def _segments(line: Column, length) -> Column:
    """array<struct<a, b, len>>, one per pair of neighbours."""
    ends = F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))
    starts = F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a.alias("a"), b.alias("b"), length(a.lon, a.lat, b.lon, b.lat).alias("len")
        ),
    )


def _total(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + s.len)


def geodesic_length(line: Column) -> Column:
    """Length of a line in metres on the ellipsoid."""
    return _total(_segments(line, geodesic_segment))


def interpolate_line(line: Column, fraction: Column) -> Column:
    """Point at ``fraction`` of the planar length, NULL outside 0..1."""
    segments = _segments(line, planar_distance)
    target = fraction * _total(segments)
    first = F.element_at(line, 1)
    start = F.struct(
        F.lit(0.0).alias("run"), first.lon.alias("lon"), first.lat.alias("lat")
    )

    def step(acc: Column, s: Column) -> Column:
        share = F.when(s.len > 0, F.least((target - acc.run) / s.len, F.lit(1.0)))
        moves = (s.len > 0) & (target > acc.run)
        return F.struct(
            (acc.run + s.len).alias("run"),
            F.when(moves, s.a.lon + share * (s.b.lon - s.a.lon)).otherwise(acc.lon).alias("lon"),
            F.when(moves, s.a.lat + share * (s.b.lat - s.a.lat)).otherwise(acc.lat).alias("lat"),
        )

    return F.when(
        fraction.between(0, 1) & (F.size(line) > 0),
        F.aggregate(segments, start, step, lambda acc: point(acc.lon, acc.lat)),
    )


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def line_wkt(line: Column) -> Column:
    vertices = F.transform(
        line, lambda v: F.concat(v.lon.cast("string"), F.lit(" "), v.lat.cast("string"))
    )
    return F.concat(F.lit("LINESTRING("), F.array_join(vertices, ","), F.lit(")"))
