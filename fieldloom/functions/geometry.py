"""Geometry as column expressions over arrays of points, so that Catalyst plans and compiles it.

A point list is ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>; a ring is a point list, a polygon an array of rings (the first
is the shell), a multipolygon an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres per pixel, pixels per tile side and metres per tile.
PIXEL, TILE_PX, TILE_M = 0.025, 2048, 51.2
#: Tile offsets of the grid in EPSG:32635.
GRID_EAST, GRID_NORTH = 12285, 101977
EARTH_RADIUS = 6371000.0
#: Half the width of the EPSG:3857 square.
MERCATOR_HALF = math.pi * 6378137.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _map(points: Column, x, y) -> Column:
    return F.transform(points, lambda p: F.struct(x(p).alias("x"), y(p).alias("y")))


def tile_left(col: Column) -> Column:
    return F.lit(TILE_M) * (F.lit(GRID_EAST) + col)


def tile_top(row: Column) -> Column:
    return F.lit(TILE_M) * (F.lit(GRID_NORTH) - row)


def pixel_to_world(points: Column, row: Column, col: Column, centre: bool = True) -> Column:
    """Pixel coordinates of tile (row, col) to metres; of pixel centres, or of their upper left corners."""
    half = 0.5 if centre else 0.0
    return _map(
        points,
        lambda p: tile_left(col) + F.lit(PIXEL) * (p["x"] + half),
        lambda p: tile_top(row) - F.lit(PIXEL) * (p["y"] + half),
    )


def affine_to_world(points: Column, a: Column, c: Column, e: Column, f: Column, centre: bool = True) -> Column:
    """The same for any north-up affine (a, c, e, f)."""
    half = 0.5 if centre else 0.0
    return _map(points, lambda p: c + a * (p["x"] + half), lambda p: f + e * (p["y"] + half))


def utm35_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:32635 to longitude and latitude in degrees."""
    return utm_to_lonlat(x, y, 35)


def utm_to_lonlat(x: Column, y: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """A UTM zone to longitude and latitude in degrees, by Krueger's series to fourth order."""
    for step in _utm_steps(zone, south):
        x, y = step(x, y)
    return x, y


def _utm_steps(zone: int, south: bool = False) -> list:
    """The steps of utm_to_lonlat; each uses its two columns many times."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    # The coefficients of Krueger's inverse series, and of conformal to geodetic latitude.
    beta = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    delta = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]

    def scaled(x: Column, y: Column) -> tuple[Column, Column]:
        return (x - F.lit(500000.0)) / F.lit(0.9996 * radius), (y - F.lit(10_000_000.0 if south else 0.0)) / F.lit(0.9996 * radius)

    def series(eta: Column, xi: Column) -> tuple[Column, Column]:
        xi0, eta0 = xi, eta
        for k, b in enumerate(beta, 1):
            xi0 = xi0 - F.lit(b) * F.sin(F.lit(2.0 * k) * xi) * F.cosh(F.lit(2.0 * k) * eta)
            eta0 = eta0 - F.lit(b) * F.cos(F.lit(2.0 * k) * xi) * F.sinh(F.lit(2.0 * k) * eta)
        return eta0, xi0

    def conformal(eta0: Column, xi0: Column) -> tuple[Column, Column]:
        return F.atan2(F.sinh(eta0), F.cos(xi0)), F.asin(F.sin(xi0) / F.cosh(eta0))

    def geodetic(lon: Column, chi: Column) -> tuple[Column, Column]:
        lat = chi
        for k, d in enumerate(delta, 1):
            lat = lat + F.lit(d) * F.sin(F.lit(2.0 * k) * chi)
        return F.lit(6.0 * zone - 183.0) + F.degrees(lon), F.degrees(lat)

    return [scaled, series, conformal, geodetic]


def transformer(source: int, target: int):
    """A function of two columns that takes places from one EPSG code to another: from any UTM zone, 4326 or 3857 to itself, and
    from a UTM zone or 4326 to 4326 or 3857."""
    zone = source % 100
    utm = source // 100 in (326, 327) and 1 <= zone <= 60
    if source == target and (utm or source in (4326, 3857)):
        return lambda x, y: (x, y)
    if not (utm or source == 4326) or target not in (4326, 3857):
        raise ValueError(f"no way from EPSG:{source} to EPSG:{target}")
    degrees = (lambda x, y: utm_to_lonlat(x, y, zone, source // 100 == 327)) if utm else (lambda x, y: (x, y))
    return degrees if target == 4326 else lambda x, y: lonlat_to_mercator(*degrees(x, y))


def points_to_lonlat(points: Column) -> Column:
    # A transform for each step, as within one, each use of a step would work it out again.
    for step in _utm_steps(35):
        points = F.transform(points, lambda p: point(*step(p["x"], p["y"])))
    return points


def close_ring(points: Column) -> Column:
    """Append the first point unless the ring is closed or empty."""
    return F.when((F.size(points) == 0) | (F.element_at(points, 1) == F.element_at(points, -1)), points).otherwise(F.concat(points, F.slice(points, 1, 1)))


def at_least(points: Column, n: int) -> Column:
    """The points if there are n or more, else null: 2 make a line, 3 a polygon."""
    return F.when(F.size(points) >= n, points)


def _pairs(points: Column, f) -> Column:
    """f of each two consecutive points."""
    n = F.size(points)
    return F.when(n >= 2, F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), f)).otherwise(F.array().cast("array<double>"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def distance(a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    return F.sqrt(dx * dx + dy * dy)


def polyline_length(points: Column) -> Column:
    return total(_pairs(points, distance))


def chord_length(points: Column) -> Column:
    return distance(F.element_at(points, 1), F.element_at(points, -1))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive if the ring turns counter-clockwise; open rings are closed in passing."""
    return total(_pairs(close_ring(ring), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])) / 2


def ring_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def polygon_area(rings: Column) -> Column:
    """The shell's area less the holes'."""
    return ring_area(F.element_at(rings, 1)) - total(F.transform(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), ring_area))


def vertex_mean(points: Column) -> Column:
    """Mean of the listed vertices; a closing vertex counts twice, as it is listed twice."""
    n = F.size(points)
    return F.struct(
        (total(F.transform(points, lambda p: p["x"])) / n).alias("x"),
        (total(F.transform(points, lambda p: p["y"])) / n).alias("y"),
    )


def middle_vertex(points: Column) -> Column:
    """The vertex at index floor(n / 2): a line's label point."""
    return F.get(points, F.floor(F.size(points) / 2).cast("int"))


def bbox(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def boxes_disjoint(a: Column, b: Column) -> Column:
    return (a["x1"] < b["x0"]) | (b["x1"] < a["x0"]) | (a["y1"] < b["y0"]) | (b["y1"] < a["y0"])


def undirected_angle(dx: Column, dy: Column) -> Column:
    """Direction in [0, pi)."""
    return F.pmod(F.atan2(dy, dx), F.lit(math.pi))


def angle_difference(a: Column, b: Column) -> Column:
    """Least angle between two undirected directions."""
    d = F.pmod(F.abs(a - b), F.lit(math.pi))
    return F.least(d, F.lit(math.pi) - d)


def along(x: Column, y: Column, angle: Column) -> Column:
    return x * F.cos(angle) + y * F.sin(angle)


def across(x: Column, y: Column, angle: Column) -> Column:
    return y * F.cos(angle) - x * F.sin(angle)


def clamp_points(points: Column, width: Column, height: Column) -> Column:
    """Each coordinate into the tile; not a geometric clip."""
    return _map(points, lambda p: F.least(F.greatest(p["x"], F.lit(0.0)), width), lambda p: F.least(F.greatest(p["y"], F.lit(0.0)), height))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres."""
    s = lambda d: F.pow(F.sin(F.radians(d) / 2), 2)
    h = s(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s(lon2 - lon1)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray cast."""
    crossed = _pairs(
        close_ring(ring),
        lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1.0).otherwise(0.0),
    )
    return total(crossed) % 2 == 1


def in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Inside the shell and in no hole."""
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return in_ring(x, y, F.element_at(rings, 1)) & ~F.exists(holes, lambda r: in_ring(x, y, r))


def in_multipolygon(x: Column, y: Column, polygons: Column) -> Column:
    return F.exists(polygons, lambda rings: in_polygon(x, y, rings))


def point_segment_distance(px, py, ax, ay, bx, by_) -> Column:
    dx, dy = bx - ax, by_ - ay
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / square))).otherwise(F.lit(0.0))
    qx, qy = ax + t * dx - px, ay + t * dy - py
    return F.sqrt(qx * qx + qy * qy)


def _turn(ax, ay, bx, by_, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)


def segments_cross(a: dict, b: dict) -> Column:
    """Whether two segments cross properly; each is a dict of ax, ay, bx, by_."""
    d1 = _turn(b["ax"], b["ay"], b["bx"], b["by_"], a["ax"], a["ay"])
    d2 = _turn(b["ax"], b["ay"], b["bx"], b["by_"], a["bx"], a["by_"])
    d3 = _turn(a["ax"], a["ay"], a["bx"], a["by_"], b["ax"], b["ay"])
    d4 = _turn(a["ax"], a["ay"], a["bx"], a["by_"], b["bx"], b["by_"])
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def segment_distance(a: dict, b: dict) -> Column:
    """Least distance between two segments, 0 where they cross."""
    ends = F.least(
        point_segment_distance(a["ax"], a["ay"], b["ax"], b["ay"], b["bx"], b["by_"]),
        point_segment_distance(a["bx"], a["by_"], b["ax"], b["ay"], b["bx"], b["by_"]),
        point_segment_distance(b["ax"], b["ay"], a["ax"], a["ay"], a["bx"], a["by_"]),
        point_segment_distance(b["bx"], b["by_"], a["ax"], a["ay"], a["bx"], a["by_"]),
    )
    return F.when(segments_cross(a, b), F.lit(0.0)).otherwise(ends)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box as a closed ring."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def strip_ring(a: Column, b: Column) -> Column:
    """The strip between two lines: one there, the other back."""
    return at_least(F.concat(a, F.reverse(b)), 3)


def inset_quad(t0, t1, s0, s1, angle, inset: float) -> Column:
    """The quad between two parallel rows at offsets s0 < s1, drawn in from both, from t0 to t1 along them."""
    x = lambda t, s: t * F.cos(angle) - s * F.sin(angle)
    y = lambda t, s: t * F.sin(angle) + s * F.cos(angle)
    low, high = s0 + inset, s1 - inset
    return F.array(*[point(x(t, s), y(t, s)) for t, s in ((t0, low), (t1, low), (t1, high), (t0, high))])


def slippy_span(z: Column) -> Column:
    return F.lit(2 * MERCATOR_HALF) / F.pow(F.lit(2.0), z)


def slippy_bounds(z: Column, x: Column, y: Column) -> Column:
    """EPSG:3857 bounds of a map tile."""
    span = slippy_span(z)
    left, top = x * span - MERCATOR_HALF, F.lit(MERCATOR_HALF) - y * span
    return F.struct(left.alias("x0"), (top - span).alias("y0"), (left + span).alias("x1"), top.alias("y1"))


def slippy_range(z: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Indices of the map tiles that a bounding box meets."""
    span = slippy_span(z)
    return F.struct(
        F.floor((x0 + MERCATOR_HALF) / span).alias("tx0"),
        F.floor((x1 + MERCATOR_HALF) / span).alias("tx1"),
        F.floor((F.lit(MERCATOR_HALF) - y1) / span).alias("ty0"),
        F.floor((F.lit(MERCATOR_HALF) - y0) / span).alias("ty1"),
    )


def lonlat_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * 6378137.0, F.lit(6378137.0) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
