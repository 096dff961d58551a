"""Queries of the scalar geometry and name functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.functions import text

from . import fixtures as fx
from .catalogue import query


def rounded(digits: int = 6, **columns):
    return [F.round(c, digits).alias(n) for n, c in columns.items()]


def ends(ax="ax", ay="ay", bx="bx", by_="by_"):
    return F.array(g.point(F.col(ax), F.col(ay)), g.point(F.col(bx), F.col(by_)))


@query(
    "q01_pixel_to_world",
    fx.with_fixtures(
        """SELECT id, round(51.2 * (12285 + c)::DOUBLE + 0.025 * (x0 + 0.5), 6) AS centre_x, round(51.2 * (101977 - r)::DOUBLE - 0.025 * (y0 + 0.5), 6) AS centre_y,
        round(51.2 * (12285 + c)::DOUBLE + 0.025 * x1, 6) AS corner_x, round(51.2 * (101977 - r)::DOUBLE - 0.025 * y1, 6) AS corner_y FROM seg"""
    ),
)
def pixel_to_world(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).withColumn("p", ends("x0", "y0", "x1", "y1"))
    centre, corner = (g.pixel_to_world(F.col("p"), F.col("r"), F.col("c"), centre=half) for half in (True, False))
    return seg.select("id", *rounded(centre_x=centre[0]["x"], centre_y=centre[0]["y"], corner_x=corner[1]["x"], corner_y=corner[1]["y"]))


def lonlat_sql(x: str, y: str) -> tuple[str, str]:
    """The inverse transverse Mercator series as DuckDB text."""
    n = (1 / 298.257223563) / (2 - 1 / 298.257223563)
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    b = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    d = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    xi, eta = f"(({y}) / {radius!r}::DOUBLE)", f"((({x}) - 500000) / {radius!r}::DOUBLE)"
    xi0 = f"({xi}" + "".join(f" - {c:.25f}::DOUBLE * sin({2 * k} * {xi}) * cosh({2 * k} * {eta})" for k, c in enumerate(b, 1)) + ")"
    eta0 = f"({eta}" + "".join(f" - {c:.25f}::DOUBLE * cos({2 * k} * {xi}) * sinh({2 * k} * {eta})" for k, c in enumerate(b, 1)) + ")"
    chi = f"asin(sin({xi0}) / cosh({eta0}))"
    lat = f"degrees({chi}" + "".join(f" + {c:.25f}::DOUBLE * sin({2 * k} * {chi})" for k, c in enumerate(d, 1)) + ")"
    return f"(27 + degrees(atan2(sinh({eta0}), cos({xi0}))))", lat


@query(
    "q02_utm_to_lonlat",
    fx.with_fixtures(f"SELECT id, round({lonlat_sql('ax', 'ay')[0]}, 8) AS lon, round({lonlat_sql('ax', 'ay')[1]}, 8) AS lat, 3 AS ring_size FROM wseg"),
)
def utm_to_lonlat(spark, sf_dir):
    wseg = fx.frame(spark, sf_dir, fx.WSEG).withColumn("ring", g.close_ring(g.points_to_lonlat(ends())))
    return wseg.select("id", *rounded(8, lon=F.col("ring")[0]["x"], lat=F.col("ring")[0]["y"]), F.size("ring").alias("ring_size"))


@query(
    "q03_lengths",
    fx.with_fixtures(
        """SELECT id, round(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) + sqrt((bx + 3 - bx) ** 2 + 16), 6) AS path, round(sqrt((bx + 3 - ax) ** 2 + (by_ + 4 - ay) ** 2), 6) AS chord,
        sqrt((bx + 3 - ax) ** 2 + (by_ + 4 - ay) ** 2) / (sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) + 5) >= 0.9 AS straight FROM wseg"""
    ),
)
def lengths(spark, sf_dir):
    bent = F.concat(ends(), F.array(g.point(F.col("bx") + 3, F.col("by_") + 4)))
    wseg = fx.frame(spark, sf_dir, fx.WSEG).withColumn("line", g.at_least(bent, 2))
    path, chord = g.polyline_length(F.col("line")), g.chord_length(F.col("line"))
    return wseg.select("id", *rounded(path=path, chord=chord), (chord / path >= 0.9).alias("straight"))


@query(
    "q04_area_centroid_bbox",
    fx.with_fixtures(
        """SELECT id, round((x1 - x0) * (y1 - y0), 4) AS area, round((2 * x0 + 2 * x1 + x0) / 5, 6) AS mean_x, round((2 * y0 + 2 * y1 + y0) / 5, 6) AS mean_y,
        x0 AS low_x, y1 AS high_y, x1 AS middle_x, y1 AS middle_y FROM box"""
    ),
)
def area_centroid_bbox(spark, sf_dir):
    ring = F.col("ring")
    box = fx.frame(spark, sf_dir, fx.BOX).withColumn("ring", g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    middle = g.middle_vertex(ring)
    return box.select(
        "id",
        F.round(g.ring_area(ring), 4).alias("area"),
        *rounded(mean_x=g.vertex_mean(ring)["x"], mean_y=g.vertex_mean(ring)["y"]),
        g.bbox(ring)["x0"].alias("low_x"),
        g.bbox(ring)["y1"].alias("high_y"),
        middle["x"].alias("middle_x"),
        middle["y"].alias("middle_y"),
    )


_ANGLE = "(atan2(by_ - ay, bx - ax) + CASE WHEN atan2(by_ - ay, bx - ax) < 0 THEN pi() ELSE 0 END)"


@query(
    "q05_undirected_angles",
    fx.with_fixtures(
        f"""SELECT id, round({_ANGLE}, 6) AS angle, round(least(abs({_ANGLE} - 3.1), pi() - abs({_ANGLE} - 3.1)), 6) AS off,
        degrees(least(abs({_ANGLE} - 3.1), pi() - abs({_ANGLE} - 3.1))) <= 3 AS near FROM wseg"""
    ),
)
def undirected_angles(spark, sf_dir):
    angle = g.undirected_angle(F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay"))
    off = g.angle_difference(angle, F.lit(3.1))
    return fx.frame(spark, sf_dir, fx.WSEG).select("id", *rounded(angle=angle, off=off), (F.degrees(off) <= 3).alias("near"))


@query(
    "q06_along_across",
    fx.with_fixtures("SELECT id, round(x0 * cos(0.3) + y0 * sin(0.3), 6) AS t, round(y0 * cos(0.3) - x0 * sin(0.3), 6) AS s FROM seg"),
)
def along_across(spark, sf_dir):
    x, y, a = F.col("x0"), F.col("y0"), F.lit(0.3)
    return fx.frame(spark, sf_dir, fx.SEG).select("id", *rounded(t=g.along(x, y, a), s=g.across(x, y, a)))


@query(
    "q07_point_in_polygon",
    fx.with_fixtures(
        """SELECT id, x0 + y0 < 2000 AND NOT (x0 > 400.5 AND x0 < 800.5 AND y0 > 300.5 AND y0 < 700.5) AS inside FROM seg"""
    ),
)
def point_in_polygon(spark, sf_dir):
    at = lambda x, y: g.point(F.lit(x), F.lit(y))
    shell = F.array(at(-1.0, -1.0), at(2001.0, -1.0), at(-1.0, 2001.0))
    hole = F.array(at(400.5, 300.5), at(800.5, 300.5), at(800.5, 700.5), at(400.5, 700.5))
    inside = g.in_multipolygon(F.col("x0"), F.col("y0"), F.array(F.array(shell, hole)))
    return fx.frame(spark, sf_dir, fx.SEG).select("id", inside.alias("inside"))


_SPAN, _HALF = "(40075016.685578485 / pow(2, 17))", "20037508.342789244"


@query(
    "q08_haversine_and_map_tiles",
    fx.with_fixtures(
        f"""WITH places AS (SELECT id, 28.7 + x0 / 100000 AS lon, 47.1 + y0 / 100000 AS lat FROM seg),
        flat AS (SELECT id, lon, lat, radians(lon) * 6378137 AS x, 6378137 * ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM places),
        spot AS (SELECT *, floor((x + {_HALF}) / {_SPAN}) AS tx, floor(({_HALF} - y) / {_SPAN}) AS ty FROM flat)
        SELECT id, round(2 * 6371000 * asin(sqrt(pow(sin(radians(47.1 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(47.1)) * pow(sin(radians(28.7 - lon) / 2), 2))), 4) AS metres,
        CAST(tx AS BIGINT) AS tx, CAST(ty AS BIGINT) AS ty, round(tx * {_SPAN} - {_HALF}, 3) AS left_x, round({_HALF} - ty * {_SPAN}, 3) AS top_y FROM spot"""
    ),
)
def haversine_and_map_tiles(spark, sf_dir):
    lon, lat, z = F.lit(28.7) + F.col("x0") / 100000, F.lit(47.1) + F.col("y0") / 100000, F.lit(17)
    x, y = g.lonlat_to_mercator(lon, lat)
    spot = g.slippy_range(z, x, y, x, y)
    bounds = g.slippy_bounds(z, spot["tx0"], spot["ty0"])
    return fx.frame(spark, sf_dir, fx.SEG).select(
        "id",
        F.round(g.haversine(lon, lat, F.lit(28.7), F.lit(47.1)), 4).alias("metres"),
        spot["tx0"].alias("tx"),
        spot["ty0"].alias("ty"),
        *rounded(3, left_x=bounds["x0"], top_y=bounds["y1"]),
    )


@query(
    "q09_names",
    fx.with_fixtures(
        """SELECT id, printf('Row %03d, Col %03d', r, c) AS pretty, CASE k % 3 WHEN 0 THEN 'Bare soil' WHEN 1 THEN 'Vegetation' ELSE '' END AS cover,
        CASE k % 3 WHEN 0 THEN '#8d6e63' WHEN 1 THEN '#43a047' ELSE '#9e9e9e' END AS colour, r AS tile_row, c AS tile_col,
        CASE k % 3 WHEN 2 THEN 'Tile: ' || r ELSE 'Tile: ' || r || '<br>Cover: ' || CASE k % 3 WHEN 0 THEN 'bare_soil' ELSE 'vegetation' END END AS popup FROM seg"""
    ),
)
def names(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).select(
        "*", F.format_string("tile_r%03d_c%03d.tif", "r", "c").alias("name"), F.when(F.col("k") % 3 == 0, "bare_soil").when(F.col("k") % 3 == 1, "vegetation").otherwise("").alias("cover_raw")
    )
    return seg.select(
        "id",
        text.pretty_tile(F.col("name")).alias("pretty"),
        text.pretty_value(F.col("cover_raw")).alias("cover"),
        text.lookup(F.col("cover_raw"), {"bare_soil": "#8d6e63", "vegetation": "#43a047"}, "#9e9e9e").alias("colour"),
        text.tile_row(F.col("name")).alias("tile_row"),
        text.tile_col(F.col("name")).alias("tile_col"),
        text.popup([("Tile", F.col("r")), ("Cover", F.col("cover_raw"))]).alias("popup"),
    )
