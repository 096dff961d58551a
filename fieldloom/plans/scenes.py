"""Queries of image files, patches, pixels in strips, and layers of a web export."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.operators import polygons, raster
from fieldloom.sources import geojson, images

from . import fixtures as fx
from . import jobs
from .catalogue import query
from .files import _LABEL, fresh, objects
from .geometry import lonlat_sql
from .spatial import _STRIPS, _UNION

_CENTRE_X, _CENTRE_Y = "51.2::DOUBLE * (12285 + c) + 0.025::DOUBLE * (x0 + 0.5::DOUBLE)", "51.2::DOUBLE * (101977 - r) - 0.025::DOUBLE * (y0 + 0.5::DOUBLE)"


@query(
    "q79_web_layers",
    fx.with_fixtures(
        f"""WITH o AS (SELECT id, r, c, 'rows' AS layer, 2 AS vertices, '' AS vineyard_id, x0, y0 FROM seg UNION ALL
        SELECT id, r, c, CASE {_LABEL.split(' ', 1)[1].replace("'vineyard'", "'canopy'").replace("'interrow_area'", "'interrow'")}, 5, printf('V%02d', r + 1), x0, y0 FROM box),
        w AS (SELECT *, {_CENTRE_X} AS wx, {_CENTRE_Y} AS wy FROM o)
        SELECT layer, CAST(id AS INTEGER) AS place, printf('tile_r%03d_c%03d.tif', r, c) AS tile, vineyard_id, vertices, CAST(round({lonlat_sql("wx", "wy")[0]} * 1e7) AS BIGINT) // 100 AS lon, CAST(round({lonlat_sql("wx", "wy")[1]} * 1e7) AS BIGINT) // 100 AS lat FROM w"""
    ),
)
def web_layers(spark, sf_dir):
    """Every object as a feature in degrees: its first vertex in hundred-thousandths, its vertices and its block.

    Files hold seven digits, of which the last is left out here: a sum in another order may round it the other way."""
    kind = "type string, geometry struct<type: string, coordinates: string>, properties struct<vineyard_id: string, tile: string>"
    features = jobs.web_features(objects(spark, sf_dir)).select("layer", "place", F.from_json("feature", kind).alias("f"))
    line = geojson.geometry(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))[0][0]
    cell = lambda c: F.floor(F.round(F.col("p")[0][c] * 1e7).cast("long") / 100)
    shown = features.select("layer", "place", F.col("f.properties.tile").alias("tile"), F.col("f.properties.vineyard_id").alias("vineyard_id"), line.alias("p"))
    return shown.select("layer", "place", "tile", "vineyard_id", F.size("p").alias("vertices"), cell("x").alias("lon"), cell("y").alias("lat"))


def _tiles(group: pd.DataFrame) -> pd.DataFrame:
    tile, a = int(group["tile"].iloc[0]), np.zeros((64, 64, 3), np.uint8)
    a[group["y"], group["x"]] = group[["r", "g", "b"]]
    return pd.DataFrame({"path": [f"row{tile // 5}/tile_{tile:02d}.tif"], "content": [images.encode_tiff(a, 0.025, (tile * 1.6, 500.0 - tile))]})


@query(
    "q80_image_files",
    fx.with_fixtures(
        """SELECT printf('tile_%02d.tif', tile) AS name, 64 AS width, 64 AS height, 0.025::DOUBLE AS a, round(tile * 1.6::DOUBLE, 6) AS c0, 500.0::DOUBLE - tile AS f, count(*) FILTER (WHERE r + g + b > 0) AS n,
        CAST(sum(r) AS BIGINT) AS r, CAST(sum(g * (x + 1)) AS BIGINT) AS g, CAST(sum(b * (y + 1)) AS BIGINT) AS b FROM px GROUP BY tile"""
    ),
)
def image_files(spark, sf_dir):
    """Tiles written as TIFF below folders, and read with their places."""
    folder = fresh(spark, "tiles").removeprefix("file:")
    images.write_files(fx.frame(spark, sf_dir, fx.PX).groupBy("tile").applyInPandas(_tiles, "path string, content binary"), folder)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    long = lambda c: F.col(c).cast("long")
    pixels = images.read_pixels(spark, folder).groupBy(name).agg(
        F.count_if(long("r") + long("g") + long("b") > 0).alias("n"), F.sum(long("r")).alias("r"), F.sum(long("g") * (F.col("x") + 1)).alias("g"), F.sum(long("b") * (F.col("y") + 1)).alias("b")
    )
    return images.read_headers(spark, folder).select(name, "width", "height", "a", F.round("c0", 6).alias("c0"), "f").join(pixels, "name")


@query("q81_patch_masks", fx.with_fixtures("SELECT tile, x, y FROM px WHERE g > 150 AND r > 20"))
def patch_masks(spark, sf_dir):
    """Masks of overlapping patches put together: a model that looks at single pixels gives what it gives on whole tiles."""
    return raster.infer_patches(fx.frame(spark, sf_dir, fx.PX), lambda: lambda patch: (patch[:, :, 1] > 150) & (patch[:, :, 0] > 20), 64, 64, 24, 18)


_RINGS = """SELECT id, CAST(id % 25 AS INT) AS tile, CAST((id * 7) % 50 AS DOUBLE) AS x0, CAST((id * 11) % 50 AS DOUBLE) AS y0, CAST((id * 7) % 50 + 5 + id % 9 AS DOUBLE) AS x1,
  CAST((id * 11) % 50 + 4 + id % 7 AS DOUBLE) AS y1 FROM (SELECT c_custkey AS id FROM {customer}) c"""


@query(
    "q82_strip_cover",
    fx.with_fixtures(
        """SELECT rings.tile, id, count(px.x) AS n, round(count(*) FILTER (WHERE 2 * g - r - b > 20) * 1.0::DOUBLE / nullif(count(px.x), 0), 6) AS share FROM rings LEFT JOIN px
        ON px.tile = rings.tile AND x >= x0 AND x < x1 AND y >= y0 AND y < y1 WHERE rings.tile IN (SELECT tile FROM px) GROUP BY 1, 2""",
        rings=_RINGS,
    ),
)
def strip_cover(spark, sf_dir):
    """Pixels in rings and the green share of them."""
    ring = F.slice(g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]), 1, 4)
    rings = fx.frame(spark, sf_dir, _RINGS).select("tile", "id", ring.alias("ring"))
    return raster.ring_shares(rings, fx.frame(spark, sf_dir, fx.PX)).withColumn("share", F.round("share", 6))


@query(
    "q83_open_strips",
    fx.with_fixtures(
        f"""WITH strips AS ({_STRIPS}), b0 AS (SELECT s.r, s.c * 100 + s.id AS c, greatest(x0, sx0) AS x0, greatest(y0, sy0) AS y0, least(x1, sx1) AS x1, least(y1, sy1) AS y1
          FROM strips s JOIN box b ON s.r = b.r AND s.c = b.c AND b.status = 'O'), b AS (SELECT * FROM b0 WHERE x0 < x1 AND y0 < y1), {_UNION}
        SELECT s.r, s.c, s.id, round(1400 * 25 - coalesce(area, 0), 3) AS area FROM strips s LEFT JOIN area a ON a.r = s.r AND a.c = s.c * 100 + s.id WHERE 1400 * 25 - coalesce(area, 0) > 0.001"""
    ),
)
def open_strips(spark, sf_dir):
    """The area of all parts of a strip that no crown covers, by the kernel for general polygons."""
    box = fx.frame(spark, sf_dir, fx.BOX)
    y = 90 + 160.0 * F.col("k")
    strips = box.select("r", "c", F.col("k").alias("id"), g.box_ring(F.lit(100.0), y, F.lit(1500.0), y + 25).alias("strip"))
    strips = session.written(strips.distinct(), "strips")
    crowns = box.filter("status = 'O'").select("r", "c", g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("ring"))
    parts = polygons.open_parts(strips, ["r", "c"], "strip", crowns)
    return parts.groupBy("r", "c", "id").agg(F.round(F.sum("area"), 3).alias("area")).filter("area > 0.001")
