"""Tiles: discovery, selection by stem, headers and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.functions import text


def discover(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """(path, length) of all matching files below a folder, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length")


def with_stem(paths: DataFrame) -> DataFrame:
    return paths.withColumn("stem", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1))


def full_stems(asked: list[str], prefix: str) -> list[str]:
    return [a if a.startswith(prefix) else prefix + a for a in asked]


def select_tiles(paths: DataFrame, asked: list[str] | None = None, limit: int | None = None, prefix: str = "") -> DataFrame:
    """Paths with stem and place in path order: those asked for by exact stem (the prefix may be left out), and of
    these the first `limit`."""
    found = with_stem(paths)
    if asked is not None:
        found = found.filter(F.col("stem").isin(full_stems(asked, prefix)))
    if limit is not None:
        found = found.orderBy("path").limit(limit)
    return found.withColumn("place", F.row_number().over(Window.partitionBy().orderBy("path")))


def missing_tiles(paths: DataFrame, asked: list[str], prefix: str = "") -> DataFrame:
    """Asked stems that no path has."""
    wanted = paths.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(full_stems(asked, prefix))], "stem string")
    return wanted.join(with_stem(paths), "stem", "left_anti")


def resolve(objects: DataFrame, tiles: DataFrame, on: str = "tile") -> DataFrame:
    """Objects of known tiles; others are skipped."""
    return objects.join(tiles.select(on).distinct(), on, "left_semi")


def headers(tiles: DataFrame, name: str = "tile") -> DataFrame:
    """Each tile's affine from its name, by the grid's closed form."""
    row, col = text.tile_row(F.col(name)), text.tile_col(F.col(name))
    return tiles.select(
        "*",
        row.alias("r"),
        col.alias("c"),
        F.lit(g.PIXEL).alias("a"),
        g.tile_left(col).alias("c0"),
        F.lit(-g.PIXEL).alias("e"),
        g.tile_top(row).alias("f"),
        F.lit("EPSG:32635").alias("crs"),
        F.lit(g.TILE_PX).alias("width"),
        F.lit(g.TILE_PX).alias("height"),
    )


def band_profile(pixels: DataFrame, tile: str = "tile", bands: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """(tile, band, least, most, mean, deviation) with the population's standard deviation."""
    stacked = pixels.select(tile, F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).cast("double").alias("v")) for b in bands])).alias("s"))
    return stacked.groupBy(tile, F.col("s.band").alias("band")).agg(
        F.min("s.v").alias("least"), F.max("s.v").alias("most"), F.avg("s.v").alias("mean"), F.stddev_pop("s.v").alias("deviation")
    )


def data_extent(boxes: DataFrame) -> DataFrame:
    return boxes.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
