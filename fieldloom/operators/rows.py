"""Vine rows from instance masks or from the vegetation itself."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.operators import raster
from fieldloom.operators.sequences import gap_split, gaussian_weights, separated

LINE = "array<struct<x: double, y: double>>"


def instance_filter(pixels: DataFrame, names: dict[int, str], wanted: set[str], fallback: int = 1, least: int = 400, probability: float = 0.5) -> DataFrame:
    """Pixels (tile, inst, cls, p, x, y) of the instances of a wanted class, above a probability and of a least area;
    where no class has a wanted name, the fallback class is taken."""
    classes = [c for c, n in names.items() if n in wanted] or [fallback]
    kept = pixels.filter(F.col("cls").isin(classes) & (F.col("p") > probability))
    return kept.withColumn("_n", F.count("*").over(Window.partitionBy("tile", "inst"))).filter(F.col("_n") >= least).drop("_n")


def cross_axis_order(rows: DataFrame, keys: list[str], points: str = "points") -> DataFrame:
    """Rows with their place across the median direction of their group's chords."""
    a, b = F.element_at(points, 1), F.element_at(points, -1)
    angled = rows.withColumn("_a", g.undirected_angle(b["x"] - a["x"], b["y"] - a["y"]))
    main = angled.groupBy(*keys).agg(F.median("_a").alias("_m"))
    mean = g.vertex_mean(F.col(points))
    keyed = angled.join(main, keys).withColumn("offset", g.across(mean["x"], mean["y"], F.col("_m")))
    return keyed.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("offset"))).drop("_a", "_m")


def _simplified(epsilon: float):
    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        out = [(r["tile"], r["row"], [{"x": x, "y": y} for x, y in raster.simplify([(p["x"], p["y"]) for p in r["points"]], epsilon)]) for _, r in group.iterrows()]
        return pd.DataFrame(out, columns=["tile", "row", "points"])

    return kernel


def row_members(pixels: DataFrame, angle: Column, gap: float = 45.0, least: int = 2) -> DataFrame:
    """(tile, cluster, t, x, y): instance centroids in clusters across an angle, split where they are over `gap` apart."""
    middle = pixels.groupBy("tile", "inst").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    placed = middle.withColumns({"t": g.along(F.col("x"), F.col("y"), angle), "s": g.across(F.col("x"), F.col("y"), angle)})
    return gap_split(placed, ["tile"], "s", gap, least)


def assemble_rows(pixels: DataFrame, angle: Column, gap: float = 45.0, least: int = 2, epsilon: float = 8.0) -> DataFrame:
    """(tile, row, points): the members of each cluster in order along the angle, simplified. A row has at most a tile's
    instances."""
    members = row_members(pixels, angle, gap, least)
    lines = members.groupBy("tile", "cluster").agg(F.array_sort(F.collect_list(F.struct("t", "x", "y"))).alias("m"))
    numbered = lines.select("tile", (F.row_number().over(Window.partitionBy("tile").orderBy("cluster")) - 1).alias("row"), F.transform("m", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
    kind = pixels.schema["tile"].dataType.simpleString()
    return numbered.groupBy("tile").applyInPandas(_simplified(epsilon), f"tile {kind}, row int, points {LINE}")


def global_rows(segments: DataFrame, gap: float = 1.3, block: str = "V01") -> DataFrame:
    """(id, row_id): segments of one block numbered across its median direction, a new row behind each gap in metres.

    Directions around zero are unwrapped before the median. The block's offsets are sorted in one task: they are one
    number a segment."""
    angle = g.undirected_angle(F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay"))
    angled = segments.select("id", "ax", "ay", "bx", "by_", angle.alias("_a"))
    # Against one of them as a base, every direction lies within a right angle of it.
    base = angled.agg(F.min(F.struct("id", "_a")).alias("m")).select(F.col("m._a").alias("_b"))
    first = base.first()
    if first is None or first[0] is None:
        return segments.select("id", F.lit("").alias("row_id")).limit(0)
    off = F.pmod(F.col("_a") - first[0] + math.pi / 2, F.lit(math.pi)) - math.pi / 2
    main = angled.agg(F.median(F.lit(first[0]) + off)).first()[0]
    # Of the two ways along the rows the one to the east.
    main = (main + math.pi / 2) % math.pi - math.pi / 2
    spots = angled.select("id", F.lit(0).alias("_k"), F.round(g.across((F.col("ax") + F.col("bx")) / 2, (F.col("ay") + F.col("by_")) / 2, F.lit(main)), 6).alias("s"))
    split = gap_split(spots, ["_k"], "s", gap)
    return split.select("id", F.format_string(f"{block}-R%02d", (F.col("cluster") + 1).cast("int")).alias("row_id"))


def detect_rows(pixels: DataFrame, spacing: float, sigma: float = 2.0, least: int = 20, least_pixels: int = 500) -> DataFrame:
    """(tile, row, angle, s, t0, t1): rows as ridges of set pixels (tile, x, y) of each tile with enough of them.

    The angle is the one across which pixels bunch most. Pixels are counted across it in bins of two; the smoothed
    profile has a peak per row above 0.13 of its greatest value, and of peaks nearer than 0.55 of the spacing the higher
    stays. A row ends at the first and last percentile of its pixels, those within 0.35 of the spacing."""
    enough = pixels.groupBy("tile").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least_pixels).select("tile")
    pixels = pixels.join(enough, "tile", "left_semi")
    # Of the two ways along the rows the one to the east.
    angles = raster.best_angle(raster.angle_scores(pixels)).select("tile", F.radians(F.when(F.col("angle") >= 90, F.col("angle") - 180).otherwise(F.col("angle"))).alias("angle"))
    x, y, a = F.col("x"), F.col("y"), F.col("angle")
    placed = pixels.join(angles, "tile").withColumns({"s": g.across(x, y, a), "t": g.along(x, y, a)})
    placed = placed.join(placed.groupBy("tile").agg(F.min("s").alias("low")), "tile")
    counts = placed.groupBy("tile", "low", F.floor((F.col("s") - F.col("low")) / 2).cast("int").alias("bin")).agg(F.count("*").cast("double").alias("v"))
    kind = pixels.schema["tile"].dataType.simpleString()
    weights = [w for _, w in gaussian_weights(sigma)]

    def part(group: pd.DataFrame) -> pd.DataFrame:
        profile = np.zeros(int(group["bin"].max()) + 1)
        profile[group["bin"]] = group["v"]
        smooth = np.convolve(np.pad(profile, len(weights) // 2, mode="symmetric"), weights, mode="valid")
        peaks = [(i, smooth[i]) for i in range(1, len(smooth) - 1) if smooth[i - 1] <= smooth[i] > smooth[i + 1] and smooth[i] > 0.13 * smooth.max()]
        kept = separated(peaks, int(spacing * 0.55 / 2))
        return pd.DataFrame({"tile": group["tile"].iloc[0], "row": range(len(kept)), "peak": [group["low"].iloc[0] + 2.0 * b + 1 for b, _ in kept]})

    rows = counts.groupBy("tile").applyInPandas(part, f"tile {kind}, row int, peak double")
    near = placed.join(rows, "tile").filter(F.abs(F.col("s") - F.col("peak")) < 0.35 * spacing)
    ends = raster.row_ends(near, ["tile", "row", "peak", "angle"], "t", least)
    return ends.select("tile", "row", "angle", F.col("peak").alias("s"), "t0", "t1")
