"""Roll-ups, tallies and direction statistics of survey objects."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import or_none

#: The tidy table: metric, vineyard_id, row_id, value, unit.
TIDY = "metric string, vineyard_id string, row_id string, value double, unit string"


def tidy(metric: str, unit: str, value: Column, block: Column | None = None, row: Column | None = None) -> list[Column]:
    return [
        F.lit(metric).alias("metric"),
        (F.lit("") if block is None else block).alias("vineyard_id"),
        (F.lit("") if row is None else row).alias("row_id"),
        value.cast("double").alias("value"),
        F.lit(unit).alias("unit"),
    ]


def measurement_rollup(rows: DataFrame, canopy: DataFrame, interrow: DataFrame) -> DataFrame:
    """The tidy metric table from rows (vineyard_id, row_id, length), canopy areas per block (vineyard_id, area: of the
    union) and inter-row strips (vineyard_id, area).

    Lengths of one row add up over tiles; totals are sums of their groups; blocks come from any of the three
    layers, and the empty id counts only where there is no other. Groups are aggregated before any join."""
    per_row = rows.groupBy("row_id").agg(F.sum("length").alias("length"), F.max("vineyard_id").alias("vineyard_id"))
    per_canopy = canopy.groupBy("vineyard_id").agg(F.sum("area").alias("area"))
    per_strip = interrow.groupBy("vineyard_id").agg(F.sum("area").alias("area"))
    blocks = rows.select("vineyard_id").union(canopy.select("vineyard_id")).union(interrow.select("vineyard_id")).distinct()
    named = F.count_if(F.col("vineyard_id") != "")
    parts = [
        blocks.agg(F.when(named > 0, named).otherwise(F.count("*")).alias("v")).select(*tidy("block_count", "count", F.col("v"))),
        per_row.agg(F.count("*").alias("v")).select(*tidy("row_count", "count", F.col("v"))),
        per_row.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("v")).select(*tidy("total_row_length", "m", F.col("v"))),
        per_canopy.agg(F.coalesce(F.sum("area"), F.lit(0)).alias("v")).select(*tidy("total_canopy_area", "m2", F.col("v"))),
        per_strip.agg(F.coalesce(F.sum("area"), F.lit(0)).alias("v")).select(*tidy("total_interrow_area", "m2", F.col("v"))),
        blocks.join(per_canopy, "vineyard_id", "left").select(*tidy("canopy_area", "m2", F.coalesce("area", F.lit(0)), F.col("vineyard_id"))),
        blocks.join(per_strip, "vineyard_id", "left").select(*tidy("interrow_area", "m2", F.coalesce("area", F.lit(0)), F.col("vineyard_id"))),
        per_row.select(*tidy("row_length", "m", F.col("length"), F.col("vineyard_id"), F.col("row_id"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tally(df: DataFrame, keys: list[str], attribute: str) -> DataFrame:
    """Counts by attribute, null and '' as 'None'."""
    return df.groupBy(*keys, or_none(F.col(attribute)).alias("value")).agg(F.count("*").alias("n"))


def tally_fixed(df: DataFrame, keys: list[str], attribute: str, values: list[str]) -> DataFrame:
    """Counts of a fixed list of values for every group, 0 where there are none."""
    wide = df.groupBy(*keys).agg(*[F.count_if(F.col(attribute) == v).alias(v) for v in values])
    return wide.select(*keys, F.explode(F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"`{v}`").alias("n")) for v in values])).alias("t")).select(*keys, "t.value", "t.n")


def legend(df: DataFrame, attribute: str, preferred: list[str]) -> DataFrame:
    """(place, value, n): the preferred values that occur in their order, then the others by name."""
    counts = tally(df, [], attribute)
    order = F.array_position(F.array(*[F.lit(v) for v in preferred]), F.col("value"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(F.when(order > 0, order).otherwise(len(preferred) + 1), "value")))


def block_tallies(canopy: DataFrame, rows: DataFrame, interrow: DataFrame, waste: DataFrame) -> DataFrame:
    """Per block: canopies, distinct row ids, inter-rows and waste; 0 where a layer has none."""
    label = lambda df, name, item: df.select("vineyard_id", F.lit(name).alias("layer"), item.cast("string").alias("item"))
    every = label(canopy, "canopy", F.lit(None)).unionByName(label(rows, "rows", F.col("row_id"))).unionByName(label(interrow, "interrow", F.lit(None))).unionByName(label(waste, "waste", F.lit(None)))
    return every.groupBy("vineyard_id").agg(
        F.count_if(F.col("layer") == "canopy").alias("canopy"),
        F.count_distinct(F.when(F.col("layer") == "rows", F.col("item"))).alias("rows"),
        F.count_if(F.col("layer") == "interrow").alias("interrow"),
        F.count_if(F.col("layer") == "waste").alias("waste"),
    )


def dominant_angle(length: Column, angle: Column) -> Column:
    """Length-weighted mean of undirected angles, by doubling them; an aggregate in (-pi/2, pi/2]."""
    return F.atan2(F.sum(length * F.sin(2 * angle)), F.sum(length * F.cos(2 * angle))) / 2


def row_filter(df: DataFrame, tile: list[str], least_path: float, least_straight: float, most_turn: float, least_rows: int) -> DataFrame:
    """Rows (path, chord, angle) that are long, straight and along the tile's dominant direction; tiles with fewer
    than least_rows of them lose all."""
    here = Window.partitionBy(*tile)
    main = F.atan2(F.sum(F.col("path") * F.sin(2 * F.col("angle"))).over(here), F.sum(F.col("path") * F.cos(2 * F.col("angle"))).over(here)) / 2
    off = F.pmod(F.abs(F.col("angle") - F.col("_main")), F.lit(math.pi))
    good = df.withColumn("_main", main).filter((F.col("path") >= least_path) & (F.col("chord") / F.col("path") >= least_straight) & (F.degrees(F.least(off, F.lit(math.pi) - off)) <= most_turn))
    return good.withColumn("_n", F.count("*").over(here)).filter(F.col("_n") >= least_rows).drop("_main", "_n")


def cover_class(share: Column, pixels: Column, least_pixels: int = 50, bare: float = 0.25, green: float = 0.75) -> Column:
    """bare_soil, mixed or vegetation by green share; unassessable on too few pixels."""
    return F.when((pixels < least_pixels) | share.isNull(), "unassessable").when(share < bare, "bare_soil").when(share > green, "vegetation").otherwise("mixed")


def trip_summary(length: Column, naive: Column, visited: Column) -> list[Column]:
    """Kilometres, walking minutes at 4 km/h (at least one), and the saving over single trips in percent."""
    half_up = lambda c: F.floor(c + 0.5)
    return [
        F.round(length / 1000, 3).alias("km"),
        F.greatest(F.lit(1), half_up(length / 4000 * 60)).alias("minutes"),
        F.when((naive > length) & (visited >= 2), half_up((naive - length) / naive * 100)).alias("saving"),
    ]
