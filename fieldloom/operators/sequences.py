"""Ordered-sequence operators as window expressions: each needs one shuffle by its partition keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions import text


def gap_split(df: DataFrame, keys: list[str], value: str, gap: float, least: int = 1, name: str = "cluster") -> DataFrame:
    """Number clusters (from 0) of sorted values: a new one starts behind a gap. Clusters with fewer than
    least members are dropped; the numbers stay as counted before that."""
    ordered = Window.partitionBy(*keys).orderBy(value)
    step = F.col(value) - F.lag(value).over(ordered)
    numbered = df.withColumn("_new", F.when(step > gap, 1).otherwise(0)).withColumn(name, F.sum("_new").over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")
    if least <= 1:
        return numbered
    return numbered.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, name))).filter(F.col("_n") >= least).drop("_n")


def row_structure(df: DataFrame, keys: list[str], along: str, gap: float, name: str = "row_structure") -> DataFrame:
    """Class of each row by the largest gap along it: disrupted from `gap` on, unassessable under two samples."""
    step = F.col(along) - F.lag(along).over(Window.partitionBy(*keys).orderBy(along))
    return (
        df.withColumn("_step", step)
        .groupBy(*keys)
        .agg(F.max("_step").alias("max_gap"), F.count("*").alias("n"))
        .withColumn(name, F.when(F.col("n") < 2, "unassessable").when(F.col("max_gap") >= gap, "disrupted").otherwise("regular"))
    )


def local_maxima(df: DataFrame, keys: list[str], at: str, value: str, share: float = 0.13) -> DataFrame:
    """Values that reach the left neighbour, exceed the right one and a share of the greatest."""
    ordered = Window.partitionBy(*keys).orderBy(at)
    left, right = F.lag(value).over(ordered), F.lead(value).over(ordered)
    flagged = df.withColumn("_top", (F.col(value) >= left) & (F.col(value) > right) & (F.col(value) > share * F.max(value).over(Window.partitionBy(*keys))))
    return flagged.filter("_top").drop("_top")


def separated(peaks: list[tuple[float, float]], least: float) -> list[tuple[float, float]]:
    """(at, value) peaks in order, of those nearer than least to the last kept one the higher."""
    kept: list[tuple[float, float]] = []
    for at, value in sorted(peaks):
        if kept and at - kept[-1][0] < least:
            if value > kept[-1][1]:
                kept[-1] = (at, value)
        else:
            kept.append((at, value))
    return kept


def consecutive_pairs(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each row beside the next one: its columns again with next_ in front. The last row of a group is left out."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    out = df.select("*", *[F.lead(c).over(ordered).alias(f"next_{c}") for c in columns], F.row_number().over(ordered).alias("place"), F.count("*").over(Window.partitionBy(*keys)).alias("_n"))
    return out.filter("place < _n").drop("_n")


def dense_label(order: list[Column], prefix: str, keys: list[str] = (), pattern: str = "%02d") -> Column:
    """'V01', 'V02', ... in order within the keys."""
    window = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return F.format_string(f"{prefix}{pattern}", F.row_number().over(window.orderBy(*order)))


def natural_rank(column: str, keys: list[str] = ()) -> Column:
    window = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return F.row_number().over(window.orderBy(text.natural_key(F.col(column)), column))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group; Spark keeps only k rows a partition before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)


def first_occurrences(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Distinct keys at their first positions, renumbered from 0."""
    first = df.groupBy(*keys).agg(F.min(position).alias(position))
    return first.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(position)) - 1)


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [(k, w / sum(raw)) for k, w in zip(range(-radius, radius + 1), raw)]


def gaussian_smooth(df: DataFrame, keys: list[str], at: str, value: str, size: int, sigma: float, name: str = "smooth") -> DataFrame:
    """Smooth a dense profile at 0..size-1, mirrored at its ends (the end sample repeats).

    Every sample is dealt to the few places that it counts for, so that one aggregation does it."""
    weights = gaussian_weights(sigma)
    radius = weights[-1][0]
    near = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in weights]))
    # Where a sample stands in the profile and in its mirror images, as far as the kernel reaches.
    turns = [2 * size * m for m in range(-(radius // (2 * size)) - 1, radius // (2 * size) + 2)]
    images = F.filter(F.array(*[p for t in turns for p in (F.col(at) + t, -1 - F.col(at) + t)]), lambda p: p.between(-radius, size - 1 + radius))
    spread = df.select(*keys, value, F.explode(images).alias("_p")).select(*keys, value, "_p", near.alias("_n"))
    to = (F.col("_p") - F.col("_n.k")).cast("int")
    return spread.select(*keys, to.alias(at), (F.col(value) * F.col("_n.w")).alias("_v")).filter(F.col(at).between(0, size - 1)).groupBy(*keys, at).agg(F.sum("_v").alias(name))
