"""Vegetation indices and colour gates as column expressions over band values of 0 to 255."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_byte(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0)), F.lit(255))


def excess_green(r: Column, g: Column, b: Column) -> Column:
    """2 g - r - b, clipped to a byte."""
    return clip_byte(F.lit(2) * g - r - b)


def raw_excess_green(r: Column, g: Column, b: Column) -> Column:
    return F.lit(2) * g - r - b


def hsv(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue in [0, 180), saturation and value in [0, 255], each rounded half up."""
    v = F.greatest(r, g, b)
    spread = v - F.least(r, g, b)
    s = F.when(v == 0, F.lit(0.0)).otherwise(spread * 255.0 / v)
    raw = (
        F.when(spread == 0, F.lit(0.0))
        .when(v == r, 60.0 * (g - b) / spread)
        .when(v == g, 120.0 + 60.0 * (b - r) / spread)
        .otherwise(240.0 + 60.0 * (r - g) / spread)
    )
    h = F.floor(F.when(raw < 0, raw + 360.0).otherwise(raw) / 2 + 0.5)
    return F.when(h == 180, F.lit(0)).otherwise(h).cast("int"), F.floor(s + 0.5).cast("int"), v.cast("int")


def green_gate(r: Column, g: Column, b: Column) -> Column:
    """Hue 15 to 55, saturation from 30, value from 25."""
    h, s, v = hsv(r, g, b)
    return h.between(15, 55) & (s >= 30) & (v >= 25)


def covered(r: Column, g: Column, b: Column) -> Column:
    """A pixel with any light in it; black is no data."""
    return r + g + b > 0
