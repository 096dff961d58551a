"""Names, labels and text formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_points(text: Column) -> Column:
    """'x,y;x,y' to a point list; empty text to an empty list."""
    points = F.transform(
        F.filter(F.split(text, ";"), lambda p: p != ""),
        lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y")),
    )
    return points


def fixed(v: Column, digits: int) -> Column:
    """A double with so many decimals, rounded by its exact binary value and exact halves to the even digit, as the files'
    other writers round; format_string rounds the shortest decimal form, halves away from zero. From 1e12 on, and for
    what is no number, it stands in. Null stays null."""
    up, size = 10**digits, F.abs(v)
    part = size - F.floor(size)
    k, steps = F.floor(part * up), part * float(1 << 52)
    wide = lambda c: c.cast("long").cast("decimal(20,0)")
    # Above zero where the value lies above the middle between k and k + 1.
    above = wide(F.floor(steps)) * F.lit(2 * up) - (wide(k) * 2 + 1) * F.lit(1 << 52)
    down = (above < 0) | ((above == 0) & (steps == F.floor(steps)) & (k % 2 == 0))
    near = k + F.when(down, 0).otherwise(1)
    whole = F.floor(size).cast("long") + F.when(near >= up, 1).otherwise(0)
    written = F.concat(F.when(v < 0, "-").otherwise(""), whole.cast("string"), F.lit("."), F.lpad((near % up).cast("string"), digits, "0"))
    return F.when(v.isNull(), F.lit(None)).when(size < 1e12, written).otherwise(F.format_string(f"%.{digits}f", v))


def format_points(points: Column) -> Column:
    """A point list to 'x,y;x,y' with two decimals; points that lack a coordinate are left out."""
    return F.array_join(F.transform(points, lambda p: F.concat(fixed(p["x"], 2), F.lit(","), fixed(p["y"], 2))), ";")


def escape_xml(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def pretty_value(text: Column) -> Column:
    """'bare_soil' to 'Bare soil'; null and '' pass."""
    spaced = F.replace(text, F.lit("_"), F.lit(" "))
    return F.when(text.isNull() | (text == ""), text).otherwise(F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, 2, 1 << 30)))


TILE = r"(?i)r(\d+)_c(\d+)"


def tile_row(tile: Column) -> Column:
    return F.nullif(F.regexp_extract(tile, TILE, 1), F.lit("")).cast("int")


def tile_col(tile: Column) -> Column:
    return F.nullif(F.regexp_extract(tile, TILE, 2), F.lit("")).cast("int")


def pretty_tile(tile: Column) -> Column:
    """'..._r021_c012.tif' to 'Row 021, Col 012'; another name only loses '.tif'."""
    row, col = F.regexp_extract(tile, TILE, 1), F.regexp_extract(tile, TILE, 2)
    return F.when(row != "", F.concat(F.lit("Row "), row, F.lit(", Col "), col)).otherwise(F.regexp_replace(tile, r"(?i)\.tif$", ""))


def lookup(key: Column, choices: dict[str, str], default: str) -> Column:
    """A palette's entry, or the default."""
    table = F.create_map(*[F.lit(x) for pair in choices.items() for x in pair])
    return F.coalesce(F.element_at(table, F.coalesce(key, F.lit(""))), F.lit(default))


def popup(fields: list[tuple[str, Column]]) -> Column:
    """Lines 'name: value' of the fields that are not empty."""
    lines = [F.when(v.isNotNull() & (v.cast("string") != ""), F.concat(F.lit(f"{name}: "), v.cast("string"))) for name, v in fields]
    return F.array_join(F.filter(F.array(*lines), lambda x: x.isNotNull()), "<br>")


def natural_key(text: Column) -> Column:
    """Sorts 'V2' before 'V10': the text with each number padded to twelve digits."""
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 12, "0")).otherwise(p)), "")


def or_none(text: Column) -> Column:
    """A tally's key: 'None' for null and ''."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("None"))
