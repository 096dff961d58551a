"""Global identities: row fragments of many tiles become blocks and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.operators.components import connected_components
from fieldloom.operators.sequences import dense_label
from fieldloom.operators.spatial import of_shapes, segment_links, segment_shapes


def labelled(segments: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """Each segment's component, by its least id; a segment without an edge is its own."""
    labels = connected_components(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))).toDF("id", name)
    return segments.drop(name).join(labels, "id", "left").withColumn(name, F.coalesce(F.col(name), F.col("id")))


def identified(segments: DataFrame, reach: float = 5.0, names: tuple[str, ...] = ("block", "row"), **limits) -> DataFrame:
    """Segments (id, ends, ...) with their block and row, each the least id of its component. Copies of a segment take part
    once, and pairs are never written: cells give stars of what they tie."""
    shapes = session.written(segment_shapes(segments), "shapes")
    links, found = session.written(segment_links(shapes, reach, **limits), "links"), shapes
    for name in names:
        found = labelled(found, links.filter("line" if name == "row" else "NOT line"), name)
    out = of_shapes(segments.drop(*names), session.written(found.drop("id"), "labels"))
    return out.withColumns({name: F.coalesce(F.col(name), F.col("id").cast("long")) for name in names})


def prune_blocks(segments: DataFrame, least_rows: int = 3) -> DataFrame:
    """Without the blocks that have fewer than least_rows distinct rows. Removal never joins other components, so
    once is enough."""
    kept = segments.groupBy("block").agg(F.count_distinct("row").alias("_rows")).filter(F.col("_rows") >= least_rows)
    return segments.join(kept.select("block"), "block", "left_semi")


def stitch(segments: DataFrame, reach: float = 5.0, least_rows: int = 3, **limits) -> DataFrame:
    """(id, block, row, vineyard_id, row_id) of the segments (id, ax, ay, bx, by_) that belong to a proper block.

    Blocks are components of segments within reach of one another, rows components of segments of one block on one
    line. Blocks are named V01.. by their least easting, rows V01-R01.. by the mean of their fragments' centres."""
    rowed = session.written(identified(segments, reach, **limits), "identified")
    kept = session.written(prune_blocks(rowed, least_rows), "stitched")
    least = kept.groupBy("block").agg(F.min(F.least("ax", "bx")).alias("_east"))
    names = least.select("block", dense_label([F.col("_east"), F.col("block")], "V").alias("vineyard_id"))
    centre = kept.groupBy("block", "row").agg(F.avg((F.col("ax") + F.col("bx")) / 2).alias("_x"), F.avg((F.col("ay") + F.col("by_")) / 2).alias("_y"))
    within = F.row_number().over(Window.partitionBy("block").orderBy(F.round("_x", 6), F.round("_y", 6), "row"))
    rows = centre.select("block", "row", within.alias("_k")).join(names, "block")
    rows = rows.select("block", "row", "vineyard_id", F.format_string("%s-R%02d", "vineyard_id", "_k").alias("row_id"))
    return kept.select("id", "block", "row").join(rows, ["block", "row"])


def rows_by_block(rows: DataFrame) -> DataFrame:
    """(vineyard_id, row_ids in order)."""
    return rows.groupBy("vineyard_id").agg(F.array_sort(F.collect_set("row_id")).alias("row_ids"))
