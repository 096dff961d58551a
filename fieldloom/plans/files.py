"""Queries that write files to the shared folder and read them back, and of the text formats in them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.functions import text
from fieldloom.operators import evaluate
from fieldloom.sources import cvat, geojson, metrics, training

from . import fixtures as fx
from . import jobs, spatial
from .catalogue import query


def objects(spark, sf_dir):
    """Rows, crowns, strips and litter of the fixtures as annotation objects."""
    name = F.format_string("tile_r%03d_c%03d.tif", "r", "c")
    seg, box = fx.frame(spark, sf_dir, fx.SEG), fx.frame(spark, sf_dir, fx.BOX)
    line = F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x1"), F.col("y1")))
    ring = F.slice(g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]), 1, 4)
    common = [name.alias("tile"), F.lit(2048).alias("width"), F.lit(2048).alias("height")]
    nothing = F.lit(None).cast("string")
    rows = seg.select(*common, F.lit("row").alias("label"), F.col("id").cast("int").alias("place"), line.alias("points"), F.lit("").alias("vineyard_id"), F.lit("").alias("row_id"), F.lit("regular").alias("row_structure"), nothing.alias("interrow_cover"))
    label = F.when(F.col("status") == "O", "vineyard").when(F.col("status") == "F", "interrow_area").otherwise("waste")
    points = F.when(F.col("status") == "P", line).otherwise(ring)
    cover = F.when(F.col("status") == "F", F.when(F.col("k") % 2 == 0, "mixed").otherwise("bare_soil"))
    others = box.select(*common, label.alias("label"), F.col("id").cast("int").alias("place"), points.alias("points"), F.format_string("V%02d", F.col("r") + 1).alias("vineyard_id"), F.lit("").alias("row_id"), nothing.alias("row_structure"), cover.alias("interrow_cover"))
    return rows.unionByName(others)


def fresh(spark, name: str) -> str:
    return f"{session.shared_dir(spark)}/fieldloom/{name}-{uuid.uuid4().hex}"


_LABEL = "CASE status WHEN 'O' THEN 'vineyard' WHEN 'F' THEN 'interrow_area' ELSE 'waste' END"


@query(
    "q60_cvat_round_trip",
    fx.with_fixtures(
        f"""SELECT printf('tile_r%03d_c%03d.tif', r, c) AS tile, label, count(*) AS n, round(sum(x0), 2) AS x0 FROM
        (SELECT r, c, 'row' AS label, x0 FROM seg UNION ALL SELECT r, c, {_LABEL}, x0 FROM box) GROUP BY r, c, label"""
    ),
)
def cvat_round_trip(spark, sf_dir):
    path = fresh(spark, "cvat")
    cvat.write(objects(spark, sf_dir), path)
    read = cvat.read(spark, path)
    return read.groupBy("tile", "label").agg(F.count("*").alias("n"), F.round(F.sum(F.col("points")[0]["x"]), 2).alias("x0"))


@query(
    "q60b_annotation_stats",
    fx.with_fixtures(
        f"""WITH o AS (SELECT {_LABEL} AS label, printf('V%02d', r + 1) AS v, CASE WHEN status = 'F' THEN CASE WHEN k % 2 = 0 THEN 'mixed' ELSE 'bare_soil' END END AS cover FROM box)
        SELECT label, 'objects' AS what, '' AS value, count(*) AS n FROM o GROUP BY 1 UNION ALL SELECT label, 'blocks', '', count(DISTINCT v) FROM o GROUP BY 1
        UNION ALL SELECT label, 'interrow_cover', cover, count(*) FROM o WHERE cover IS NOT NULL GROUP BY 1, 3
        UNION ALL SELECT 'row', 'objects', '', count(*) FROM seg UNION ALL SELECT 'row', 'blocks', '', 0"""
    ),
)
def annotation_stats(spark, sf_dir):
    return evaluate.annotation_stats(objects(spark, sf_dir), ["interrow_cover"])


@query(
    "q61_geojson_round_trip",
    fx.with_fixtures(
        """SELECT 'rows' AS layer, 'LineString' AS geom_type, count(*) AS n, count(*) * 2 AS vertices FROM seg UNION ALL SELECT CASE status WHEN 'O' THEN 'canopy' WHEN 'F' THEN 'interrow' ELSE 'waste' END, 'Polygon', count(*), count(*) * 5 FROM box GROUP BY status"""
    ),
)
def geojson_round_trip(spark, sf_dir):
    features, out = session.written(jobs.web_features(objects(spark, sf_dir)), "features"), None
    for layer in jobs.LAYERS:
        path = fresh(spark, layer)
        geojson.write_collection(features.filter(F.col("layer") == layer), path, ["tile", "place"])
        parts = geojson.geometry(F.col("geom_type"), F.col("coordinates"))
        one = geojson.read(spark, path).select(F.lit(layer).alias("layer"), "geom_type", F.size(parts[0][0]).alias("k"))
        out = one if out is None else out.unionAll(one)
    return out.groupBy("layer", "geom_type").agg(F.count("*").alias("n"), F.sum("k").alias("vertices"))


@query("q62_point_strings", fx.with_fixtures("SELECT id, printf('%.2f,%.2f;%.2f,%.2f', x0, y0, x1, y1) AS written, round(x1, 2) AS last_x, 2 AS n FROM seg"))
def point_strings(spark, sf_dir):
    line = F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x1"), F.col("y1")))
    written = fx.frame(spark, sf_dir, fx.SEG).select("id", text.format_points(line).alias("written"))
    read = text.parse_points(F.col("written"))
    return written.select("id", "written", F.round(F.element_at(read, -1)["x"], 2).alias("last_x"), F.size(read).alias("n"))


@query(
    "q63_yolo_lines",
    fx.with_fixtures(
        """SELECT id, printf('%d %.6f %.6f %.6f %.6f %.6f %.6f', id % 2, x0 / 1500, y0 / 1500, least(x1 / 1500, 1), y0 / 1500, least(x1 / 1500, 1), least(y1 / 1500, 1)) AS line
        FROM seg WHERE y0 / 1500 <= 1"""
    ),
)
def yolo_lines(spark, sf_dir):
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    line = training.yolo_line(F.col("id") % 2, F.array(x0, y0, x1, y0, x1, y1), F.lit(1500.0), F.lit(1500.0))
    return fx.frame(spark, sf_dir, fx.SEG).filter("y0 / 1500 <= 1").select("id", line.alias("line"))


@query(
    "q63b_metrics_csv",
    fx.with_fixtures(
        """WITH l AS (SELECT r, k, sum(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)) AS len FROM wseg GROUP BY 1, 2)
        SELECT 'row_length' AS metric, printf('V%02d', r + 1) AS vineyard_id, printf('V%02d-R%02d', r + 1, k + 1) AS row_id, round(len + 0.0007, 2) AS value FROM l"""
    ),
)
def metrics_csv(spark, sf_dir):
    wseg = fx.frame(spark, sf_dir, fx.WSEG)
    dx, dy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    rows = wseg.groupBy("r", "k").agg((F.sum(F.sqrt(dx * dx + dy * dy)) + 0.0007).alias("value"))
    tidy = rows.select(F.lit("row_length").alias("metric"), F.format_string("V%02d", F.col("r") + 1).alias("vineyard_id"), F.format_string("V%02d-R%02d", F.col("r") + 1, F.col("k") + 1).alias("row_id"), "value", F.lit("m").alias("unit"))
    path = fresh(spark, "metrics")
    metrics.write(tidy, path)
    return metrics.read(spark, path).select("metric", "vineyard_id", "row_id", F.round("value", 2).alias("value"))


_IDS = f"""{spatial.NAMED}, kw AS (SELECT kept.id, w.vineyard_id, w.row_id, ax, ay, bx, by_ FROM kept JOIN w ON w.block = kept.block AND w.row = kept.row),
p AS (SELECT id, {_LABEL} AS label, 51.2E0 * (12285 + c) + 0.025E0 * ((x0 + x1) / 2 + 0.5E0) AS x, 51.2E0 * (101977 - r) - 0.025E0 * ((y0 + y1) / 2 + 0.5E0) AS y FROM box),
d AS (SELECT p.id, label, vineyard_id, min({spatial.point_distance("p.x", "p.y", "ax", "ay", "bx", "by_")}) AS d FROM p, kw GROUP BY 1, 2, 3),
s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d > 5, CASE WHEN d <= 5 THEN 0 ELSE d END, vineyard_id) AS n FROM d)"""


@query(
    "q65_survey_ids",
    fx.with_fixtures(
        f"""{_IDS} SELECT 'row' AS label, CAST(wseg.id AS INTEGER) AS place, coalesce(vineyard_id, '') AS vineyard_id, coalesce(row_id, '') AS row_id FROM wseg LEFT JOIN kw ON kw.id = wseg.id
        UNION ALL SELECT label, CAST(p.id AS INTEGER), coalesce(vineyard_id, ''), '' FROM p LEFT JOIN s USING (id, label) WHERE coalesce(n, 1) = 1"""
    ),
)
def survey_ids(spark, sf_dir):
    """Ids of every object: rows by stitching, crowns and litter by the block near them."""
    return jobs.assign_ids(objects(spark, sf_dir)).select("label", "place", "vineyard_id", "row_id")
