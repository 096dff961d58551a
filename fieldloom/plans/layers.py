"""Queries of layer files, label points, matching in order, and nearness in degrees."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.operators import evaluate, graph, raster, spatial
from fieldloom.sources import geojson, tiles, training

from . import fixtures as fx
from .catalogue import query
from .files import fresh
from .geometry import ends, lonlat_sql
from .routes import _EDGES, cells, compact_graph_parts


@query(
    "q69_route_targets",
    fx.with_fixtures(
        """SELECT printf('T%d', id) AS id, CASE WHEN id % 3 = 0 THEN 'waste' ELSE 'inspection' END AS kind, printf('V%02d', r + 1) AS vineyard_id, round(ax, 4) AS x, round(ay, 4) AS y, CAST(0 AS BIGINT) AS elsewhere FROM wseg"""
    ),
)
def route_targets(spark, sf_dir):
    """A target file written and read, whose nameless kinds are waste, beside a file that is not there."""
    wseg = fx.frame(spark, sf_dir, fx.WSEG)
    kind = F.when(F.col("id") % 3 != 0, "inspection")
    properties = {"id": F.format_string("T%d", "id"), "kind": kind, "vineyard_id": F.format_string("V%02d", F.col("r") + 1)}
    path = fresh(spark, "targets")
    geojson.write_collection(wseg.select("id", geojson.feature(F.lit("Point"), F.array(F.array(F.array(g.point(F.col("ax"), F.col("ay"))))), properties, 4).alias("feature")), path, ["id"])
    missing = geojson.read_targets(spark, fresh(spark, "nowhere")).count()
    return geojson.read_targets(spark, path).select("id", "kind", "vineyard_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.lit(missing).cast("long").alias("elsewhere"))


@query(
    "q69b_layer_in_degrees",
    fx.with_fixtures(
        f"""SELECT id, CASE WHEN id % 5 <> 0 THEN round(lon, 8) END AS lon, CASE WHEN id % 5 <> 0 THEN round(lat, 8) END AS lat, CASE WHEN id % 5 <> 0 THEN CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END END AS vertices
        FROM (SELECT id, {lonlat_sql("x", "y")[0]} AS lon, {lonlat_sql("x", "y")[1]} AS lat FROM (SELECT id, CASE WHEN id % 3 = 1 THEN bx ELSE ax END AS x, CASE WHEN id % 3 = 1 THEN by_ ELSE ay END AS y FROM wseg) p) q"""
    ),
)
def layer_in_degrees(spark, sf_dir):
    """Points, lines and polygons as coordinate texts of their own depth, in degrees; null geometries stay null."""
    wseg = fx.frame(spark, sf_dir, fx.WSEG)
    a, b, c = (F.array(F.col(x), F.col(y)) for x, y in (("ax", "ay"), ("bx", "by_"), ("ax", "by_")))
    kind = F.when(F.col("id") % 3 == 0, "Point").when(F.col("id") % 3 == 1, "LineString").otherwise("Polygon")
    text = F.when(F.col("id") % 3 == 0, F.to_json(a)).when(F.col("id") % 3 == 1, F.to_json(F.array(a, b))).otherwise(F.to_json(F.array(F.array(a, b, c, a))))
    layer = wseg.select("id", kind.alias("kind"), F.when(F.col("id") % 5 != 0, text).alias("coordinates"))
    shown = layer.select("id", geojson.reproject(geojson.geometry(F.col("kind"), F.col("coordinates")))[0][0].alias("p"))
    last = F.element_at("p", -1)
    return shown.select("id", F.round(last["x"], 8).alias("lon"), F.round(last["y"], 8).alias("lat"), F.when(F.col("p").isNotNull(), F.size("p")).alias("vertices"))


@query(
    "q69c_mercator",
    fx.with_fixtures(
        f"""SELECT id, round(6378137.0::DOUBLE * radians(lon), 4) AS x, round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2)), 4) AS y FROM (SELECT id, {lonlat_sql("ax", "ay")[0]} AS lon, {lonlat_sql("ax", "ay")[1]} AS lat FROM wseg) p"""
    ),
)
def mercator(spark, sf_dir):
    x, y = g.transformer(32635, 3857)(F.col("ax"), F.col("ay"))
    return fx.frame(spark, sf_dir, fx.WSEG).select("id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query(
    "q69d_route_features",
    fx.with_fixtures("SELECT printf('route %d', id) AS name, 'LineString' AS geom_type, round(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) + 0.0013, 2) AS length_m, round(bx, 4) AS end_x FROM wseg"),
)
def route_features(spark, sf_dir):
    """Routes with name and length, written and read."""
    wseg, path = fx.frame(spark, sf_dir, fx.WSEG), fresh(spark, "routes")
    length = g.polyline_length(ends()) + 0.0013
    geojson.write_collection(wseg.select("id", geojson.route_feature(ends(), F.format_string("route %d", "id"), length, 4).alias("feature")), path, ["id"], "urn:ogc:def:crs:EPSG::32635")
    read = geojson.read(spark, path)
    line = geojson.geometry(F.col("geom_type"), F.col("coordinates"))[0][0]
    return read.select("name", "geom_type", F.round("length_m", 2).alias("length_m"), F.round(F.element_at(line, -1)["x"], 4).alias("end_x"))


@query(
    "q70_label_points",
    fx.with_fixtures("SELECT id, round((3 * x0 + 2 * x1) / 5, 6) AS mean_x, round((3 * y0 + 2 * y1) / 5, 6) AS mean_y, x1 AS middle_x, y0 AS half_y FROM box WHERE id % 2 = 1 OR status <> 'P'"),
)
def label_points(spark, sf_dir):
    """Label points: the mean of a closed ring's listed vertices, and the vertex in the middle of a line's list."""
    box = fx.frame(spark, sf_dir, fx.BOX).filter("id % 2 = 1 OR status <> 'P'")
    mean = g.vertex_mean(g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    line = lambda *p: g.middle_vertex(F.array(*[g.point(F.col(x), F.col(y)) for x, y in p]))
    three, four = line(("x0", "y0"), ("x1", "y1"), ("x0", "y1")), line(("x0", "y1"), ("x1", "y1"), ("x1", "y0"), ("x0", "y0"))
    return box.select("id", F.round(mean["x"], 6).alias("mean_x"), F.round(mean["y"], 6).alias("mean_y"), three["x"].alias("middle_x"), four["y"].alias("half_y"))


_PLACES = "SELECT o_orderkey AS id, 27 + CAST((o_orderkey * 7919) % 100003 AS DOUBLE) / 1000003 AS x, 47 + CAST((o_orderkey * 104729) % 99991 AS DOUBLE) / 1000033 AS y FROM {orders}"
_STOPS = "SELECT s_suppkey AS node, 27 + CAST((s_suppkey * s_suppkey * 31 + s_suppkey * 17) % 99989 AS DOUBLE) / 999983 AS x, 47 + CAST((s_suppkey * s_suppkey * 53 + s_suppkey * 29) % 99971 AS DOUBLE) / 999979 AS y FROM {supplier}"


@query(
    "q71_nearest_in_degrees",
    fx.with_fixtures(
        "SELECT places.id, arg_min(node, (((stops.x - places.x) * 0.68) ** 2 + (stops.y - places.y) ** 2, node)) AS node, round(sqrt(min(((stops.x - places.x) * 0.68) ** 2 + (stops.y - places.y) ** 2)), 9) AS d FROM places, stops GROUP BY places.id",
        places=_PLACES,
        stops=_STOPS,
    ),
)
def nearest_in_degrees(spark, sf_dir):
    """The nearest stop where a degree of longitude is 0.68 of one of latitude."""
    return spatial.nearest(fx.frame(spark, sf_dir, _PLACES), fx.frame(spark, sf_dir, _STOPS), 0.01, 0.68).withColumn("d", F.round("d", 9))


@query("q72_data_extent", fx.with_fixtures("SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM box WHERE r = 1 AND status <> 'P'"))
def data_extent(spark, sf_dir):
    """The bounds of a layer's features that a predicate chooses."""
    return tiles.data_extent(fx.frame(spark, sf_dir, fx.BOX).filter("r = 1 AND status <> 'P'"))


@query(
    "q73_mask_iou",
    fx.with_fixtures(
        """WITH a AS (SELECT tile, CAST(y // 8 * 8 + x // 8 AS INTEGER) AS pred, x, y FROM px WHERE g > 60), b AS (SELECT tile, CAST((y + 3) // 8 * 16 + (x + 2) // 8 AS INTEGER) AS ref, x, y FROM px WHERE r > 60),
        m AS (SELECT tile, pred, ref, count(*) AS both_ FROM a JOIN b USING (tile, x, y) GROUP BY 1, 2, 3), na AS (SELECT tile, pred, count(*) AS n FROM a GROUP BY 1, 2), nb AS (SELECT tile, ref, count(*) AS n FROM b GROUP BY 1, 2)
        SELECT tile, pred, ref, round(both_ * 1.0::DOUBLE / (na.n + nb.n - both_), 6) AS iou FROM m JOIN na USING (tile, pred) JOIN nb USING (tile, ref)"""
    ),
)
def mask_iou(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX)
    mask = lambda where, i: p.filter(where).select("tile", i.cast("int").alias("id"), "x", "y")
    preds = mask("g > 60", F.floor(F.col("y") / 8) * 8 + F.floor(F.col("x") / 8))
    refs = mask("r > 60", F.floor((F.col("y") + 3) / 8) * 16 + F.floor((F.col("x") + 2) / 8))
    return evaluate.mask_ious(preds, refs).withColumn("iou", F.round("iou", 6))


@query(
    "q74_guarded_cut",
    fx.with_fixtures("SELECT 'aside' AS cut, true AS held, node FROM cells WHERE NOT (x * 2 > 5 AND x * 2 < 13 AND y * 2 > 3 AND y * 2 < 9) UNION ALL SELECT 'whole', false, node FROM cells"),
)
def guarded_cut(spark, sf_dir):
    """A cut beside the start holds; one that would leave nothing near it does not."""
    nodes = cells(spark, sf_dir).select("node", (F.col("x") * 2.0).alias("x"), (F.col("y") * 2.0).alias("y"))
    ring = lambda x0, y0, x1, y1: spark.range(1).select(F.array(g.box_ring(*[F.lit(float(v)) for v in (x0, y0, x1, y1)])).alias("rings"))
    out = None
    for name, box in (("aside", (5, 3, 13, 9)), ("whole", (-5, -5, 90, 90))):
        left, held = graph.guarded_cut((2.0, 0.0), nodes, ring(*box))
        one = left.select(F.lit(name).alias("cut"), F.lit(held).alias("held"), "node")
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "q75_merged_lines",
    fx.with_fixtures("SELECT id AS tile, CASE WHEN id % 150 <= 90 AND id % 5 <= 2 THEN 1 ELSE 2 END AS n, CASE WHEN id % 150 <= 90 AND id % 5 <= 2 THEN 200.0::DOUBLE + id % 150 ELSE 100.0::DOUBLE END AS reach FROM seg"),
)
def merged_lines(spark, sf_dir):
    """Two lines a tile, the second behind a gap of up to 149 pixels and turned by up to 22 degrees: those join that are within
    90 pixels and 12 degrees."""
    seg, at = fx.frame(spark, sf_dir, fx.SEG).withColumn("gap", (F.col("id") % 150).cast("double")), lambda x, y: g.point(x, y)
    first = F.array(at(F.lit(0.0), F.lit(0.0)), at(F.lit(100.0), F.lit(0.0)))
    second = F.array(at(100 + F.col("gap"), F.lit(0.0)), at(200 + F.col("gap"), (F.col("id") % 5) * 10.0))
    lines = seg.select(F.col("id").alias("tile"), F.posexplode(F.array(first, second)).alias("row", "points"))
    merged = raster.merged_lines(lines)
    return merged.groupBy("tile").agg(F.count("*").alias("n"), F.max(F.when(F.col("row") == 0, F.element_at("points", -1)["x"])).alias("reach")).withColumn("n", F.col("n").cast("int"))


@query(
    "q76_distinct_crowns",
    fx.with_fixtures("WITH d AS (SELECT id AS tile, id % 31 AS a, id % 23 AS b FROM seg) SELECT tile, CAST(1 + CAST(a >= 15 AS INTEGER) + CAST(a + b >= 15 AND (a < 15 OR b >= 15) AS INTEGER) AS INTEGER) AS n FROM d"),
)
def distinct_crowns(spark, sf_dir):
    """Three crowns in a line: each stays if it is 15 pixels from those kept before it."""
    seg = fx.frame(spark, sf_dir, fx.SEG)
    box = lambda x: F.slice(g.box_ring(x - 2.0, F.lit(-2.0), x + 2.0, F.lit(2.0)), 1, 4)
    a, b = (F.col("id") % 31).cast("double"), (F.col("id") % 23).cast("double")
    crowns = seg.select(F.col("id").alias("tile"), F.posexplode(F.array(box(F.lit(0.0)), box(a), box(a + b))).alias("crown", "ring"))
    return raster.distinct_crowns(crowns).groupBy("tile").agg(F.count("*").cast("int").alias("n"))


@query(
    "q77_nav_graph_file",
    fx.with_fixtures(
        f"""WITH {_EDGES}, kept AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS idx FROM cells WHERE node % 5 <> 2),
        e AS (SELECT a.idx AS i, b.idx AS j, round(w, 3) AS w FROM edges JOIN kept a ON src = a.node JOIN kept b ON dst = b.node), both_ AS (SELECT i, j, w FROM e UNION ALL SELECT j, i, w FROM e)
        SELECT i AS src, CAST(count(*) AS INTEGER) AS degree, min(j) AS first, round(sum(w), 3) AS w FROM both_ GROUP BY i"""
    ),
)
def nav_graph_file(spark, sf_dir):
    """A navigation graph written and read back as neighbours in both directions."""
    nodes, edges = compact_graph_parts(spark, sf_dir)
    path = fresh(spark, "graph")
    geojson.write_graph(nodes, edges, (27.0, 47.0), 0, path)
    read = geojson.adjacency(geojson.read_graph(spark, path)[1])
    n = F.col("neighbours")
    return read.select("src", F.size(n).alias("degree"), n[0]["dst"].alias("first"), F.round(g.total(F.transform(n, lambda e: e["w"])), 3).alias("w"))


@query(
    "q78_training_labels",
    fx.with_fixtures(
        """WITH k AS (SELECT CAST(id % 25 AS INTEGER) AS image, printf('%d %.6f %.6f %.6f %.6f %.6f %.6f', id % 4, x0 / 2048, y0 / 2048, least(x1 / 2048, 1), y0 / 2048, least(x1 / 2048, 1), least((y1 + 10) / 2048, 1)) AS line FROM seg WHERE id % 4 < 2 AND id % 11 > 1)
        SELECT CASE WHEN image % 3 = 2 THEN 'val' ELSE 'train' END AS split, printf('img%02d.jpg', image) AS file_name, md5(string_agg(line, chr(10) ORDER BY line)) AS text_md5 FROM k GROUP BY image"""
    ),
)
def training_labels(spark, sf_dir):
    """A COCO file written, read and turned into label files by split; masks by run length, other classes and lines are left out."""
    seg = fx.frame(spark, sf_dir, fx.SEG)
    flat = lambda *names: F.to_json(F.array(F.array(*[F.col(c) if isinstance(c, str) else c for c in names])))
    y1 = F.col("y1") + 10
    shape = F.when(F.col("id") % 11 == 0, '{"counts":[1,2],"size":[3,4]}').when(F.col("id") % 11 == 1, flat("x0", "y0", "x1", "y0")).otherwise(flat("x0", "y0", "x1", "y0", "x1", y1))
    annotation = F.concat(F.format_string('{"category_id":%d,"image_id":%d,"segmentation":', F.col("id") % 4, F.col("id") % 25), shape, F.lit("}"))
    images = ",".join(f'{{"id":{i},"file_name":"img{i:02d}.jpg","width":2048,"height":2048}}' for i in range(25))
    categories = ",".join(f'{{"id":{i},"name":"{n}"}}' for i, n in enumerate(("trunk", "vine_row", "post", "vine")))
    # The first line holds no comma in front of it, as it opens the list with a null.
    fixed = spark.createDataFrame([(-1, f'{{"images":[{images}],"categories":[{categories}],"annotations":[null'), (1 << 60, "]}")], "place long, line string")
    path = fresh(spark, "coco")
    fixed.unionAll(seg.select("id", F.concat(F.lit(","), annotation))).coalesce(1).sortWithinPartitions("place").select("line").write.text(path)
    files = training.label_files(session.written(training.read_coco(spark, path), "coco-read"))
    source = F.substring("file_name", 4, 2).cast("int") % 3
    split = training.split_of(F.when(source == 0, "train").when(source == 1, "valid").otherwise("test"))
    return files.select(split.alias("split"), "file_name", F.md5("text").alias("text_md5"))
