"""Whole jobs: from detections to identities, measurements, files and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.functions.text import tile_col, tile_row
from fieldloom.operators import graph, measure, polygons, raster, rows, spatial, stitching
from fieldloom.operators.sequences import consecutive_pairs
from fieldloom.sources import cvat, geojson, images, metrics, tiles


def placed(objects: DataFrame) -> DataFrame:
    """Objects of tiles whose names give a grid place, with world points; others are skipped."""
    here = objects.withColumns({"r": tile_row(F.col("tile")), "c": tile_col(F.col("tile"))}).filter("r IS NOT NULL AND c IS NOT NULL")
    return here.withColumn("world", g.pixel_to_world(F.col("points"), F.col("r"), F.col("c")))


def row_segments(objects: DataFrame) -> DataFrame:
    """Rows as segments between their first and last points: (id, tile, place, ax, ay, bx, by_)."""
    rows = placed(objects).filter((F.col("label") == "row") & (F.size("points") >= 2))
    a, b = F.element_at("world", 1), F.element_at("world", -1)
    return rows.select(
        F.xxhash64("tile", "place").alias("id"), "tile", "place", a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by_")
    )


def assign_ids(objects: DataFrame, reach: float = 5.0) -> DataFrame:
    """Objects with global ids: rows by stitching, crowns and litter by the block that is near. Rows of pruned blocks go
    back to no id."""
    segments = session.written(row_segments(objects), "segments")
    named = session.written(stitching.stitch(segments, reach), "named")
    ids = segments.select("id", "tile", "place").join(named.select("id", F.col("vineyard_id").alias("_v"), F.col("row_id").alias("_w")), "id").drop("id")
    rows = objects.filter("label = 'row'").join(ids, ["tile", "place"], "left").withColumns({"vineyard_id": F.coalesce("_v", F.lit("")), "row_id": F.coalesce("_w", F.lit(""))}).drop("_v", "_w")
    blocks = segments.join(named, "id").select(F.col("vineyard_id").alias("block"), F.col("vineyard_id").alias("ord"), *spatial.ENDS)
    # Written step by step: each use of a column would else work out all of the nested points behind it again.
    others = session.written(placed(objects.filter("label <> 'row'")).withColumn("id", F.xxhash64("tile", "label", "place")), "others")
    middle = session.written(others.select("id", g.vertex_mean(F.col("world")).alias("m")), "middles")
    near = spatial.assign_blocks(middle.select("id", "m.x", "m.y"), blocks, reach).select("id", F.col("block").alias("_v"))
    rest = others.join(near, "id", "left").withColumn("vineyard_id", F.coalesce("_v", F.lit(""))).select(*objects.columns)
    return rows.select(*objects.columns).unionByName(rest)


def derive_interrow(objects: DataFrame, pixels: DataFrame | None = None, least: float = 200.0, least_green: float = 20.0, least_pixels: int = 50) -> DataFrame:
    """Strips between neighbouring rows of a block within a tile, less the crowns in them, in parts: (tile, vineyard_id,
    id, part, area in square pixels, ring, interrow_cover). Rows are ordered across their median direction. The cover
    follows from the green share of the pixels (tile, x, y, r, g, b) in a part; without pixels it is null, and where
    pixels are given, tiles that have none give no parts."""
    rows = objects.filter("label = 'row' AND size(points) >= 2")
    a, b = F.element_at("points", 1), F.element_at("points", -1)
    rows = rows.withColumn("_a", g.undirected_angle(b["x"] - a["x"], b["y"] - a["y"]))
    main = rows.groupBy("tile", "vineyard_id").agg(F.median("_a").alias("_m"))
    mean = g.vertex_mean(F.col("points"))
    # All rows run the same way, so that no strip crosses itself.
    t = lambda p: g.along(p["x"], p["y"], F.col("_m"))
    keyed = rows.join(main, ["tile", "vineyard_id"]).withColumns(
        {"_s": g.across(mean["x"], mean["y"], F.col("_m")), "points": F.when(t(F.element_at("points", 1)) <= t(F.element_at("points", -1)), F.col("points")).otherwise(F.reverse("points"))}
    )
    pairs = consecutive_pairs(keyed.drop("place"), ["tile", "vineyard_id"], ["_s"], ["points"])
    strips = pairs.select("tile", "vineyard_id", F.col("place").cast("int").alias("id"), g.strip_ring(F.col("points"), F.col("next_points")).alias("strip"))
    crowns = objects.filter("label = 'vineyard'").select("tile", "vineyard_id", F.col("points").alias("ring"))
    parts = polygons.open_parts(strips, ["tile", "vineyard_id"], "strip", crowns, least=least)
    if pixels is None:
        return parts.withColumn("interrow_cover", F.lit(None).cast("string"))
    parts = session.written(parts, "parts")
    named = parts.withColumn("_id", F.xxhash64("vineyard_id", "id", "part"))
    shares = raster.ring_shares(named.select("tile", F.col("_id").alias("id"), "ring"), pixels, least_green)
    shares = shares.select("tile", F.col("id").alias("_id"), measure.cover_class(F.col("share"), F.col("n"), least_pixels).alias("interrow_cover"))
    return named.join(shares, ["tile", "_id"]).drop("_id")


def with_interrow(objects: DataFrame, pixels: DataFrame | None = None) -> DataFrame:
    """Objects with the derived strips in place of those annotated."""
    parts = derive_interrow(objects, pixels)
    sizes = objects.groupBy("tile").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    order = F.row_number().over(Window.partitionBy("tile").orderBy("vineyard_id", "id", "part")) - 1
    kinds = {c: objects.schema[c].dataType for c in objects.columns}
    values = {"label": F.lit("interrow_area"), "place": order, "points": F.col("ring"), "row_id": F.lit(""), "row_structure": F.lit(None)}
    derived = parts.join(sizes, "tile").select(*[values.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in objects.columns])
    return objects.filter("label <> 'interrow_area'").unionByName(derived)


def detect_objects(pixels: DataFrame, width: int, height: int, spacing: float, quantile: float = 0.87, floor: float = 15.0, gate: bool = True, **limits) -> DataFrame:
    """Objects (tile, width, height, label, place, points and empty ids) from the pixels (tile, x, y, r, g, b) of tiles: crowns
    of the green mask, and the rows that it runs in."""
    crowns = raster.segment_crowns(pixels, width, height, quantile, floor, gate, **limits).select("tile", F.lit("vineyard").alias("label"), F.col("crown").alias("place"), F.col("ring").alias("points"))
    mask = raster.green_mask(pixels, width, height, quantile, floor, gate).select("tile", "x", "y")
    at = lambda t: g.point(F.col(t) * F.cos("angle") - F.col("s") * F.sin("angle"), F.col(t) * F.sin("angle") + F.col("s") * F.cos("angle"))
    lines = rows.detect_rows(mask, spacing).select("tile", F.lit("row").alias("label"), F.col("row").alias("place"), F.array(at("t0"), at("t1")).alias("points"))
    found = lines.unionByName(crowns)
    inside = g.clamp_points(F.col("points"), F.lit(float(width)), F.lit(float(height)))
    structure = F.when(F.col("label") == "row", "regular")
    nothing = F.lit("")
    return found.select("tile", F.lit(width).alias("width"), F.lit(height).alias("height"), "label", "place", inside.alias("points"), nothing.alias("vineyard_id"), nothing.alias("row_id"), structure.alias("row_structure"), F.lit(None).cast("string").alias("interrow_cover"))


def survey_from_tiles(spark: SparkSession, folder: str, out: str, width: int, height: int, spacing: float, **limits) -> DataFrame:
    """From a folder of tiles to identities, files and metrics; returns the metrics."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    pixels = session.written(images.read_pixels(spark, folder).withColumn("tile", name).drop("path"), "pixels")
    objects = session.written(detect_objects(pixels, width, height, spacing, **limits), "detected")
    return run_survey(objects, out, pixels)




def measurements(objects: DataFrame) -> DataFrame:
    """The tidy metric table of annotated objects."""
    here = placed(objects)
    rows = here.filter("label = 'row' AND size(points) >= 2").select("vineyard_id", "row_id", g.polyline_length(F.col("world")).alias("length"))
    strips = here.filter("label = 'interrow_area' AND size(points) >= 3").select("vineyard_id", g.ring_area(F.col("world")).alias("area"))
    # Crowns overlap only within a tile and block, so the union is split by tile before its areas are added up.
    tiled = here.filter("label = 'vineyard' AND size(points) >= 3").select("tile", "vineyard_id", F.col("world").alias("ring"))
    canopy = polygons.union_areas(tiled, ["tile", "vineyard_id"]).select("vineyard_id", "area")
    return measure.measurement_rollup(rows, canopy, strips)


def run_survey(objects: DataFrame, out: str, pixels: DataFrame | None = None) -> DataFrame:
    """Ids, strips between rows, annotation file and metric table of a survey's detections; returns the metrics."""
    named = session.written(assign_ids(objects), "named-objects")
    named = session.written(with_interrow(named, pixels), "objects")
    cvat.write(named, f"{out}/annotations")
    found = session.written(measurements(named), "metrics")
    metrics.write(found, f"{out}/measurements")
    return found


def closed(label: Column, points: Column) -> Column:
    box = g.box_ring(points[0]["x"], points[0]["y"], points[1]["x"], points[1]["y"])
    return F.when(label == "waste", box).when(label == "row", points).otherwise(g.close_ring(points))


#: The layers of a web export with their properties.
LAYERS = {
    "canopy": ("vineyard", "Polygon", ("vineyard_id", "tile")),
    "rows": ("row", "LineString", ("vineyard_id", "row_id", "row_structure", "tile")),
    "interrow": ("interrow_area", "Polygon", ("vineyard_id", "interrow_cover", "tile")),
    "waste": ("waste", "Polygon", ("vineyard_id", "tile")),
}


def web_features(objects: DataFrame) -> DataFrame:
    """(layer, tile, place, feature): every object in longitude and latitude as a GeoJSON feature of its layer."""
    ring = closed(F.col("label"), F.col("points"))
    world = g.points_to_lonlat(g.pixel_to_world(ring, F.col("r"), F.col("c")))
    here = placed(objects).select("*", F.array(F.array(world)).alias("parts"))
    out = None
    for layer, (label, kind, names) in LAYERS.items():
        properties = {n: F.coalesce(F.col(n), F.lit("regular" if n == "row_structure" else "")) for n in names}
        some = here.filter(F.col("label") == label).select(F.lit(layer).alias("layer"), "tile", "place", geojson.feature(F.lit(kind), F.col("parts"), properties).alias("feature"))
        out = some if out is None else out.unionAll(some)
    return out


def export_web(objects: DataFrame, out: str, context: list[str] = ()) -> None:
    """The four layers, the metrics and the context layers that are there, reprojected."""
    features = session.written(web_features(objects), "features")
    for layer in LAYERS:
        geojson.write_collection(features.filter(F.col("layer") == layer), f"{out}/{layer}", ["tile", "place"])
    metrics.write(measurements(objects), f"{out}/measurements")
    spark = objects.sparkSession
    for path in context:
        if geojson.exists(spark, path):
            layer = geojson.read(spark, path, ordered=True)
            parts = geojson.reproject(geojson.geometry(F.col("geom_type"), F.col("coordinates")))
            name = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".geojson")
            shown = layer.select("place", geojson.feature(F.col("geom_type"), parts, {"name": F.coalesce("name", F.lit(""))}).alias("feature"))
            geojson.write_collection(shown, f"{out}/{name}", ["place"])


def inspection_targets(lines: DataFrame, waste: DataFrame) -> DataFrame:
    """(id, kind, x, y): the middle vertex of every disrupted row and the vertex mean of every litter ring."""
    m, w = g.middle_vertex(F.col("points")), g.vertex_mean(F.col("points"))
    a = lines.filter("row_structure = 'disrupted'").select(F.col("row_id").alias("id"), F.lit("inspection").alias("kind"), m["x"].alias("x"), m["y"].alias("y"))
    return a.unionAll(waste.select("id", F.lit("waste").alias("kind"), w["x"].alias("x"), w["y"].alias("y")))


def gated(routes: DataFrame, start: tuple[float, float], area: DataFrame, cut: DataFrame | None) -> DataFrame:
    """Routes with their share of length inside the walkable area, the greater distance of their ends from the start, and
    whether both pass. Only the ways from and to the start itself may leave the area."""
    points = routes.select("persona", F.from_json("points", "array<array<double>>").alias("p"))
    ends = points.select("persona", *[F.sqrt(F.pow(e[0] - start[0], 2) + F.pow(e[1] - start[1], 2)).alias(n) for n, e in (("_a", F.element_at("p", 1)), ("_b", F.element_at("p", -1)))])
    legs = points.select("persona", F.posexplode(F.zip_with(F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1), lambda a, b: F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by_")))).alias("leg", "s"))
    legs = session.written(legs.select("persona", "leg", "s.*"), "legs")
    inside = graph.covered_segments(legs, ["persona", "leg"], area, cut)
    length = F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by_"), 2))
    judged = legs.withColumn("length", length).join(inside, ["persona", "leg"]).join(ends, "persona").select("persona", "length", F.col("covered").alias("inside"), F.greatest("_a", "_b").alias("gap"))
    return routes.join(graph.gates(judged, ["persona"], F.col("gap")), "persona", "left")


def plan_survey_routes(spark: SparkSession, passages: str, start: tuple[float, float], targets: str | None, out: str, forbidden: str | None = None, step: float = 2.0) -> DataFrame:
    """Both personas' routes over the lattice within the passages and out of what is forbidden, written as GeoJSON, with how
    much of each lies inside (inside_share, end_gap, passed); without a target file, mock ones. What is forbidden counts
    for nothing where it would leave no node near the start."""
    rings = lambda path: geojson.read(spark, path).select(F.explode(geojson.geometry(F.col("geom_type"), F.col("coordinates"))).alias("rings"))
    area = session.written(rings(passages), "passages")
    box = area.select(g.bbox(F.element_at("rings", 1)).alias("b")).agg(*[f(f"b.{c}").alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    nodes = session.written(graph.walkable_nodes(graph.lattice_points(spark, box.first(), step), area), "all-nodes")
    cut = session.written(rings(forbidden), "forbidden") if forbidden and geojson.exists(spark, forbidden) else None
    if cut is not None:
        nodes, holds = graph.guarded_cut(start, nodes, cut, 2 * step)
        cut = cut if holds else None
    nodes = session.written(nodes, "nodes")
    near = graph.grid_edges(nodes.select("node", F.col("col").alias("x"), F.col("row").alias("y")), step)
    edges = session.written(graph.covered_edges(near, nodes, area, cut), "edges")
    home = spatial.nearest(spark.createDataFrame([(0, *start)], "id long, x double, y double"), nodes, 2 * step).first()
    reached = session.written(graph.component_of(nodes, edges, home.node), "component")
    kept = edges.join(reached.select(F.col("node").alias("src")), "src", "left_semi")
    wanted = geojson.read_targets(spark, targets) if targets else graph.mock_targets(reached, home.node)
    routes = session.written(graph.plan_routes(reached, kept, start, graph.persona_targets(wanted), 2 * step), "routes")
    line = F.transform(F.from_json("points", "array<array<double>>"), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    routes = session.written(gated(routes, start, area, cut), "gated")
    for persona in ("inspector", "farmer"):
        one = routes.filter(F.col("persona") == persona).select("persona", geojson.route_feature(line, F.col("persona"), F.col("length")).alias("feature"))
        geojson.write_collection(one, f"{out}/{persona}", ["persona"], "urn:ogc:def:crs:EPSG::32635")
    return routes


def export_route(routes: DataFrame, persona: str, out: str, source: int = 32635) -> None:
    """A persona's route as a GeoJSON line in longitude and latitude, with its length, and its points in order as CSV; no
    files where it has no length."""
    one = routes.filter((F.col("persona") == persona) & (F.col("length") > 0))
    if one.isEmpty():
        return
    to = g.transformer(source, 4326)
    points = one.select("persona", "length", F.from_json("points", "array<array<double>>").alias("p"))
    line = F.transform("p", lambda p: F.struct(to(p[0], p[1])[0].alias("x"), to(p[0], p[1])[1].alias("y")))
    placed = points.select("persona", "length", line.alias("line"))
    geojson.write_collection(placed.select("persona", geojson.route_feature(F.col("line"), F.col("persona"), F.col("length"), 7).alias("feature")), f"{out}/{persona}_route", ["persona"])
    # A route is one ordered file.
    table = placed.select(F.posexplode("line").alias("place", "q")).select("place", F.col("q.x").alias("longitude"), F.col("q.y").alias("latitude"))
    table.coalesce(1).sortWithinPartitions("place").write.mode("overwrite").option("header", "true").csv(f"{out}/{persona}_route_points")


def tile_report(objects: DataFrame, known: DataFrame) -> DataFrame:
    """Tiles that objects name and the tile list lacks."""
    return objects.select("tile").distinct().join(tiles.resolve(objects, known).select("tile").distinct(), "tile", "left_anti")
