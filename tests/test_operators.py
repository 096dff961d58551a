"""Kernels and operators that SQL cannot express, against plain loops and invariants."""

import itertools
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.functions import text
from fieldloom.operators import evaluate, graph, polygons, raster, sequences, spatial
from fieldloom.operators.components import connected_components
from fieldloom.plans import jobs
from fieldloom.sources import cvat, geojson, images, metrics, tiles, training


def ring(*points):
    return [tuple(map(float, p)) for p in points]


boxes = st.lists(st.tuples(*[st.integers(0, 9)] * 2, *[st.integers(1, 5)] * 2).map(lambda b: (b[0], b[1], b[0] + b[2], b[1] + b[3])), max_size=6)


@settings(max_examples=60, deadline=None)
@given(boxes, boxes)
def test_slab_areas_of_boxes(a, b):
    cells = lambda bs: {(x, y) for x0, y0, x1, y1 in bs for x in range(x0, x1) for y in range(y0, y1)}
    rings = lambda bs: [[ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))] for x0, y0, x1, y1 in bs]
    assert polygons.union_area(rings(a)) == pytest.approx(len(cells(a)))
    assert polygons.intersection_area(rings(a), rings(b)) == pytest.approx(len(cells(a) & cells(b)))
    parts = polygons.difference(rings(a), rings(b))
    assert sum(map(polygons.area_of, parts)) == pytest.approx(len(cells(a) - cells(b)))


def test_slab_areas_of_slanted_and_crossing_rings():
    triangle, other = ring((0, 0), (4, 0), (0, 4)), ring((4, 4), (4, 0), (0, 4))
    assert polygons.union_area([[triangle], [other]]) == pytest.approx(16)
    assert polygons.intersection_area([[triangle]], [[ring((0, 0), (2, 0), (2, 2), (0, 2))]]) == pytest.approx(4)
    assert polygons.union_area([[ring((0, 0), (2, 2), (2, 0), (0, 2))]]) == pytest.approx(2)  # a bow-tie, both lobes
    holed = [ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (2, 1), (2, 2), (1, 2))]
    assert polygons.union_area([holed]) == pytest.approx(15)
    strip = [[ring((0, 0), (9, 0), (9, 3), (0, 3))]]
    assert len(polygons.difference(strip, [[ring((4, -1), (5, -1), (5, 4), (4, 4))]])) == 2


def test_labels_morphology_and_distance():
    rng = np.random.default_rng(4)
    for _ in range(6):
        mask = rng.random((23, 31)) < 0.45
        labels, n = raster.label(mask)
        seen, groups = set(), 0
        for y, x in zip(*mask.nonzero()):
            if (y, x) in seen:
                continue
            groups += 1
            todo, blob = [(y, x)], set()
            while todo:
                v, u = todo.pop()
                if (v, u) in blob or not (0 <= v < 23 and 0 <= u < 31) or not mask[v, u]:
                    continue
                blob.add((v, u))
                todo += [(v + a, u + b) for a, b in itertools.product((-1, 0, 1), repeat=2)]
            assert len({labels[p] for p in blob}) == 1
            seen |= blob
        assert n == groups and ((labels > 0) == mask).all()
        d = raster.distance_transform(mask)
        holes = np.argwhere(~mask)
        want = [[min(math.dist((y, x), h) for h in holes) for x in range(31)] for y in range(23)]
        assert np.allclose(d, want)
        closed, opened = raster.closing(mask, raster.disc(2)), raster.opening(mask, raster.disc(1))
        assert (closed | ~mask).all() and (mask | ~opened).all()


def test_watershed_contour_and_rasters():
    mask = np.zeros((40, 60), bool)
    ys, xs = np.mgrid[0:40, 0:60]
    mask |= (xs - 18) ** 2 + (ys - 20) ** 2 <= 144
    mask |= (xs - 38) ** 2 + (ys - 20) ** 2 <= 144
    d = raster.distance_transform(mask)
    markers, n = raster.seeds(d, 6, 0.5)
    assert n == 2
    regions = raster.watershed(-d, markers, mask)
    assert ((regions > 0) == mask).all() and abs((regions == 1).sum() - (regions == 2).sum()) < 80
    blob = raster.remove_sizes(mask, least=10)
    outline = raster.contour(blob)
    assert (raster.ring_pixels([tuple(map(float, p)) for p in outline], 60, 40) == blob).all()
    assert len(raster.simplify_ring(outline, 0.01)) < len(outline)
    assert raster.contour(np.zeros((3, 3), bool)) == []
    assert raster.patches(2048, 2048)[-1] == (1408, 1408)
    assert raster.patches(100, 100) == [(0, 0)]
    found = raster.crowns(d, mask, least=50, radius=6, share=0.5)
    assert len(found) == 2


def test_simplify_and_merge():
    line = [(float(i), math.sin(i / 5)) for i in range(60)]
    kept = raster.simplify(line, 0.2)
    assert kept[0] == line[0] and kept[-1] == line[-1] and len(kept) < 30
    for p in line:
        d = min(polyline_distance(p, a, b) for a, b in zip(kept, kept[1:]))
        assert d <= 0.2 + 1e-9
    assert raster.simplify([(0, 0), (5, 5), (0, 0)], 1.0) == [(0, 0), (5, 5), (0, 0)]
    merged = raster.merge_collinear([[(0, 0), (100, 0)], [(150, 2), (300, 2)], [(0, 500), (100, 500)]])
    assert sorted(len(m) for m in merged) == [2, 2] and {m[-1][0] for m in merged} == {300, 100}
    assert raster.keep_apart([(0, 0), (10, 0), (20, 0), (21, 0)], 15) == [0, 2]
    assert sequences.separated([(0, 5.0), (3, 9.0), (30, 1.0)], 10) == [(3, 9.0), (30, 1.0)]


def polyline_distance(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.dist(p, (a[0] + t * dx, a[1] + t * dy))


def test_tour_is_closed_and_locally_best():
    rng = random.Random(8)
    spots = [(rng.random(), rng.random()) for _ in range(12)]
    d = np.array([[math.dist(a, b) for b in spots] for a in spots])
    out = graph.tour(d)
    assert out[0] == out[-1] == 0 and sorted(out[:-1]) == list(range(12))
    length = lambda t: sum(d[a, b] for a, b in zip(t, t[1:]))
    for i, j in itertools.combinations(range(1, 12), 2):
        assert length(out[:i] + out[i : j + 1][::-1] + out[j + 1 :]) >= length(out) - 1e-9
    assert graph.tour(np.zeros((1, 1))) == [0, 0]


def test_routes(spark):
    from fieldloom.plans import routes

    data = "/root/testdata/sf0.001"
    planned = graph.plan_routes(
        routes.metres(routes.cells(spark, data)), graph.grid_edges(routes.cells(spark, data), 2.0), (2.3, 0.2), graph.persona_targets(routes.targets(spark, data))
    ).collect()
    assert {r.persona for r in planned} == {"inspector", "farmer"}
    for r in planned:
        points = json.loads(r.points)
        assert r.closed and points[0] == points[-1] == [2.3, 0.2] and r.unreachable == 0
        steps = [math.dist(a, b) for a, b in zip(points, points[1:])]
        assert sum(steps) == pytest.approx(r.length)
        assert all(min(abs(s - 2), abs(s - 8**0.5)) < 1e-9 for s in steps[1:-1])


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(7, 7), (1000, 1001), (1001, 1002), (5000, 1000)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.label for r in connected_components(df).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(df.limit(0)).count() == 0


def test_spatial_joins_by_brute_force(spark):
    rng = random.Random(5)
    segs = [(i, x := rng.uniform(0, 200), y := rng.uniform(0, 200), x + rng.uniform(-30, 30), y + rng.uniform(-30, 30)) for i in range(120)]
    df = spark.createDataFrame(segs, "id long, ax double, ay double, bx double, by_ double")
    side = lambda p: {c: F.col(f"{p}{c}") for c in spatial.ENDS}
    left, right = df.toDF("a", *[f"l{c}" for c in spatial.ENDS]), df.toDF("b", *[f"r{c}" for c in spatial.ENDS])
    brute = left.join(right, F.col("a") < F.col("b")).withColumn("d", g.segment_distance(side("l"), side("r"))).filter("d <= 5")
    want = {(r.a, r.b): r.d for r in brute.collect()}
    found = spatial.segment_pairs(df, 5.0).collect()
    assert len(found) == len(want) and {(r.a, r.b): r.d for r in found} == pytest.approx(want)

    points = [(i, rng.uniform(-300, 500), rng.uniform(-300, 500)) for i in range(60)]
    nodes = [(i, rng.uniform(0, 200), rng.uniform(0, 200)) for i in range(50)]
    near = spatial.nearest(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(nodes, "node long, x double, y double"), 7.0)
    got = {r.id: r.node for r in near.collect()}
    assert got == {i: min(nodes, key=lambda n: (math.dist(n[1:], (x, y)), n[0]))[0] for i, x, y in points}
    assert spatial.nearest(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame([], "node long, x double, y double"), 7.0).count() == 0


def test_greedy_matching(spark):
    rng = random.Random(6)
    pairs = [(t, p, r, rng.choice([0.4, 0.5, 0.6, 0.8])) for t in range(3) for p in range(6) for r in range(6) if rng.random() < 0.5]
    got = sorted(map(tuple, evaluate.greedy_matches(spark.createDataFrame(pairs, "tile int, pred long, ref long, iou double"), "tile").collect()))
    want = []
    for t in range(3):
        taken = set()
        for p in range(6):
            best = None
            for r in range(6):
                iou = next((x[3] for x in pairs if x[:3] == (t, p, r)), 0)
                if r not in taken and iou >= 0.5 and (best is None or iou >= best[1]):
                    best = (r, iou)
            if best:
                taken.add(best[0])
                want.append((t, p, *best))
    assert got == sorted(want)


def test_geometry_edge_cases(spark):
    one = spark.range(1)
    empty = F.array().cast("array<struct<x:double,y:double>>")
    square = F.array(*[g.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0))])
    row = one.select(
        g.polyline_length(empty).alias("none"),
        g.ring_area(square).alias("area"),
        F.size(g.close_ring(square)).alias("closed"),
        F.size(g.close_ring(empty)).alias("open"),
        g.in_ring(F.lit(1.0), F.lit(1.0), square).alias("inside"),
        g.at_least(F.slice(square, 1, 2), 3).alias("short"),
        g.point_segment_distance(F.lit(3.0), F.lit(4.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("dot"),
        text.pretty_value(F.lit(None).cast("string")).alias("nothing"),
        F.size(text.parse_points(F.lit(""))).alias("unparsed"),
        text.pretty_tile(F.lit("photo.TIF")).alias("photo"),
    ).first()
    assert row.none == 0 and row.area == 4 and row.closed == 5 and row.open == 0 and row.inside and row.short is None
    assert row.dot == 5 and row.nothing is None and row.unparsed == 0 and row.photo == "photo"
    names = spark.createDataFrame([("V10",), ("V2",), ("V1",), ("V1-R10",), ("V1-R9",)], "n string")
    assert [r.n for r in names.orderBy(text.natural_key(F.col("n"))).collect()] == ["V1", "V1-R9", "V1-R10", "V2", "V10"]


def test_rollup_counts_the_empty_block_only_alone(spark):
    from fieldloom.operators.measure import measurement_rollup

    rows = spark.createDataFrame([("", "", 2.0), ("", "x", 3.0)], "vineyard_id string, row_id string, length double")
    areas = spark.createDataFrame([], "vineyard_id string, area double")
    got = {r.metric: r.value for r in measurement_rollup(rows, areas, areas).filter("vineyard_id = '' AND row_id = ''").collect()}
    assert got["block_count"] == 1 and got["row_count"] == 2 and got["total_row_length"] == 5 and got["total_canopy_area"] == 0
    named = rows.unionByName(spark.createDataFrame([("V01", "V01-R01", 1.0)], rows.schema))
    assert measurement_rollup(named, areas, areas).filter("metric = 'block_count'").first().value == 1


def test_files(spark, tmp_path):
    objects = spark.createDataFrame(
        [
            ("tile_r001_c002.tif", 2048, 2048, "row", 0, [(1.0, 2.0), (30.5, 4.25)], "V01", "V01-R01", "disrupted", None),
            ("tile_r001_c002.tif", 2048, 2048, "vineyard", 1, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)], "V<&>", "", None, None),
            ("tile_r000_c002.tif", 2048, 2048, "waste", 0, [(1.0, 1.0), (5.0, 6.0)], "", "", None, None),
        ],
        "tile string, width int, height int, label string, place int, points array<struct<x:double,y:double>>, vineyard_id string, row_id string, row_structure string, interrow_cover string",
    )
    cvat.write(objects, str(tmp_path / "cvat"))
    back = {(r.tile, r.label): r for r in cvat.read(spark, str(tmp_path / "cvat")).collect()}
    assert len(back) == 3 and back["tile_r001_c002.tif", "vineyard"].vineyard_id == "V<&>"
    row = back["tile_r001_c002.tif", "row"]
    assert [tuple(p) for p in row.points] == [(1.0, 2.0), (30.5, 4.25)] and row.row_structure == "disrupted" and row.row_id == "V01-R01"
    assert cvat.nested(objects).count() == 2

    jobs.export_web(objects, str(tmp_path / "web"))
    rows = geojson.read(spark, str(tmp_path / "web/rows")).collect()
    assert len(rows) == 1 and rows[0].geom_type == "LineString" and rows[0].row_id == "V01-R01"
    lon, lat = json.loads(rows[0].coordinates)[0]
    assert 28 < lon < 29.5 and 46 < lat < 48
    assert geojson.read(spark, str(tmp_path / "missing.geojson")).count() == 0
    table = metrics.read(spark, str(tmp_path / "web/measurements"))
    assert metrics.lookup(table, "row_count") == 1 and metrics.lookup(table, "nothing") is None

    nodes = spark.createDataFrame([(0, 1.5, 2.5), (1, 3.5, 4.5)], "idx int, x double, y double")
    edges = spark.createDataFrame([(0, 1, 2.828)], "i int, j int, w double")
    geojson.write_graph(nodes, edges, (1.0, 2.0), 0, str(tmp_path / "graph"))
    n, e = geojson.read_graph(spark, str(tmp_path / "graph"))
    assert sorted(map(tuple, n.collect())) == [(0, 1.5, 2.5), (1, 3.5, 4.5)] and [tuple(x) for x in e.collect()] == [(0, 1, 2.828)]
    assert geojson.adjacency(e).count() == 2


def test_targets_and_coco(spark, tmp_path):
    points = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"id": "a"}}, {"type": "Feature", "geometry": None, "properties": {"id": "b", "kind": "inspection"}}]}
    (tmp_path / "t.geojson").write_text(json.dumps(points))
    assert [tuple(r) for r in geojson.read_targets(spark, str(tmp_path / "t.geojson")).collect()] == [("a", "waste", None, None, 1.0, 2.0)]
    coco = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 20}],
        "categories": [{"id": 5, "name": "trunk"}, {"id": 6, "name": "leaf"}, {"id": 7, "name": "vine_row"}],
        "annotations": [
            {"category_id": 5, "image_id": 1, "segmentation": [[0, 0, 5, 0, 20, 10]]},
            {"category_id": 6, "image_id": 1, "segmentation": [[0, 0, 5, 0, 5, 10]]},
            {"category_id": 7, "image_id": 1, "segmentation": {"counts": "x", "size": [1, 2]}},
            {"category_id": 7, "image_id": 1, "segmentation": [[0, 0, 1, 1]]},
        ],
    }
    (tmp_path / "c.json").write_text(json.dumps(coco))
    objects = training.read_coco(spark, str(tmp_path / "c.json"))
    assert objects.count() == 2
    files = training.label_files(objects).collect()
    assert [(r.file_name, r.text) for r in files] == [("a.jpg", "0 0.000000 0.000000 0.500000 0.000000 1.000000 0.500000")]
    split = training.label_files(objects).withColumn("split", training.split_of(F.lit("valid")))
    training.write_labels(split, str(tmp_path / "yolo"))
    assert spark.read.text(str(tmp_path / "yolo")).first().split == "train" and "vine_row" in training.data_yaml("x")


def test_tiff_and_pyramid(spark, tmp_path):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (9, 7, 3), dtype=np.uint8)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/tile_r001_c002.tif").write_bytes(images.encode_tiff(a, 0.025, (629657.6, 5220195.2)))
    back, tags = images.decode_tiff((tmp_path / "sub/tile_r001_c002.tif").read_bytes())
    assert (back == a).all() and tags[33550][0] == 0.025
    pixels = images.read_pixels(spark, str(tmp_path))
    assert pixels.count() == 63 and pixels.filter("x = 6 AND y = 8").first().g == a[8, 6, 1]
    found = tiles.discover(spark, str(tmp_path))
    assert tiles.select_tiles(found, ["r001_c002"], 1, "tile_").first().stem == "tile_r001_c002"
    head = tiles.headers(spark.createDataFrame([("tile_r001_c002",)], "tile string")).first()
    assert head.r == 1 and head.c == 2 and head.c0 == pytest.approx(51.2 * 12287)
    some = pixels.select(F.lit(1).alias("z"), F.lit(0).alias("tx"), F.lit(0).alias("ty"), F.col("x").alias("px"), F.col("y").alias("py"), "r", "g", "b", "path")
    png = images.paint(some, 16).first().png
    assert bytes(png[:4]) == b"\x89PNG"
    assert images.paint(some.withColumns({"r": F.lit(0), "g": F.lit(0), "b": F.lit(0)}), 16).count() == 0
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 10.0)], "src string, x0 double, y0 double, x1 double, y1 double")
    # The box ends on an edge: the tile beyond is only touched.
    assert images.pyramid_tiles(boxes, 3, 10.0, 20.0).select("tx", "ty").collect() == [(2, 1)]
    drawn = images.annotate(pixels.select(F.col("path").alias("tile"), "x", "y", "r", "g", "b"), pixels.limit(1).select(F.col("path").alias("tile"), "x", "y", F.lit(1).alias("r"), F.lit(2).alias("g"), F.lit(3).alias("b")), 7, 9)
    assert images.decode_tiff(bytes(drawn.first().tiff))[0].shape == (9, 7, 3)


def test_pluggable_model(spark):
    def load():
        return lambda batch: pd.DataFrame({"tile": batch["tile"], "found": batch["tile"].str.len()})

    df = spark.createDataFrame([("a",), ("bcd",)], "tile string")
    assert sorted(map(tuple, raster.infer(df, load, "tile string, found long").collect())) == [("a", 1), ("bcd", 3)]


def test_survey_job_and_routes_from_files(spark, tmp_path):
    rows = [("tile_r001_c002.tif", 2048, 2048, "row", k, [(10.0, 100.0 + 120 * k), (1500.0, 100.0 + 120 * k)], "", "", "regular", None) for k in range(4)]
    crown = [("tile_r001_c002.tif", 2048, 2048, "vineyard", 9, [(400.0, 150.0), (440.0, 150.0), (440.0, 190.0), (400.0, 190.0)], "", "", None, None)]
    objects = spark.createDataFrame(rows + crown, "tile string, width int, height int, label string, place int, points array<struct<x:double,y:double>>, vineyard_id string, row_id string, row_structure string, interrow_cover string")
    found = {(r.metric, r.vineyard_id, r.row_id): r.value for r in jobs.run_survey(objects, str(tmp_path / "out")).collect()}
    assert found["block_count", "", ""] == 1 and found["row_count", "", ""] == 4
    assert found["canopy_area", "V01", ""] == pytest.approx(1.0) and found["total_row_length", "", ""] == pytest.approx(4 * 1490 * 0.025)
    parts = jobs.derive_interrow(jobs.assign_ids(objects)).collect()
    assert len(parts) == 3 and sum(p.area for p in parts) == pytest.approx(3 * 1490 * 120 - 1600)
    # The crown touches no border of its strip, so the outer ring is the strip's.
    assert all(abs(plain_area([tuple(q) for q in p.ring]) - 1490 * 120) < 1e-6 for p in parts)
    assert found["interrow_area", "V01", ""] == pytest.approx(3 * 1490 * 120 * 0.025**2, rel=1e-4)
    assert cvat.read(spark, str(tmp_path / "out/annotations")).filter("label = 'interrow_area'").count() == 3

    area = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [30.5, 0], [30.5, 20.5], [0, 20.5], [0, 0]]]}, "properties": {}}]}
    (tmp_path / "p.geojson").write_text(json.dumps(area))
    routes = jobs.plan_survey_routes(spark, str(tmp_path / "p.geojson"), (1.0, 1.0), None, str(tmp_path / "routes")).collect()
    assert len(routes) == 2 and all(r.closed and r.unreachable == 0 and r.passed and r.inside_share > 0.99 and r.end_gap == 0 for r in routes)
    hole = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[9.5, -1], [20.5, -1], [20.5, 15.5], [9.5, 15.5], [9.5, -1]]]}, "properties": {}}]}
    (tmp_path / "f.geojson").write_text(json.dumps(hole))
    there = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [28.0, 2.0]}, "properties": {"id": "w", "kind": "waste"}}]}
    (tmp_path / "t.geojson").write_text(json.dumps(there))
    around = jobs.plan_survey_routes(spark, str(tmp_path / "p.geojson"), (1.0, 1.0), str(tmp_path / "t.geojson"), str(tmp_path / "around"), str(tmp_path / "f.geojson")).collect()
    assert all(r.passed and r.length > 70 and r.unreachable == 0 for r in around)
    # What is forbidden around the start counts for nothing.
    free = jobs.plan_survey_routes(spark, str(tmp_path / "p.geojson"), (15.0, 2.0), str(tmp_path / "t.geojson"), str(tmp_path / "free"), str(tmp_path / "f.geojson")).collect()
    assert all(r.length < 40 for r in free)
    line = geojson.read(spark, str(tmp_path / "routes/inspector")).first()
    assert line.geom_type == "LineString" and line.length_m > 0


def test_running_measurements(spark, tmp_path):
    from fieldloom.streaming import upsert

    rows = spark.createDataFrame([("t", 0, "V01", 2.0), ("t", 0, "V01", 2.0), ("t", 1, "V01", 3.0)], "tile string, place int, vineyard_id string, length double")
    rows.withColumn("seen_at", F.timestamp_seconds(F.lit(1_700_000_000))).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    query = upsert.keep_table(upsert.running_lengths(stream), str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    query.awaitTermination(60)
    last = spark.read.parquet(str(tmp_path / "table")).orderBy(F.desc("version")).first()
    assert last.length == 5.0 and last.fragments == 2


def test_rows_from_stripes(spark):
    from fieldloom.operators import rows

    size, angle, gap = 128, math.radians(20), 16
    spots = [(0, x, y) for x in range(size) for y in range(size) if abs((((y - 64) * math.cos(angle) - (x - 64) * math.sin(angle)) % gap) - gap / 2) <= 1.5]
    found = rows.detect_rows(spark.createDataFrame(spots, "tile int, x int, y int"), gap).orderBy("s").collect()
    assert len(found) >= 6 and all(abs(math.degrees(r.angle) - 20) <= 1 for r in found)
    steps = [b.s - a.s for a, b in zip(found, found[1:])]
    assert all(abs(s - gap) <= 2 for s in steps) and all(r.t1 > r.t0 for r in found)


def test_global_rows_around_zero(spark):
    from fieldloom.operators import rows

    segs = [(i, 0.0, float(3 * i), 100.0, 3 * i + (0.1 if i % 2 else -0.1)) for i in range(6)]
    df = spark.createDataFrame(segs, "id long, ax double, ay double, bx double, by_ double")
    assert [r.row_id for r in rows.global_rows(df).orderBy("id").collect()] == [f"V01-R{k:02d}" for k in range(1, 7)]
    assert rows.global_rows(df.limit(0)).count() == 0


def plain_area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]]))) / 2


def test_outlines_of_parts():
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    ring = polygons.outline(polygons.difference([[box(0, 0, 10, 10)]], [[box(-1, 4, 6, 6)]])[0])
    assert sorted(ring) == sorted([(0, 0), (10, 0), (10, 10), (0, 10), (0, 6), (6, 6), (6, 4), (0, 4)]) and plain_area(ring) == 88
    rng = np.random.default_rng(4)
    for _ in range(40):
        star = [(r * math.cos(a), r * math.sin(a)) for a, r in zip(np.linspace(0, 2 * math.pi, 9)[:-1], rng.uniform(2, 9, 8))]
        cut = [(float(x), float(y)) for x, y in rng.uniform(-9, 9, (3, 2))]
        for part in polygons.difference([[star]], [[cut]]):
            if polygons.area_of(part) < 1e-6:
                continue
            ring = polygons.outline(part)
            assert plain_area(ring) >= polygons.area_of(part) - 1e-6
            # Holes are what the outline has beyond the part: the cut's inside.
            holes = polygons.intersection_area([[ring]], [[cut]])
            assert plain_area(ring) - holes == pytest.approx(polygons.area_of(part), abs=1e-5)


def test_points_without_coordinates(spark):
    from fieldloom.operators import spatial

    nan = float("nan")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0), (3, nan, 1.0), (4, 900.0, 1.0), (5, float("inf"), 0.0)], "id long, x double, y double")
    rows = spark.createDataFrame([("a", "a", 0.0, 1.0, 9.0, 1.0), ("b", "b", None, 1.0, 9.0, 1.0)], "block string, ord string, ax double, ay double, bx double, by_ double")
    assert sorted(map(tuple, spatial.assign_blocks(points, rows).collect())) == [(1, "a", True), (4, "a", False)]
    assert spatial.assign_blocks(points, rows.limit(0)).count() == 0 and spatial.assign_blocks(points.limit(0), rows).count() == 0
    nodes = spark.createDataFrame([(7, 1.0, 0.0), (8, nan, 0.0)], "node long, x double, y double")
    assert sorted((r.id, r.node) for r in spatial.nearest(points, nodes, 4.0).collect()) == [(1, 7), (4, 7)]
    # At 60 degrees a degree of longitude is half as long.
    north = spark.createDataFrame([(1, 1.5, 60.0), (2, 0.0, 61.0)], "node long, x double, y double")
    here = spark.createDataFrame([(0, 0.0, 60.0)], "id long, x double, y double")
    assert spatial.nearest(here, north, 1.0).first().node == 2 and spatial.nearest(here, north, 1.0, 0.5).first().node == 1


def test_covers():
    square = lambda x0, y0, x1, y1: [np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], float)]
    segments = np.array([(1, 1, 9, 1), (1, 1, 15, 1), (9, 5, 15, 5), (1, 5, 9, 5), (3, 3, 3.5, 7)], float)
    assert graph.covers(segments, [square(0, 0, 10, 10), square(9.5, 4, 20, 6)], []).tolist() == [True, False, True, True, True]
    assert graph.covers(segments, [square(0, 0, 10, 10), square(9.5, 4, 20, 6)], [square(4, 4, 6, 6)]).tolist() == [True, False, True, False, True]


def test_routes_in_degrees(spark):
    nodes = spark.createDataFrame([(k, 28.0 + 0.001 * k, 47.0) for k in range(5)], "node long, x double, y double")
    w = graph.apart((28.0, 47.0), (28.001, 47.0), True)
    assert w == pytest.approx(75.9, abs=0.2)
    edges = spark.createDataFrame([(k, k + 1, w) for k in range(4)], "src long, dst long, w double")
    targets = spark.createDataFrame([("farmer", "t", 28.004, 47.0)], "persona string, id string, x double, y double")
    route = graph.plan_routes(nodes, edges, (28.0, 47.0), targets, 0.002, geographic=True).first()
    assert route.length == pytest.approx(8 * w, rel=1e-6) and route.visited == 1


def test_elements_and_oversized_blobs():
    assert sorted(raster.ellipse(2)) == [(-1, 0), (0, -1), (0, 0)] and len(raster.ellipse(4)) == 13 and len(raster.ellipse(1)) == 1
    mask = np.zeros((60, 60), bool)
    mask[5:15, 5:15] = mask[20:55, 20:55] = True
    found = raster.crowns(mask * 50.0, mask, least=20, most=400, radius=5)
    assert len(found) >= 1 and all(max(x for x, _ in c["ring"]) < 20 for c in found)
    assert any(max(x for x, _ in c["ring"]) > 20 for c in raster.crowns(mask * 50.0, mask, least=20, most=5000, radius=5))


def test_angle_of_dashed_lines(spark):
    angle = math.radians(20)
    spots = [(3, x, y) for x in range(120) for y in range(120) if abs((y * math.cos(angle) - x * math.sin(angle)) % 40 - 20) < 2 and (x // 8) % 2]
    got = raster.dominant_angles(spark.createDataFrame(spots, "tile int, x int, y int"), 120, 120).first()
    assert abs(math.degrees(got.angle) % 180 - 20) < 3
    assert raster.SOBEL_X[2, 0] == 6 and raster.SOBEL_Y[0, -2] == -6 and sum(raster.SOBEL_X.values()) == 0


def test_lines_crowns_prompts_and_patches(spark):
    lines = [(1, 0, [(0.0, 0.0), (100.0, 0.0)]), (1, 1, [(150.0, 1.0), (250.0, 1.0)]), (1, 2, [(0.0, 300.0), (90.0, 300.0)])]
    merged = raster.merged_lines(spark.createDataFrame(lines, "tile int, row int, points array<struct<x:double,y:double>>")).collect()
    assert sorted(len(r.points) for r in merged) == [2, 2] and max(p.x for r in merged for p in r.points) == 250
    ring = lambda x: [(x, 0.0), (x + 4, 0.0), (x + 4, 4.0)]
    crowns = spark.createDataFrame([(1, 0, ring(0.0)), (1, 1, ring(3.0)), (1, 2, ring(40.0)), (2, 0, ring(3.0))], "tile int, crown int, ring array<struct<x:double,y:double>>")
    assert sorted((r.tile, r.crown) for r in raster.distinct_crowns(crowns).collect()) == [(1, 0), (1, 2), (2, 0)]

    on = np.zeros((40, 60), bool)
    on[2:14, 3:15] = on[20:36, 30:50] = on[0, 59] = True
    assert raster.blob_prompts(on) == [(8.5, 7.5), (39.5, 27.5)] and raster.blob_prompts(on, most=1) == [(39.5, 27.5)]
    answer = np.zeros((40, 60))
    answer[0:20, 0:20] = 0.9
    rings = raster.prompted_crowns(on, [answer, answer, np.ones((40, 60)), np.zeros((40, 60))], least=100, most=200)
    assert len(rings) == 1 and plain_area(rings[0]) == 144

    pixels = [(1, x, y, 10 * on[y, x] + 1, 5, 5, int(on[y, x])) for x in range(60) for y in range(40)]
    df = spark.createDataFrame([tuple(map(int, p)) for p in pixels], "tile int, x int, y int, r int, g int, b int, on int")
    load = lambda: lambda image, prompts: [on * 1.0 if x > 20 else np.zeros(on.shape) for x, _ in prompts]
    got = raster.prompt_crowns(df, load, 60, 40, least=100).collect()
    assert len(got) == 1 and plain_area([tuple(p) for p in got[0].ring]) == 320
    patchwise = raster.infer_patches(df, lambda: lambda patch: patch[:, :, 0] > 5, 60, 40, side=25, stride=20)
    assert set(map(tuple, patchwise.select("x", "y").collect())) == {(x, y) for y, x in zip(*on.nonzero())}


def lzw(data):
    """A plain encoder, which widens its codes when entry 511, 1023 or 2047 is there."""
    table, width, out, bits = {bytes([i]): i for i in range(256)}, 9, [], "100000000"
    n, before = 258, b""
    for i in range(len(data)):
        now = data[i : i + 1]
        if before + now in table:
            before += now
            continue
        bits += format(table[before], f"0{width}b")
        table[before + now] = n
        n += 1
        before = now
        width = max(9, n.bit_length())
        if n == 4093:
            bits += format(table[before], f"0{width}b") + format(256, f"0{width}b")
            table, width, n, before = {bytes([i]): i for i in range(256)}, 9, 258, b""
    if before:
        bits += format(table[before], f"0{width}b")
        n += 1
        width = max(9, n.bit_length())
    bits += format(257, f"0{width}b")
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def tiff(a, packed=1, predictor=1, tile=None):
    import struct
    import zlib

    h, w, bands = a.shape
    wide = a.dtype.itemsize * 8
    if tile:
        full = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile, bands), a.dtype)
        full[:h, :w] = a
        parts = [full[y : y + tile, x : x + tile] for y in range(0, h, tile) for x in range(0, w, tile)]
    else:
        parts = [a[y : y + 4] for y in range(0, h, 4)]
    if predictor == 2:
        parts = [np.concatenate([p[:, :1], p[:, 1:] - p[:, :-1]], axis=1) for p in parts]
    pack = {1: bytes, 8: zlib.compress, 5: lzw}[packed]
    bodies = [pack(np.ascontiguousarray(p).tobytes()) for p in parts]
    offsets = [8 + sum(map(len, bodies[:i])) for i in range(len(bodies))]
    entries = [(256, 4, [w]), (257, 4, [h]), (258, 3, [wide] * bands), (259, 3, [packed]), (277, 3, [bands]), (317, 3, [predictor])]
    entries += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, offsets), (325, 4, [len(b) for b in bodies])] if tile else [(273, 4, offsets), (278, 4, [4]), (279, 4, [len(b) for b in bodies])]
    base = 8 + sum(map(len, bodies))
    after, directory, extra = base + 2 + 12 * len(entries) + 4, b"", b""
    for tag, kind, values in sorted(entries):
        raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
        if len(raw) > 4:
            raw, extra = struct.pack("<I", after + len(extra)), extra + raw
        directory += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", base) + b"".join(bodies) + struct.pack("<H", len(entries)) + directory + b"\0" * 4 + extra


@pytest.mark.parametrize("kind", ["uint8", "<u2"])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, 16])
def test_tiff_layouts(kind, predictor, tile):
    rng = np.random.default_rng(2)
    a = (rng.integers(0, 4000, (21, 37, 3)) % (200 if kind == "uint8" else 4000)).astype(kind)
    a[:, 5:30] = 7
    for packed in (1, 8, 5):
        assert (images.decode_tiff(tiff(a, packed, predictor, tile))[0] == a).all()
    with pytest.raises(ValueError):
        images.decode_tiff(tiff(a, 1, 1, tile).replace(b"\x3d\x01\x03\x00\x01\x00\x00\x00\x01", b"\x3d\x01\x03\x00\x01\x00\x00\x00\x03"))


def test_long_lzw():
    data = bytes(np.random.default_rng(3).integers(0, 256, 30_000, dtype=np.uint8)) + b"ab" * 9000
    assert images.unpack_lzw(lzw(data)) == data


def test_headers_extent_and_pyramid_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    a = np.full((4, 6, 3), 9, np.uint8)
    (tmp_path / "in/tile_r001_c002.tif").write_bytes(images.encode_tiff(a, 0.5, (100.0, 200.0)))
    (tmp_path / "in/loose.tif").write_bytes(images.encode_tiff(a))
    heads = {r.path.rsplit("/", 1)[-1]: r for r in images.read_headers(spark, str(tmp_path / "in")).collect()}
    one = heads["tile_r001_c002.tif"]
    assert (one.width, one.height, one.a, one.c0, one.e, one.f) == (6, 4, 0.5, 100.0, -0.5, 200.0) and heads["loose.tif"].a is None
    world = spark.createDataFrame([(one.a, one.c0, one.e, one.f, [(0.0, 0.0), (6.0, 4.0)])], "a double, c double, e double, f double, p array<struct<x:double,y:double>>")
    corners = world.select(g.affine_to_world(F.col("p"), *[F.col(c) for c in "acef"], centre=False).alias("w")).first().w
    assert [tuple(p) for p in corners] == [(100.0, 200.0), (103.0, 198.0)]
    extent = tiles.data_extent(spark.createDataFrame([(0.0, 1.0, 2.0, 3.0), (-1.0, 2.0, 1.0, 9.0)], "x0 double, y0 double, x1 double, y1 double")).first()
    assert tuple(extent) == (-1.0, 1.0, 2.0, 9.0)
    known = spark.createDataFrame([("a",)], "tile string")
    assert [r.tile for r in jobs.tile_report(spark.createDataFrame([("a",), ("b",)], "tile string"), known).collect()] == ["b"]

    half = math.pi * 6378137.0
    step = 2 * half / 2**3 / 16
    # Two sources of four pixels each, twice as wide as a target; the later one paints over the first.
    spots = [("a", -half + step * (1 + 2 * i), half - step * (1 + 2 * j), 50, 60, 70) for i in range(2) for j in range(2)]
    spots += [("b", -half + step, half - step, 90, 91, 92)]
    pixels = spark.createDataFrame(spots, "path string, mx double, my double, r int, g int, b int")
    assert images.write_pyramid(pixels, str(tmp_path / "map"), range(3, 4), 2 * step, 16) == 1
    import struct
    import zlib

    png = (tmp_path / "map/3/0/0.png").read_bytes()
    at = png.index(b"IDAT")
    (size,) = struct.unpack(">I", png[at - 4 : at])
    image = np.frombuffer(zlib.decompress(png[at + 4 : at + 4 + size]), np.uint8).reshape(16, 1 + 64)[:, 1:].reshape(16, 16, 4)
    assert (image[:2, :2] == (90, 91, 92, 255)).all() and (image[2:4, :4] == (50, 60, 70, 255)).all() and image[4:].sum() == 0 and image[:, 4:].sum() == 0


def test_annotation_file_as_it_is_written(spark, tmp_path):
    objects = spark.createDataFrame(
        [("t.tif", 64, 32, "waste", 0, [(1.0, 2.0), (3.0, 4.5)], "V01", "", None, None), ("t.tif", 64, 32, "interrow_area", 0, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], "", "", None, None)],
        "tile string, width int, height int, label string, place int, points array<struct<x:double,y:double>>, vineyard_id string, row_id string, row_structure string, interrow_cover string",
    )
    cvat.write(objects, str(tmp_path / "out"))
    import xml.etree.ElementTree as tree

    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    root = tree.fromstring(text[text.index("<annotations") :])
    kinds = [(x.findtext("name"), x.findtext("type"), [(a.findtext("name"), a.findtext("input_type"), a.findtext("mutable"), a.findtext("default_value") or "") for a in x.iter("attribute")]) for x in root.iter("label")]
    v = ("vineyard_id", "text", "false", "")
    assert kinds == [
        ("vineyard", "polygon", [v]),
        ("waste", "rectangle", [v]),
        ("row", "polyline", [v, ("row_id", "text", "false", ""), ("row_structure", "select", "false", "regular")]),
        ("interrow_area", "polygon", [v, ("interrow_cover", "select", "false", "bare_soil")]),
    ]
    shapes = [(s.tag, s.attrib, {a.get("name"): a.text or "" for a in s}) for s in root.find("image")]
    common = {"occluded": "0", "source": "auto", "z_order": "0"}
    assert shapes == [
        ("polygon", {"label": "interrow_area", "points": "0.00,0.00;1.00,0.00;1.00,1.00", **common}, {"vineyard_id": "", "interrow_cover": "bare_soil"}),
        ("box", {"label": "waste", "xtl": "1.00", "ytl": "2.00", "xbr": "3.00", "ybr": "4.50", **common}, {"vineyard_id": "V01"}),
    ]


def test_survey_from_pixels(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rng = np.random.default_rng(5)
    a = np.full((240, 200, 3), (120, 70, 60), np.uint8)
    for k in range(4):
        for x in range(4 + 5 * k * k % 19, 180, 20):
            a[20 + 60 * k : 32 + 60 * k, x : x + 14] = (90, 160, 40)
    a[:, :, 1] += rng.integers(0, 30, a.shape[:2], dtype=np.uint8)
    (tmp_path / "in/tile_r001_c002.tif").write_bytes(images.encode_tiff(a))
    table = jobs.survey_from_tiles(spark, str(tmp_path / "in"), str(tmp_path / "out"), 200, 240, 60, quantile=0.3, least=60, radius=8)
    found = {(r.metric, r.vineyard_id, r.row_id): r.value for r in table.collect()}
    objects = cvat.read(spark, str(tmp_path / "out/annotations")).collect()
    assert found["row_count", "", ""] == 4 and found["block_count", "", ""] == 1, [(o.label, o.points, o.row_id) for o in objects if o.label == "row"]
    strips = [o for o in objects if o.label == "interrow_area"]
    assert len(strips) == 3 and {o.interrow_cover for o in strips} == {"bare_soil"} and {o.vineyard_id for o in strips} == {"V01"}
    assert sum(o.label == "vineyard" for o in objects) >= 30


def test_ways_between_references(spark):
    at = lambda f, x, y: spark.range(1).select(*[c.alias(n) for n, c in zip("xy", f(F.lit(x), F.lit(y)))]).first()
    assert tuple(at(g.transformer(32635, 4326), 500000.0, 0.0)) == pytest.approx((27.0, 0.0))
    assert tuple(at(g.transformer(32731, 4326), 500000.0, 10_000_000.0)) == pytest.approx((3.0, 0.0))
    one, two = at(g.transformer(32635, 4326), 630000.0, 5220000.0), at(g.transformer(32635, 3857), 630000.0, 5220000.0)
    assert tuple(at(g.transformer(4326, 3857), one.x, one.y)) == pytest.approx(tuple(two))
    north, south = at(g.transformer(32633, 4326), 400000.0, 3e6), at(g.transformer(32733, 4326), 400000.0, 7e6)
    assert (north.x, north.y) == pytest.approx((south.x, -south.y))
    with pytest.raises(ValueError):
        g.transformer(3857, 32635)


def test_mask_ious(spark):
    box = lambda i, x0, y0, x1, y1: [(0, i, x, y) for x in range(x0, x1) for y in range(y0, y1)]
    df = lambda rows: spark.createDataFrame(rows, "tile int, id int, x int, y int")
    preds, refs = df(box(1, 0, 0, 4, 4) + box(1, 0, 0, 1, 1) + box(2, 20, 20, 22, 22)), df(box(7, 2, 0, 6, 4) + box(8, 4, 4, 9, 9))
    assert [tuple(r) for r in evaluate.mask_ious(preds, refs).collect()] == [(0, 1, 7, pytest.approx(8 / 24))]


def test_gaps_along_lines_close(spark):
    angle = math.radians(30)
    line = lambda x, y, w: abs((y * math.cos(angle) - x * math.sin(angle)) % 50 - 25) < w
    along = lambda x, y: (x * math.cos(angle) + y * math.sin(angle)) % 40
    spots = [(0, x, y) for x in range(150) for y in range(150) if line(x, y, 3) and along(x, y) > 15]
    closed = {(r.x, r.y) for r in raster.closed_along(spark.createDataFrame(spots, "tile int, x int, y int"), 150, 150).collect()}
    inner = [(x, y) for x in range(45, 105) for y in range(45, 105) if line(x, y, 1)]
    assert sum(p in closed for p in inner) >= 0.97 * len(inner) and sum(p in set((x, y) for _, x, y in spots) for p in inner) < 0.75 * len(inner)
    assert not [p for p in closed if not line(*p, 6)]


def test_route_files_and_drawn_tiles(spark, tmp_path):
    routes = spark.createDataFrame([("farmer", 12.5, json.dumps([[630000.0, 5220000.0], [630010.0, 5220000.0]])), ("inspector", 0.0, "[]")], "persona string, length double, points string")
    jobs.export_route(routes, "farmer", str(tmp_path))
    jobs.export_route(routes, "inspector", str(tmp_path))
    line = geojson.read(spark, str(tmp_path / "farmer_route")).first()
    lon, lat = json.loads(line.coordinates)[0]
    assert line.geom_type == "LineString" and line.length_m == 12.5 and 28 < lon < 29 and 47 < lat < 48
    table = spark.read.option("header", "true").csv(str(tmp_path / "farmer_route_points")).collect()
    assert [r.place for r in table] == ["0", "1"] and float(table[0].longitude) == pytest.approx(lon, abs=1e-6)
    assert not (tmp_path / "inspector_route").exists()
    pixels = spark.createDataFrame([("t", x, y, 5, 6, 7) for x in range(4) for y in range(3)], "tile string, x int, y int, r int, g int, b int")
    drawn = images.annotate(pixels, pixels.limit(1).withColumn("r", F.lit(99)), 4, 3)
    assert images.write_files(drawn.select(F.concat("tile", F.lit(".tif")).alias("path"), F.col("tiff").alias("content")), str(tmp_path / "drawn")) == 1
    back, _ = images.decode_tiff((tmp_path / "drawn/t.tif").read_bytes())
    assert back.shape == (3, 4, 3) and sorted(back[:, :, 0].ravel().tolist()) == [5] * 11 + [99]


def test_crowns_without_the_colour_gate(spark):
    rng = np.random.default_rng(6)
    rows = []
    for x in range(64):
        for y in range(64):
            on = (x - 30) ** 2 + (y - 30) ** 2 < 100
            rows.append((1, x, y, 30, 160 + int(rng.integers(0, 20)), 200 if on else 255))
    df = spark.createDataFrame(rows, "tile int, x int, y int, r int, g int, b int")
    # Blue rather than green: the gate leaves nothing of it.
    assert raster.segment_crowns(df, 64, 64, 0.2).count() == 0
    found = raster.segment_crowns(df, 64, 64, 0.2, gate=False, **raster.VARIANT_CROWNS).collect()
    assert len(found) >= 1 and all(130 <= r.pixels <= 9000 for r in found)
    shares = raster.ring_shares(spark.createDataFrame([(1, 5, [(20.0, 20.0), (40.0, 20.0), (40.0, 40.0), (20.0, 40.0)]), (2, 5, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], "tile int, id int, ring array<struct<x:double,y:double>>"), df, raster.VARIANT_GREEN).collect()
    assert [(r.tile, r.n) for r in shares] == [(1, 400)] and 0 <= shares[0].share <= 1


def test_decimals_round_by_the_exact_value(spark):
    rng = random.Random(3)
    values = [0.0, 0.125, 0.375, 2.675, 1.005, 0.285, 0.29, 0.995, 0.9951, 99.995, 1024.125, 0.1953125, 0.4140625, 0.5, 1e-9, 1234567.885, 0.9999999, 1e15, 3.7e-300]
    values += [rng.randrange(0, 1 << 20) / 2 ** rng.randrange(0, 12) for _ in range(400)] + [rng.randrange(0, 10**7) / 1000 for _ in range(400)] + [rng.random() * 10 ** rng.randrange(-4, 9) for _ in range(400)]
    values += [-v for v in values if v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 6):
        got = df.select("v", text.fixed(F.col("v"), digits).alias("t")).collect()
        assert [(r.v, r.t) for r in got if r.t != f"{r.v:.{digits}f}"] == []
    odd = spark.createDataFrame([(None,), (math.nan,), (math.inf,)], "v double").select(text.fixed(F.col("v"), 2).alias("t")).collect()
    assert [r.t for r in odd] == [None, "NaN", "Infinity"]


def test_null_geometries_of_every_type_stay_null(spark):
    kinds = ["Point", "LineString", "Polygon", "MultiLineString", "MultiPolygon"]
    df = spark.createDataFrame([(k, None) for k in kinds], "kind string, coordinates string")
    assert [r.p for r in df.select(geojson.geometry(F.col("kind"), F.col("coordinates")).alias("p")).collect()] == [None] * 5


def plain_components(ids, edges):
    label = {i: i for i in ids}
    for _ in ids:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_blocks_and_rows_of_heaped_segments(spark):
    """Components from stars of cells equal those of all pairs, with copies, points and crossings; 3,000 copies give no pairs."""
    from fieldloom.operators import stitching

    rng = random.Random(11)
    segs = [(x := rng.uniform(0, 160), y := rng.uniform(0, 160), x + rng.uniform(-12, 12), y + rng.uniform(-1, 1)) for _ in range(70)]
    segs += segs[:20] + [(50.0, 300.0, 50.0, 300.0)] * 3 + [(0.0, 400.0, 9.0, 400.0), (13.0, 400.5, 20.0, 400.4), (25.0, 400.0, 33.0, 400.0)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(segs)], "id long, ax double, ay double, bx double, by_ double").repartition(3)
    pairs = spatial.segment_pairs(df, 5.0)
    lines = spatial.row_line_pairs(pairs, df.withColumn("block", F.lit(0)))
    ids = range(len(segs))
    blocks, rows = (plain_components(ids, [(r.a, r.b) for r in p.collect()]) for p in (pairs, lines))
    got = {r.id: (r.block, r.row) for r in stitching.identified(df, 5.0).collect()}
    assert got == {i: (blocks[i], rows[i]) for i in ids}
    both = [sorted((r.a, r.b) for r in df_.collect()) for df_ in (spatial.segment_line_pairs(df, 5.0), lines)]
    assert both[0] == both[1] and len(both[0]) > 20
    heap = df.limit(1).crossJoin(spark.range(3000).toDF("n")).withColumns({"id": F.col("n"), "ax": F.col("ax") + F.col("n") % 50}).drop("n")
    assert spatial.segment_shapes(heap).count() == 50
    assert spatial.segment_links(heap, 5.0).groupBy("line").count().agg(F.max("count")).first()[0] < 20 * 3000
    assert stitching.identified(heap.limit(0), 5.0).count() == 0


def test_nearest_of_heaped_nodes(spark, monkeypatch):
    """20,000 points and 20,000 nodes on 150 places, in one cell of the asked size: 400 million pairs before."""
    from fieldloom import session

    rng = random.Random(13)
    places = [(rng.randrange(40) / 8, rng.randrange(40) / 8) for _ in range(150)]
    nodes = [(i, *places[i * 7 % 150]) for i in range(20000)]
    points = [(i, rng.randrange(-16, 60) / 8, rng.randrange(-16, 60) / 8) for i in range(20000)]
    least = {}
    for i, *at in nodes:
        least.setdefault(tuple(at), i)
    want = {at: min((((n[0] - at[0]) * 0.5) ** 2 + (n[1] - at[1]) ** 2, i) for n, i in least.items()) for at in {p[1:] for p in points}}
    p, n = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(nodes, "node long, x double, y double")
    got = {r.id: (r.d**2, r.node) for r in spatial.nearest(p, n, 16.0, 0.5).collect()}
    assert len(got) == 20000 and all(got[i][1] == want[x, y][1] and got[i][0] == pytest.approx(want[x, y][0]) for i, x, y in points)
    # More places than executors should hold are met by joins; nodes on one line, and a single one, make thin grids.
    line, one = n.filter("node < 150").withColumn("y", F.lit(2.0)), n.filter("node = 5")
    some = p.filter("id < 300")
    few = [sorted(map(tuple, spatial.nearest(some, df, 16.0).collect())) for df in (n, line, one)]
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert [sorted(map(tuple, spatial.nearest(some, df, 16.0).collect())) for df in (n, line, one)] == few


def test_union_of_many_boxes_makes_few_rows(spark):
    """Boxes meet only the slabs they span, and in a slab only the tallest on one base is left."""
    rng = random.Random(17)
    boxes = [(i % 2, x := rng.randrange(300), y := rng.randrange(6), x + rng.randrange(1, 9), y + rng.randrange(1, 5)) for i in range(20000)]
    df = spark.createDataFrame(boxes, "r int, x0 int, y0 int, x1 int, y1 int")
    cover = {(r, x, y) for r, x0, y0, x1, y1 in boxes for x in range(x0, x1) for y in range(y0, y1)}
    assert polygons.box_slabs(df, ["r"]).count() <= 2 * 310 * 6
    assert {r.r: r.area for r in polygons.box_union_area(df, ["r"]).collect()} == {r: sum(k[0] == r for k in cover) for r in (0, 1)}


def test_block_assignment_of_many_points(spark):
    """Blocks from cells, places and distances equal those of every pair; 20,000 points beside 2,000 rows: 40 million pairs before."""
    rng = random.Random(19)
    rows = [(f"b{i % 5}", 4 - i % 5, x := (i % 5) * 9 + rng.uniform(0, 4), y := rng.uniform(0, 60), x + rng.uniform(-3, 3), y + rng.uniform(-9, 9)) for i in range(2000)]
    points = [(i, rng.uniform(-20, 60), rng.uniform(-20, 80)) for i in range(400)]
    points += [(400 + i, 1.0 + i % 3 * 14, 20.0 + i % 4) for i in range(19600)]
    p, s = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(rows, "block string, ord int, ax double, ay double, bx double, by_ double")
    got = {r.id: (r.block, r.inside) for r in spatial.assign_blocks(p, s, 5.0).collect()}
    a, b = np.array([r[2:4] for r in rows]), np.array([r[4:] for r in rows])
    want = {}
    for x, y in {q[1:] for q in points}:
        t = np.clip((((x, y) - a) * (b - a)).sum(1) / ((b - a) ** 2).sum(1), 0, 1)[:, None]
        d = np.hypot(*(a + t * (b - a) - (x, y)).T)
        k = min(range(len(rows)), key=lambda k: (d[k] > 5, rows[k][1] if d[k] <= 5 else d[k]))
        want[x, y] = rows[k][0], bool(d[k] <= 5)
    assert got == {i: want[x, y] for i, x, y in points}
    assert spatial._sure_blocks(s, 5.0, 1.25).count() > 500


def test_line_pairs_of_copies(spark):
    """Copies are paired once as shapes: 1,500 copies of three segments give their million pairs without a million tests."""
    ends = [(0.0, 0.0, 9.0, 0.0), (12.0, 0.0, 20.0, 0.5), (40.0, 0.0, 49.0, 0.0)]
    df = spark.createDataFrame([(i, *ends[i % 3]) for i in range(1500)], "id long, ax double, ay double, bx double, by_ double")
    found = spatial.segment_line_pairs(df, 5.0)
    assert found.filter("a >= b").isEmpty() and found.distinct().count() == found.count() == 3 * 500 * 499 // 2 + 500 * 500
    assert spatial.segment_line_pairs(df.limit(0), 5.0).isEmpty()


def test_greedy_matching_of_heaped_boxes(spark):
    """Boxes matched by class as their pairs are; 4,000 predictions on 4,000 copies make no pairs (16 million before)."""
    rng = random.Random(23)
    some = lambda n: [(rng.randrange(2), i, float(x := rng.randrange(12)), float(y := rng.randrange(6)), float(x + rng.randrange(4, 9)), float(y + rng.randrange(4, 7))) for i in range(n)]
    p, r = (spark.createDataFrame(some(n), "tile int, id long, x0 double, y0 double, x1 double, y1 double") for n in (150, 130))
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(evaluate.greedy_matches(evaluate.box_ious(p, r, ["tile"]), "tile"))
    assert rows(evaluate.greedy_box_matches(p, r, "tile")) == want and len(want) > 50
    heap = spark.range(4000).selectExpr("0 AS tile", "id", "0D AS x0", "0D AS y0", "4D AS x1", "4D AS y1")
    found = rows(evaluate.greedy_box_matches(heap, heap, "tile"))
    assert [m[1:3] for m in found] == [(i, 3999 - i) for i in range(4000)]
    assert evaluate.greedy_box_matches(p, r.limit(0), "tile").count() == evaluate.greedy_box_matches(p.limit(0), r, "tile").count() == 0
