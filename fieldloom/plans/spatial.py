"""Queries of spatial joins, components, stitching and polygon areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.operators import measure as m
from fieldloom.operators import polygons, spatial, stitching
from fieldloom.operators.sequences import consecutive_pairs

from . import fixtures as fx
from .catalogue import query

#: Point to segment distance in DuckDB.
_MACROS = """
pd AS (SELECT a.id AS a, b.id AS b, a.ax, a.ay, a.bx, a.by_, b.ax AS cx, b.ay AS cy, b.bx AS dx, b.by_ AS dy FROM wseg a JOIN wseg b ON a.id < b.id
  AND least(a.ax, a.bx) - 5 <= greatest(b.ax, b.bx) AND least(b.ax, b.bx) - 5 <= greatest(a.ax, a.bx) AND least(a.ay, a.by_) - 5 <= greatest(b.ay, b.by_) AND least(b.ay, b.by_) - 5 <= greatest(a.ay, a.by_))"""


def point_distance(px, py, ax, ay, bx, by_):
    t = f"least(1, greatest(0, (({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({by_} - {ay})) / (({bx} - {ax}) ** 2 + ({by_} - {ay}) ** 2)))"
    return f"sqrt(({ax} + {t} * ({bx} - {ax}) - {px}) ** 2 + ({ay} + {t} * ({by_} - {ay}) - {py}) ** 2)"


_DISTANCE = "least({}, {}, {}, {})".format(
    point_distance("ax", "ay", "cx", "cy", "dx", "dy"),
    point_distance("bx", "by_", "cx", "cy", "dx", "dy"),
    point_distance("cx", "cy", "ax", "ay", "bx", "by_"),
    point_distance("dx", "dy", "ax", "ay", "bx", "by_"),
)
_SIDE = "(({2} - {0}) * ({5} - {1}) - ({3} - {1}) * ({4} - {0}))"
_CROSS = "({} * {} < 0 AND {} * {} < 0)".format(
    _SIDE.format("cx", "cy", "dx", "dy", "ax", "ay"), _SIDE.format("cx", "cy", "dx", "dy", "bx", "by_"), _SIDE.format("ax", "ay", "bx", "by_", "cx", "cy"), _SIDE.format("ax", "ay", "bx", "by_", "dx", "dy")
)
_DISTANCE = f"(CASE WHEN {_CROSS} THEN 0 ELSE {_DISTANCE} END)"
_PAIRS = f"{_MACROS}, pairs AS (SELECT a, b, {_DISTANCE} AS d FROM pd WHERE {_DISTANCE} <= 5)"


def segments(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.WSEG)


@query("q25_distance_join", fx.with_fixtures(f"WITH {_PAIRS} SELECT a, b, round(d, 4) AS d FROM pairs"))
def distance_join(spark, sf_dir):
    return spatial.segment_pairs(segments(spark, sf_dir), 5.0).withColumn("d", F.round("d", 4))


def _line(p, q, px, py, qx, qy, rx, ry, sx, sy):
    """Whether segment r-s continues p-q, in DuckDB."""
    n = f"sqrt(({qx} - {px}) ** 2 + ({qy} - {py}) ** 2)"
    t = lambda x, y: f"((({x} - {px}) * ({qx} - {px}) + ({y} - {py}) * ({qy} - {py})) / {n})"
    s = lambda x, y: f"abs((({y} - {py}) * ({qx} - {px}) - ({x} - {px}) * ({qy} - {py})) / {n})"
    return f"({s(rx, ry)} <= 1 AND {s(sx, sy)} <= 1 AND greatest(least({t(rx, ry)}, {t(sx, sy)}) - {n}, -greatest({t(rx, ry)}, {t(sx, sy)}), 0) <= 4)"


_SAME = f"({_line('a', 'b', 'ax', 'ay', 'bx', 'by_', 'cx', 'cy', 'dx', 'dy')} OR {_line('b', 'a', 'cx', 'cy', 'dx', 'dy', 'ax', 'ay', 'bx', 'by_')})"
_TURN = "abs(atan2(by_ - ay, bx - ax) - atan2(dy - cy, dx - cx))"
_LINES = f"{_PAIRS}, lines AS (SELECT a, b FROM pd WHERE {_DISTANCE} <= 5 AND degrees(least({_TURN}, pi() - {_TURN})) <= 20 AND {_SAME})"


@query("q26_same_row_line", fx.with_fixtures(f"WITH {_LINES} SELECT a, b FROM lines"))
def same_row_line(spark, sf_dir):
    return spatial.segment_line_pairs(segments(spark, sf_dir), 5.0)


_NODES = "SELECT s_suppkey AS node, 51.2E0 * 12285 + CAST((s_suppkey * 977) % 256 AS DOUBLE) + 0.125E0 AS x, 51.2E0 * 101972 + CAST((s_suppkey * 613) % 256 AS DOUBLE) + 0.375E0 AS y FROM {supplier}"


@query(
    "q27_nearest_node",
    fx.with_fixtures(
        "SELECT id, arg_min(node, ((x - ax) ** 2 + (y - ay) ** 2, node)) AS node, round(sqrt(min((x - ax) ** 2 + (y - ay) ** 2)), 6) AS d FROM wseg, nodes GROUP BY id",
        nodes=_NODES,
    ),
)
def nearest_node(spark, sf_dir):
    points = segments(spark, sf_dir).select("id", F.col("ax").alias("x"), F.col("ay").alias("y"))
    return spatial.nearest(points, fx.frame(spark, sf_dir, _NODES), 16.0).withColumn("d", F.round("d", 6))


_POINTS = """SELECT o_orderkey AS id, 51.2E0 * 12285 + CAST((o_orderkey * 37) % 250 AS DOUBLE) + 0.3E0 AS x, 51.2E0 * 101973 + CAST((o_orderkey * 91) % 250 AS DOUBLE) + 0.7E0 AS y FROM {orders}"""


@query(
    "q28_block_assignment",
    fx.with_fixtures(
        f"""WITH d AS (SELECT p.id, r AS block, min({point_distance("p.x", "p.y", "ax", "ay", "bx", "by_")}) AS d FROM points p, wseg GROUP BY 1, 2),
        s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d > 5, CASE WHEN d <= 5 THEN block ELSE d END, block) AS n FROM d)
        SELECT id, block, d <= 5 AS inside FROM s WHERE n = 1""",
        points=_POINTS,
    ),
)
def block_assignment(spark, sf_dir):
    rows = segments(spark, sf_dir).select(F.col("r").alias("block"), F.col("r").alias("ord"), *spatial.ENDS)
    return spatial.assign_blocks(fx.frame(spark, sf_dir, _POINTS), rows, 5.0)


@query(
    "q29_box_join",
    fx.with_fixtures(
        """WITH a AS (SELECT * FROM box WHERE status = 'F'), b AS (SELECT * FROM box WHERE status = 'P')
        SELECT a.r, a.c, a.id AS a_id, b.id AS b_id FROM a JOIN b ON a.r = b.r AND a.c = b.c AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1"""
    ),
)
def box_join(spark, sf_dir):
    """Boxes whose insides meet; touching is not enough."""
    box = fx.frame(spark, sf_dir, fx.BOX)
    met = spatial.box_pairs(box.filter("status = 'F'"), box.filter("status = 'P'"), 64.0, touching=False, keys=["r", "c"])
    return met.select("r", "c", "a_id", "b_id")


_REACH = f"""WITH RECURSIVE {_PAIRS}, both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT id AS node, id AS seen FROM wseg UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
blocks AS (SELECT node AS id, min(seen) AS block FROM reach GROUP BY node)"""


@query("q30_components", fx.with_fixtures(f"{_REACH} SELECT id, block FROM blocks"))
def components(spark, sf_dir):
    return stitching.identified(segments(spark, sf_dir), 5.0, ("block",)).select("id", "block")


_STITCH = f"""{_REACH}, {_LINES.removeprefix(_PAIRS).lstrip(', ')},
row_edges AS (SELECT a, b FROM lines UNION ALL SELECT b, a FROM lines),
row_reach AS (SELECT id AS node, id AS seen FROM wseg UNION SELECT r.node, e.b FROM row_reach r JOIN row_edges e ON r.seen = e.a),
rows AS (SELECT node AS id, min(seen) AS row FROM row_reach GROUP BY node),
joined AS (SELECT * FROM wseg JOIN blocks USING (id) JOIN rows USING (id)),
kept AS (SELECT * FROM joined WHERE block IN (SELECT block FROM joined GROUP BY block HAVING count(DISTINCT row) >= 3))"""


@query("q31_block_prune", fx.with_fixtures(f"{_STITCH} SELECT block, count(*) AS n, count(DISTINCT row) AS rows FROM kept GROUP BY block"))
def block_prune(spark, sf_dir):
    rowed = session.written(stitching.identified(segments(spark, sf_dir)), "identified")
    return stitching.prune_blocks(rowed).groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("row").alias("rows"))


NAMED = f"""{_STITCH}, v AS (SELECT block, printf('V%02d', row_number() OVER (ORDER BY min(least(ax, bx)), block)) AS vineyard_id FROM kept GROUP BY block),
mid AS (SELECT block, row, round(avg((ax + bx) / 2), 6) AS mx, round(avg((ay + by_) / 2), 6) AS my FROM kept GROUP BY block, row),
w AS (SELECT mid.block, mid.row, vineyard_id, printf('%s-R%02d', vineyard_id, row_number() OVER (PARTITION BY mid.block ORDER BY mx, my, mid.row)) AS row_id FROM mid JOIN v ON v.block = mid.block)"""


@query("q32_stitching", fx.with_fixtures(f"{NAMED} SELECT id, vineyard_id, row_id FROM kept JOIN w ON w.block = kept.block AND w.row = kept.row"))
def stitch(spark, sf_dir):
    return stitching.stitch(segments(spark, sf_dir)).select("id", "vineyard_id", "row_id")


@query("q33_rows_by_block", fx.with_fixtures(f"{NAMED} SELECT vineyard_id, string_agg(DISTINCT row_id, ',' ORDER BY row_id) AS row_ids FROM w GROUP BY vineyard_id"))
def rows_by_block(spark, sf_dir):
    return stitching.rows_by_block(stitching.stitch(segments(spark, sf_dir))).withColumn("row_ids", F.array_join("row_ids", ","))


_UNION = """edges AS (SELECT DISTINCT r, c, x AS sx FROM (SELECT r, c, x0 AS x FROM b UNION ALL SELECT r, c, x1 FROM b)),
slabs AS (SELECT *, lead(sx) OVER (PARTITION BY r, c ORDER BY sx) AS ex FROM edges),
cut AS (SELECT b.r, b.c, sx, ex - sx AS w, y0, y1 FROM b JOIN slabs s ON b.r = s.r AND b.c = s.c AND x0 <= sx AND ex <= x1),
top AS (SELECT *, max(y1) OVER (PARTITION BY r, c, sx ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM cut),
area AS (SELECT r, c, sum(w * greatest(0, y1 - greatest(y0, coalesce(top, y0)))) AS area FROM top GROUP BY r, c)"""


@query("q34_union_area", fx.with_fixtures(f"WITH b AS (SELECT * FROM box WHERE status <> 'F'), {_UNION} SELECT r, c, round(area, 4) AS area FROM area"))
def union_area(spark, sf_dir):
    box = fx.frame(spark, sf_dir, fx.BOX).filter("status <> 'F'")
    return polygons.box_union_area(box, ["r", "c"]).withColumn("area", F.round("area", 4))


@query("q35_union_area_polygons", fx.with_fixtures(f"WITH b AS (SELECT * FROM box WHERE status = 'P'), {_UNION} SELECT r, c, round(area, 4) AS area FROM area"))
def union_area_polygons(spark, sf_dir):
    """The slab engine of general polygons, on rings whose union the boxes' SQL also gives."""
    box = fx.frame(spark, sf_dir, fx.BOX).filter("status = 'P'").withColumn("ring", g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))
    return polygons.union_areas(box, ["r", "c"]).withColumn("area", F.round("area", 4))


_STRIPS = "SELECT DISTINCT r, c, k AS id, 100.0::DOUBLE AS sx0, 90 + 160.0::DOUBLE * k AS sy0, 1500.0::DOUBLE AS sx1, 115 + 160.0::DOUBLE * k AS sy1 FROM box"


@query(
    "q36_difference_area",
    fx.with_fixtures(
        f"""WITH strips AS ({_STRIPS}), b0 AS (SELECT s.r, s.c * 100 + s.id AS c, greatest(x0, sx0) AS x0, greatest(y0, sy0) AS y0, least(x1, sx1) AS x1, least(y1, sy1) AS y1
          FROM strips s JOIN box b ON s.r = b.r AND s.c = b.c AND b.status = 'O'), b AS (SELECT * FROM b0 WHERE x0 < x1 AND y0 < y1), {_UNION}
        SELECT s.r, s.c, s.id, round(1400 * 25 - coalesce(area, 0), 4) AS area FROM strips s LEFT JOIN area a ON a.r = s.r AND a.c = s.c * 100 + s.id"""
    ),
)
def difference_area(spark, sf_dir):
    box = fx.frame(spark, sf_dir, fx.BOX)
    y = 90 + 160.0 * F.col("k")
    strips = box.select("r", "c", F.col("k").alias("id"), F.lit(100.0).alias("x0"), y.alias("y0"), F.lit(1500.0).alias("x1"), (y + 25).alias("y1")).distinct()
    return polygons.box_difference_area(strips, box.filter("status = 'O'"), ["r", "c"]).withColumn("area", F.round("area", 4))


@query("q38_interrow_parts")
def interrow_parts(spark, sf_dir):
    """Strips between consecutive rows less the crowns in them, in parts of at least 200 square pixels, classed by their
    share of the strip. Splitting into parts has no SQL form; tests hold the areas against the boxes' SQL."""
    seg = fx.frame(spark, sf_dir, fx.SEG).groupBy("r", "c", "k").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.avg("y0").alias("s"))
    pairs = consecutive_pairs(seg, ["r", "c"], ["s"], ["k", "x0", "x1", "s"]).filter("next_k = k + 1")
    a = F.array(g.point(F.col("x0"), F.col("s")), g.point(F.col("x1"), F.col("s")))
    b = F.array(g.point(F.col("next_x0"), F.col("next_s")), g.point(F.col("next_x1"), F.col("next_s")))
    strips = pairs.select("r", "c", F.col("k").alias("id"), g.strip_ring(a, b).alias("strip"))
    crowns = fx.frame(spark, sf_dir, fx.BOX).filter("status = 'P'").select("r", "c", g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("ring"))
    parts = polygons.open_parts(strips, ["r", "c"], "strip", crowns, least=200.0)
    whole = strips.select("r", "c", "id", g.ring_area(F.col("strip")).alias("whole"))
    out = parts.join(whole, ["r", "c", "id"])
    return out.select("r", "c", "id", "part", F.round("area", 3).alias("area"), m.cover_class(1 - F.col("area") / F.col("whole"), F.col("area")).alias("interrow_cover"))


_FULL = f"""{NAMED}, lens AS (SELECT row_id, vineyard_id, sum(sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)) AS len FROM kept JOIN w ON w.block = kept.block AND w.row = kept.row GROUP BY 1, 2),
b AS (SELECT r, 0 AS c, (c * 2048 + x0) * 0.025 AS x0, (c * 2048 + x1) * 0.025 AS x1, y0 * 0.025 AS y0, y1 * 0.025 AS y1 FROM box WHERE status <> 'F'), {_UNION}
SELECT 'row_count' AS metric, '' AS id, CAST(count(*) AS DOUBLE) AS value FROM lens UNION ALL SELECT 'block_rows', vineyard_id, count(*) FROM lens GROUP BY 2
UNION ALL SELECT 'row_length', row_id, round(len, 4) FROM lens UNION ALL SELECT 'canopy_union', CAST(r AS VARCHAR), round(area, 6) FROM area"""


@query("q39_measurements_from_stitching", fx.with_fixtures(_FULL))
def measurements_from_stitching(spark, sf_dir):
    s = segments(spark, sf_dir)
    named = session.written(stitching.stitch(s), "named")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    lens = s.join(named, "id").groupBy("row_id", "vineyard_id").agg(F.sum(F.sqrt(dx * dx + dy * dy)).alias("len"))
    scaled = lambda c: (F.col(c) * 0.025).alias(c)
    box = fx.frame(spark, sf_dir, fx.BOX).filter("status <> 'F'")
    world = box.select("r", ((F.col("c") * 2048 + F.col("x0")) * 0.025).alias("x0"), ((F.col("c") * 2048 + F.col("x1")) * 0.025).alias("x1"), scaled("y0"), scaled("y1"))
    row = lambda df, metric, i, v: df.select(F.lit(metric).alias("metric"), i.cast("string").alias("id"), v.cast("double").alias("value"))
    return (
        row(lens.agg(F.count("*").alias("n")), "row_count", F.lit(""), F.col("n"))
        .unionAll(row(lens.groupBy("vineyard_id").agg(F.count("*").alias("n")), "block_rows", F.col("vineyard_id"), F.col("n")))
        .unionAll(row(lens, "row_length", F.col("row_id"), F.round("len", 4)))
        .unionAll(row(polygons.box_union_area(world, ["r"]), "canopy_union", F.col("r"), F.round("area", 6)))
    )
