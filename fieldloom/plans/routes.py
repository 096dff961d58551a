"""Queries of navigation graphs and routes, on a lattice with holes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.operators import graph
from fieldloom.operators.measure import trip_summary

from . import fixtures as fx
from .catalogue import query

START = 12  # the cell (1, 0)


def cells(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.CELL)


def metres(df):
    return df.withColumns({"x": F.col("x") * 2.0, "y": F.col("y") * 2.0})


_EDGES = """steps(dx, dy, w) AS (VALUES (1, 0, 2.0::DOUBLE), (0, 1, 2.0::DOUBLE), (1, 1, 2 * sqrt(2)), (-1, 1, 2 * sqrt(2))),
edges AS (SELECT a.node AS src, b.node AS dst, w FROM cells a, steps, cells b WHERE b.x = a.x + dx AND b.y = a.y + dy)"""


@query("q40_lattice_edges", fx.with_fixtures(f"WITH {_EDGES} SELECT src, dst, round(w, 6) AS w FROM edges"))
def lattice_edges(spark, sf_dir):
    return graph.grid_edges(cells(spark, sf_dir), 2.0).withColumn("w", F.round("w", 6))


@query("q40b_lattice_nodes", "SELECT CAST(x AS INTEGER) AS col, CAST(y AS INTEGER) AS row, x * 2.5 AS x, y * 2.5 AS y FROM range(9) a(x), range(5) b(y) WHERE NOT (x * 2.5 > 6 AND x * 2.5 < 13 AND y * 2.5 > 4 AND y * 2.5 < 8)")
def lattice_nodes(spark, sf_dir):
    """Lattice points of a bounding box that no cut covers."""
    box = spark.range(1).select(F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(21.0).alias("x1"), F.lit(11.0).alias("y1")).alias("b"))
    nodes = box.select(F.explode(graph.lattice(F.col("b"), 2.5)).alias("p")).select("p.*").withColumn("node", F.col("col") * 100 + F.col("row"))
    ring = lambda x0, y0, x1, y1: F.array(g.box_ring(*[F.lit(v) for v in (x0, y0, x1, y1)])).alias("rings")
    area, cut = spark.range(1).select(ring(-1.0, -1.0, 30.0, 30.0)), spark.range(1).select(ring(6.0, 4.0, 13.0, 8.0))
    return graph.walkable_nodes(nodes, area, cut).select("col", "row", "x", "y")


_HOLE = (5.5, 4.0, 13.0, 8.0)


def _reach(a, b, low, high):
    """When an edge enters and leaves a range of one axis, in DuckDB."""
    inside = f"({a} > {low} AND {a} < {high})"
    enter = f"CASE WHEN {b} = {a} THEN CASE WHEN {inside} THEN -1e9 ELSE 1e9 END ELSE least(({low} - {a}) / ({b} - {a}), ({high} - {a}) / ({b} - {a})) END"
    leave = f"CASE WHEN {b} = {a} THEN CASE WHEN {inside} THEN 1e9 ELSE -1e9 END ELSE greatest(({low} - {a}) / ({b} - {a}), ({high} - {a}) / ({b} - {a})) END"
    return enter, leave


_IN_X, _IN_Y = _reach("ax", "bx", _HOLE[0], _HOLE[2]), _reach("ay", "by_", _HOLE[1], _HOLE[3])


@query(
    "q40c_covered_edges",
    f"""WITH n AS (SELECT x * 100 + y AS node, x AS c, y AS r, x * 2.5::DOUBLE AS x, y * 2.5::DOUBLE AS y FROM range(9) a(x), range(5) b(y)),
    steps(dx, dy) AS (VALUES (1, 0), (0, 1), (1, 1), (-1, 1)),
    e AS (SELECT a.node AS src, b.node AS dst, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM n a, steps, n b WHERE b.c = a.c + dx AND b.r = a.r + dy)
    SELECT src, dst FROM e WHERE NOT greatest({_IN_X[0]}, {_IN_Y[0]}, 0) < least({_IN_X[1]}, {_IN_Y[1]}, 1)""",
)
def covered_edges(spark, sf_dir):
    """Edges of a lattice that keep out of a hole, its corners too; the area is two boxes that overlap."""
    nodes = spark.range(45).select((F.floor(F.col("id") / 5) * 100 + F.col("id") % 5).alias("node"), F.floor(F.col("id") / 5).alias("x"), (F.col("id") % 5).alias("y"))
    ring = lambda x0, y0, x1, y1: F.array(g.box_ring(*[F.lit(v) for v in (x0, y0, x1, y1)])).alias("rings")
    area = spark.range(1).select(ring(-1.0, -1.0, 9.0, 30.0)).unionAll(spark.range(1).select(ring(8.0, -1.0, 30.0, 30.0)))
    placed = nodes.select("node", (F.col("x") * 2.5).alias("x"), (F.col("y") * 2.5).alias("y"))
    return graph.covered_edges(graph.grid_edges(nodes, 2.5), placed, area, spark.range(1).select(ring(*_HOLE))).select("src", "dst")


@query(
    "q41_component_of_start",
    fx.with_fixtures(
        f"""WITH RECURSIVE {_EDGES}, part AS (SELECT * FROM edges WHERE NOT (src % 12 < 6 AND dst % 12 >= 6) AND NOT (dst % 12 < 6 AND src % 12 >= 6)),
        both_ways AS (SELECT src AS a, dst AS b FROM part UNION ALL SELECT dst, src FROM part), reach AS (SELECT {START}::BIGINT AS node UNION SELECT b FROM reach JOIN both_ways ON a = node) SELECT node FROM reach"""
    ),
)
def component_of_start(spark, sf_dir):
    """With the lattice cut in two across the rows."""
    upper = lambda c: F.col(c) % 12 >= 6
    edges = graph.grid_edges(cells(spark, sf_dir), 2.0).filter(upper("src") == upper("dst"))
    return graph.component_of(cells(spark, sf_dir), edges, START).select("node")


_LENGTHS = f"""WITH RECURSIVE {_EDGES}, both_ways AS (SELECT src AS a, dst AS b, w = 2 AS o FROM edges UNION ALL SELECT dst, src, w = 2 FROM edges),
reach AS (SELECT {START}::BIGINT AS node, 0 AS o, 0 AS d UNION SELECT e.b, r.o + CAST(e.o AS INTEGER), r.d + 1 - CAST(e.o AS INTEGER) FROM reach r JOIN both_ways e ON e.a = r.node WHERE r.o + r.d < 18),
lengths AS (SELECT node, min(2 * o + 2 * sqrt(2) * d) AS d FROM reach GROUP BY node)"""


@query("q42_shortest_lengths", fx.with_fixtures(f"{_LENGTHS} SELECT node, round(d, 6) AS d FROM lengths"))
def shortest_lengths(spark, sf_dir):
    """By rounds of joins, for graphs of any size."""
    return graph.shortest_lengths(graph.grid_edges(cells(spark, sf_dir), 2.0), START).withColumn("d", F.round("d", 6))


@query("q42b_shortest_paths", fx.with_fixtures(f"{_LENGTHS} SELECT node, round(d, 6) AS d FROM lengths WHERE node % 9 = 3"))
def shortest_paths(spark, sf_dir):
    """By one Dijkstra per terminal in the workers."""
    nodes = cells(spark, sf_dir)
    terminals = nodes.filter("node % 9 = 3").select("node").unionAll(nodes.filter(F.col("node") == START).select("node"))
    paths = graph.shortest_paths(graph.grid_edges(nodes, 2.0), terminals).filter((F.col("a") == START) & (F.col("b") % 9 == 3))
    return paths.select(F.col("b").alias("node"), F.round("d", 6).alias("d"))


_TRIPS = f"""{_LENGTHS}, t AS (SELECT node, d, node % 2 AS odd FROM lengths WHERE node % 7 = 1)
SELECT CAST(odd AS INTEGER) AS odd, round(2 * sum(d), 4) AS naive, round(sum(d) / 1000, 3) AS km, CAST(greatest(1, floor(sum(d) / 4000 * 60 + 0.5)) AS BIGINT) AS minutes,
CAST(floor((2 * sum(d) - sum(d)) / (2 * sum(d)) * 100 + 0.5) AS BIGINT) AS saving FROM t GROUP BY 1"""


@query("q43_trip_summary", fx.with_fixtures(_TRIPS))
def trips(spark, sf_dir):
    """Twice the way to each target against a tour of half that length."""
    d = graph.shortest_lengths(graph.grid_edges(cells(spark, sf_dir), 2.0), START).filter("node % 7 = 1")
    sums = d.groupBy((F.col("node") % 2).cast("int").alias("odd")).agg(F.sum("d").alias("len"), F.sum(2 * F.col("d")).alias("naive"), F.count("*").alias("n"))
    return sums.select("odd", F.round("naive", 4).alias("naive"), *trip_summary(F.col("len"), F.col("naive"), F.col("n")))


def targets(spark, sf_dir):
    some = metres(cells(spark, sf_dir)).filter("node % 11 = 4")
    return some.select(F.col("node").alias("id"), "x", "y", F.when(F.col("node") % 2 == 0, "inspection").alias("kind"))


@query("q44_routes")
def routes(spark, sf_dir):
    """Closed tours of both personas. 2-opt depends on its order of trials and has no SQL form; tests check each
    tour to be closed, complete and no longer than its first guess."""
    nodes = cells(spark, sf_dir)
    planned = graph.plan_routes(metres(nodes), graph.grid_edges(nodes, 2.0), (2.3, 0.2), graph.persona_targets(targets(spark, sf_dir)))
    return planned.select("persona", F.round("length", 4).alias("length"), F.round("naive", 4).alias("naive"), "visited", "unreachable", "closed")


@query(
    "q45_route_gates",
    fx.with_fixtures(
        """WITH s AS (SELECT r, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS len, y0 < 1700 AS inside, id FROM seg)
        SELECT r, round(sum(CASE WHEN inside THEN len ELSE 0 END) / sum(len), 6) AS inside_share, round(max((id % 50) * 0.1), 4) AS end_gap,
        sum(CASE WHEN inside THEN len ELSE 0 END) / sum(len) >= 0.9 AND max((id % 50) * 0.1) <= 5 AS passed FROM s GROUP BY r"""
    ),
)
def route_gates(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG)
    line = F.array(g.point(F.col("x0"), F.col("y0")), g.point(F.col("x1"), F.col("y1")))
    parts = seg.select("r", g.polyline_length(line).alias("length"), (F.col("y0") < 1700).alias("inside"), (F.col("id") % 50 * 0.1).alias("gap"))
    out = graph.gates(parts, ["r"], F.col("gap"), 0.9)
    return out.select("r", F.round("inside_share", 6).alias("inside_share"), F.round("end_gap", 4).alias("end_gap"), "passed")


@query(
    "q46_personas",
    fx.with_fixtures(
        """WITH t AS (SELECT node AS id, CASE WHEN node % 2 = 0 THEN 'inspection' ELSE 'waste' END AS kind FROM cells WHERE node % 11 = 4)
        SELECT 'inspector' AS persona, id, kind FROM t UNION ALL SELECT 'farmer', id, kind FROM t WHERE kind = 'waste'"""
    ),
)
def personas(spark, sf_dir):
    return graph.persona_targets(targets(spark, sf_dir)).select("persona", "id", "kind")


@query("q47_valid_start", fx.with_fixtures("SELECT id, x0 + y0 < 1800 AND NOT (x0 > 300.5 AND x0 < 600.5 AND y0 > 200.5 AND y0 < 900.5) AS valid FROM seg"))
def valid_start(spark, sf_dir):
    points = fx.frame(spark, sf_dir, fx.SEG).select("id", F.col("x0").alias("x"), F.col("y0").alias("y"))
    at = lambda x, y: g.point(F.lit(x), F.lit(y))
    study = spark.range(1).select(F.array(F.array(at(-1.0, -1.0), at(1801.0, -1.0), at(-1.0, 1801.0))).alias("rings"))
    forbidden = spark.range(1).select(F.array(g.box_ring(*[F.lit(v) for v in (300.5, 200.5, 600.5, 900.5)])).alias("rings"))
    return graph.valid_start(points, study, forbidden)


@query(
    "q47b_row_barriers",
    fx.with_fixtures(f"WITH {_EDGES} SELECT src, dst FROM edges WHERE NOT (least(src % 12, dst % 12) * 2 - 0.4 < 9 AND 9 < greatest(src % 12, dst % 12) * 2 + 0.4 AND src % 12 <> dst % 12)"),
)
def row_barriers(spark, sf_dir):
    """Edges that keep 0.4 m away from a long row at y = 9."""
    nodes = cells(spark, sf_dir)
    wall = spark.range(1).select(F.lit(-10.0).alias("ax"), F.lit(9.0).alias("ay"), F.lit(90.0).alias("bx"), F.lit(9.0).alias("by_"))
    return graph.clear_edges(graph.grid_edges(nodes, 2.0), metres(nodes), wall, 0.4).select("src", "dst")


@query(
    "q64_compact_graph",
    fx.with_fixtures(
        f"""WITH {_EDGES}, kept AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS idx FROM cells WHERE node % 5 <> 2)
        SELECT CAST(a.idx AS INTEGER) AS i, CAST(b.idx AS INTEGER) AS j, round(w, 3) AS w FROM edges JOIN kept a ON src = a.node JOIN kept b ON dst = b.node"""
    ),
)
def compact_graph(spark, sf_dir):
    return compact_graph_parts(spark, sf_dir)[1]


def compact_graph_parts(spark, sf_dir):
    nodes = cells(spark, sf_dir)
    return graph.compact_graph(metres(nodes.filter("node % 5 <> 2")), graph.grid_edges(nodes, 2.0))


@query(
    "q64b_mock_targets",
    fx.with_fixtures(
        f"""WITH d AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(node AS VARCHAR)), node) - 1 AS k FROM cells WHERE node <> {START})
        SELECT printf('MOCK-%s-%02d', CASE WHEN k % 2 = 0 THEN 'INSP' ELSE 'WASTE' END, k // 2) AS id, CASE WHEN k % 2 = 0 THEN 'inspection' ELSE 'waste' END AS kind, node, x * 2.0::DOUBLE AS x, y * 2.0::DOUBLE AS y FROM d WHERE k < 6"""
    ),
)
def mock_targets(spark, sf_dir):
    """Six mock targets; a seeded hash stands for a random draw."""
    return graph.mock_targets(metres(cells(spark, sf_dir)), START)
