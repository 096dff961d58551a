"""Navigation graphs and closed walking routes."""

from __future__ import annotations

import heapq
import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import geometry as g
from fieldloom.operators.components import connected_components
from fieldloom.operators.spatial import ENDS, _cells, _ends, nearest

#: East, north, north-east and north-west: with their reverses the eight neighbours.
STEPS = ((1, 0), (0, 1), (1, 1), (-1, 1))


def lattice(bounds: Column, step: float) -> Column:
    """Points (col, row, x, y) every `step` from a bounding box's lower left corner."""
    n = lambda a, b: F.floor((bounds[b] - bounds[a]) / step).cast("int")
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n("x0", "x1")),
            lambda i: F.transform(F.sequence(F.lit(0), n("y0", "y1")), lambda j: F.struct(i.alias("col"), j.alias("row"), (bounds["x0"] + i * step).alias("x"), (bounds["y0"] + j * step).alias("y"))),
        )
    )


def lattice_points(spark: SparkSession, box, step: float) -> DataFrame:
    """(node, col, row, x, y) every `step` from the lower left corner of a box (x0, y0, x1, y1), made where they are used."""
    across, up = int((box["x1"] - box["x0"]) // step) + 1, int((box["y1"] - box["y0"]) // step) + 1
    at = spark.range(across * up).select(F.expr(f"id div {up}").alias("col"), F.expr(f"id % {up}").alias("row"))
    return at.select(F.xxhash64("col", "row").alias("node"), "col", "row", (F.lit(box["x0"]) + F.col("col") * step).alias("x"), (F.lit(box["y0"]) + F.col("row") * step).alias("y"))


def grid_edges(nodes: DataFrame, step: float) -> DataFrame:
    """Edges (src, dst, w) between the eight neighbours of a lattice (node, x, y in steps), each once: four equi-joins
    in one, by dealing each node to the places beside it."""
    near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(step * math.hypot(dx, dy)).alias("w")) for dx, dy in STEPS]))
    asked = nodes.select(F.col("node").alias("src"), "x", "y", near.alias("s")).select("src", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y"), F.col("s.w").alias("w"))
    return asked.join(nodes.select(F.col("node").alias("dst"), "x", "y"), ["x", "y"]).select("src", "dst", "w")


def walkable_nodes(nodes: DataFrame, polygons: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Nodes (node, x, y) inside some walkable polygon (rings) and outside every cut; polygons meet nodes by the cells
    of their boxes, so neither side is broadcast."""
    cell = 16.0

    def inside(df: DataFrame, areas: DataFrame) -> DataFrame:
        box = g.bbox(F.element_at(F.col("rings"), 1))
        dealt = _cells(areas.select("rings", box.alias("_b")), F.col("_b.x0"), F.col("_b.y0"), F.col("_b.x1"), F.col("_b.y1"), cell).select("rings", "_cx", "_cy")
        at = df.withColumns({"_cx": F.floor(F.col("x") / cell).cast("long"), "_cy": F.floor(F.col("y") / cell).cast("long")})
        return at.join(dealt, ["_cx", "_cy"]).filter(g.in_polygon(F.col("x"), F.col("y"), F.col("rings"))).select("node").distinct()

    kept = nodes.join(inside(nodes, polygons), "node", "left_semi")
    return kept if cuts is None else kept.join(inside(nodes, cuts), "node", "left_anti")


def guarded_cut(start: tuple[float, float], nodes: DataFrame, cut: DataFrame, reach: float = 1.0) -> tuple[DataFrame, bool]:
    """Nodes after a cut and whether it holds: where nothing would be left within reach of the start, they stay uncut."""
    inside = walkable_nodes(nodes, cut.select("rings"))
    outside = nodes.join(inside.select("node"), "node", "left_anti")
    near = outside.filter(F.sqrt(F.pow(F.col("x") - start[0], 2) + F.pow(F.col("y") - start[1], 2)) <= reach)
    return (nodes, False) if near.isEmpty() else (outside, True)


def covers(segments: np.ndarray, polygons: list[list[np.ndarray]], cuts: list[list[np.ndarray]]) -> np.ndarray:
    """Whether each segment (ax, ay, bx, by) lies whole in the union of polygons and out of every cut; touching a border is
    no harm. A segment is split where it meets a border, and each piece is judged by its middle."""
    begin, way = segments[:, :2], segments[:, 2:] - segments[:, :2]
    owners, places = [np.repeat(np.arange(len(segments)), 2)], [np.tile([0.0, 1.0], len(segments))]
    for ring in (r for rings in polygons + cuts for r in rings):
        p, e = ring, np.roll(ring, -1, axis=0) - ring
        den = way[:, None, 0] * e[None, :, 1] - way[:, None, 1] * e[None, :, 0]
        off = p[None] - begin[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (off[:, :, 0] * e[None, :, 1] - off[:, :, 1] * e[None, :, 0]) / den
            u = (off[:, :, 0] * way[:, None, 1] - off[:, :, 1] * way[:, None, 0]) / den
        i, j = np.nonzero((den != 0) & (u >= 0) & (u <= 1) & (t > 0) & (t < 1))
        owners.append(i)
        places.append(t[i, j])
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    pieces = np.flatnonzero((owner[1:] == owner[:-1]) & (place[1:] - place[:-1] > 1e-9))
    owner, middle = owner[pieces], (place[pieces] + place[pieces + 1]) / 2
    spots = begin[owner] + middle[:, None] * way[owner]

    def within(rings: list[np.ndarray]) -> np.ndarray:
        odd = np.zeros(len(spots), bool)
        for ring in rings:
            for (ax, ay), (bx, by_) in zip(ring, np.roll(ring, -1, axis=0)):
                if ay != by_:
                    odd ^= ((ay > spots[:, 1]) != (by_ > spots[:, 1])) & (spots[:, 0] < (bx - ax) * (spots[:, 1] - ay) / (by_ - ay) + ax)
        return odd

    good = np.zeros(len(spots), bool)
    for rings in polygons:
        good |= within(rings)
    for rings in cuts:
        good &= ~within(rings)
    out = np.ones(len(segments), bool)
    out[owner[~good]] = False
    # A segment without length is judged by its end.
    return out


def covered_segments(segments: DataFrame, keys: list[str], polygons: DataFrame, cuts: DataFrame | None = None, cell: float = 16.0) -> DataFrame:
    """(keys, covered): whether each segment (keys, ax, ay, bx, by_) lies whole in the union of polygons (rings) and out of
    every cut. Segments meet polygons by the cells of their middles and boxes."""
    kinds = ", ".join(f"`{k}` {segments.schema[k].dataType.simpleString()}" for k in keys)
    longest = segments.agg(F.max(F.greatest(F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by_"))))).first()[0] or 0.0
    half, cell = longest / 2, max(cell, longest)
    spot = lambda a, b: F.floor((F.col(a) + F.col(b)) / 2 / cell).cast("long")
    left = segments.select(*keys, *ENDS, spot("ax", "bx").alias("_cx"), spot("ay", "by_").alias("_cy"))
    areas = polygons.select("rings", F.lit(False).alias("cut"))
    areas = areas if cuts is None else areas.unionAll(cuts.select("rings", F.lit(True)))
    box = g.bbox(F.element_at(F.col("rings"), 1))
    boxed = areas.withColumn("_b", box)
    right = _cells(boxed, F.col("_b.x0") - half, F.col("_b.y0") - half, F.col("_b.x1") + half, F.col("_b.y1") + half, cell).select("rings", "cut", "_cx", "_cy")

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = a[keys].copy()
        shapes = [(cut, [np.array([(p["x"], p["y"]) for p in ring]) for ring in rings]) for cut, rings in zip(b["cut"], b["rings"])]
        out["covered"] = covers(a[list(ENDS)].to_numpy(np.float64), [r for cut, r in shapes if not cut], [r for cut, r in shapes if cut]) if len(a) else False
        return out

    return left.groupBy("_cx", "_cy").cogroup(right.groupBy("_cx", "_cy")).applyInPandas(kernel, f"{kinds}, covered boolean")


def covered_edges(edges: DataFrame, nodes: DataFrame, polygons: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """The edges (src, dst, w) that never leave the walkable area."""
    end = lambda p, x, y: nodes.select(F.col("node").alias(p), F.col("x").alias(x), F.col("y").alias(y))
    placed = edges.join(end("src", "ax", "ay"), "src").join(end("dst", "bx", "by_"), "dst")
    kept = covered_segments(placed, ["src", "dst"], polygons, cuts).filter("covered").select("src", "dst")
    return edges.join(kept, ["src", "dst"], "left_semi")


def clear_edges(edges: DataFrame, nodes: DataFrame, barriers: DataFrame, reach: float = 0.0) -> DataFrame:
    """Edges that cross no barrier segment (ax, ay, bx, by_) and keep at least `reach` away from all."""
    cell = 8.0
    end = lambda p, x, y: nodes.select(F.col("node").alias(p), F.col("x").alias(x), F.col("y").alias(y))
    placed = edges.join(end("src", "ax", "ay"), "src").join(end("dst", "bx", "by_"), "dst")
    grown = lambda df, m: _cells(df, F.least("ax", "bx") - m, F.least("ay", "by_") - m, F.greatest("ax", "bx") + m, F.greatest("ay", "by_") + m, cell)
    walls = grown(barriers.select(*ENDS), reach).select("_cx", "_cy", *[F.col(c).alias(f"w_{c}") for c in ENDS])
    met = grown(placed, 0.0).join(walls, ["_cx", "_cy"]).filter(g.segments_cross(_ends(""), _ends("w_")) | (g.segment_distance(_ends(""), _ends("w_")) < reach))
    return edges.join(met.select("src", "dst").distinct(), ["src", "dst"], "left_anti")


def component_of(nodes: DataFrame, edges: DataFrame, start: int) -> DataFrame:
    """The nodes that are connected with a start node, it alone if none are."""
    labels = connected_components(edges.select(F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b"))).toDF("node", "label")
    own = labels.filter(F.col("node") == start).select("label")
    joined = labels.join(F.broadcast(own.limit(1)), "label", "left_semi").select("node")
    return nodes.join(joined.unionAll(nodes.filter(F.col("node") == start).select(F.col("node").cast("long"))).distinct(), "node", "left_semi")


def compact_graph(nodes: DataFrame, edges: DataFrame, digits: int = 7) -> tuple[DataFrame, DataFrame]:
    """Nodes renumbered 0.. in order (idx, node, x, y rounded), and the edges between them (i, j, w rounded to 3)."""
    from pyspark.sql import Window

    numbered = nodes.select((F.row_number().over(Window.partitionBy().orderBy("node")) - 1).alias("idx"), "node", F.round("x", digits).alias("x"), F.round("y", digits).alias("y"))
    key = lambda p, i: numbered.select(F.col("node").alias(p), F.col("idx").alias(i))
    return numbered, edges.join(key("src", "i"), "src").join(key("dst", "j"), "dst").select("i", "j", F.round("w", 3).alias("w"))


def dijkstra(neighbours: dict[int, list[tuple[int, float]]], source: int) -> tuple[dict[int, float], dict[int, int]]:
    """Shortest lengths and predecessors from a source, with outdated heap entries left to be skipped."""
    best, before, heap, done = {source: 0.0}, {}, [(0.0, source)], set()
    while heap:
        d, u = heapq.heappop(heap)
        if u in done:
            continue
        done.add(u)
        for v, w in neighbours.get(u, ()):
            if d + w < best.get(v, math.inf):
                best[v], before[v] = d + w, u
                heapq.heappush(heap, (d + w, v))
    return best, before


def path_to(before: dict[int, int], source: int, target: int) -> list[int]:
    out = [target]
    while out[-1] != source:
        out.append(before[out[-1]])
    return out[::-1]


#: Edges of a navigation graph that every worker gets whole; a larger graph goes through shortest_lengths.
WORKER_EDGES = 2_000_000


def neighbour_lists(edges: DataFrame) -> dict[int, list[tuple[int, float]]]:
    """Adjacency of a graph of checked size, for the workers."""
    n = edges.count()
    if n > WORKER_EDGES:
        raise ValueError(f"{n} edges are too many for one worker; use shortest_lengths")
    out: dict[int, list[tuple[int, float]]] = {}
    for e in edges.select("src", "dst", "w").toLocalIterator():
        out.setdefault(e.src, []).append((e.dst, e.w))
        out.setdefault(e.dst, []).append((e.src, e.w))
    return out


def shortest_paths(edges: DataFrame, terminals: DataFrame) -> DataFrame:
    """(a, b, d, path) between all terminals (node) that reach one another: one Dijkstra per terminal, in parallel."""
    graph = neighbour_lists(edges)
    wanted = sorted(r.node for r in terminals.select("node").distinct().toLocalIterator())

    def run(batches):
        for batch in batches:
            rows = []
            for source in batch["node"]:
                best, before = dijkstra(graph, int(source))
                rows += [(int(source), t, best[t], path_to(before, int(source), t)) for t in wanted if t in best]
            yield pd.DataFrame(rows, columns=["a", "b", "d", "path"])

    n = max(1, min(len(wanted), 64))
    return terminals.select(F.col("node").cast("long").alias("node")).distinct().repartition(n).mapInPandas(run, "a long, b long, d double, path array<long>")


def shortest_lengths(edges: DataFrame, source: int, most_rounds: int = 10_000) -> DataFrame:
    """(node, d) from one source on a graph of any size: rounds of relaxation, each one join and one aggregation,
    from the nodes that improved in the round before."""
    both = session.written(edges.select("src", "dst", "w").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")), "edges")
    spark = edges.sparkSession
    known = spark.createDataFrame([(source, 0.0)], "node long, d double")
    fresh = known
    for _ in range(most_rounds):
        offers = fresh.join(both, fresh["node"] == both["src"]).groupBy(F.col("dst").alias("node")).agg(F.min(F.col("d") + F.col("w")).alias("d"))
        merged = session.written(
            known.select("node", "d", F.lit(0).alias("new"))
            .unionAll(offers.select("node", "d", F.lit(1).alias("new")))
            .groupBy("node")
            .agg(F.min(F.struct("d", "new")).alias("m"))
            .select("node", F.col("m.d").alias("d"), F.col("m.new").alias("new")),
            "lengths",
        )
        known, fresh = merged.select("node", "d"), merged.filter("new = 1").select("node", "d")
        if fresh.isEmpty():
            return known
    raise RuntimeError("lengths did not settle")


def tour(d: np.ndarray) -> list[int]:
    """A closed tour over a distance matrix from index 0: nearest neighbour, ties to the lower index, then 2-opt until
    no exchange gains more than 1e-9."""
    n = len(d)
    if n <= 1:
        return [0, 0]
    left, out = list(range(1, n)), [0]
    while left:
        out.append(min(left, key=lambda j: (d[out[-1], j], j)))
        left.remove(out[-1])
    out.append(0)
    improved = True
    while improved:
        improved = False
        for i in range(1, n - 1):
            for j in range(i + 1, n):
                if d[out[i - 1], out[j]] + d[out[i], out[j + 1]] + 1e-9 < d[out[i - 1], out[i]] + d[out[j], out[j + 1]]:
                    out[i : j + 1] = out[i : j + 1][::-1]
                    improved = True
    return out


def persona_targets(targets: DataFrame) -> DataFrame:
    """Targets of each persona: the inspector visits all, the farmer the waste; a missing kind is waste."""
    kind = F.coalesce("kind", F.lit("waste"))
    return targets.withColumn("kind", kind).select("*", F.explode(F.when(F.col("kind") == "waste", F.array(F.lit("inspector"), F.lit("farmer"))).otherwise(F.array(F.lit("inspector")))).alias("persona"))


ROUTE = "persona string, length double, naive double, visited int, unreachable int, closed boolean, points string"


def apart(a: tuple[float, float], b: tuple[float, float], geographic: bool = False) -> float:
    """Distance of two points in the plane, or in metres of two in degrees (longitude, latitude)."""
    if not geographic:
        return math.dist(a, b)
    (lon1, lat1), (lon2, lat2) = (map(math.radians, p) for p in (a, b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * g.EARTH_RADIUS * math.asin(min(1.0, math.sqrt(h)))


def plan_routes(nodes: DataFrame, edges: DataFrame, start: tuple[float, float], targets: DataFrame, cell: float = 4.0, geographic: bool = False) -> DataFrame:
    """A closed route per persona through its targets (persona, id, x, y), from start and back to it.

    Targets are snapped to the nearest node and visited once for each node; what cannot be reached is counted and left
    out. `points` is the stitched line as JSON. The tours of the personas are small tables solved side by side.
    With `geographic`, places and the cell are in degrees of longitude and latitude, and lengths in metres."""
    x_scale = math.cos(math.radians(start[1])) if geographic else 1.0
    spark = nodes.sparkSession
    origin = spark.createDataFrame([(-1, start[0], start[1])], "id long, x double, y double")
    spots = session.written(targets.select("persona", F.xxhash64("persona", F.col("id").cast("string")).alias("id"), "x", "y"), "spots")
    home = nearest(origin, nodes, cell, x_scale).first()
    snapped = spots.select("persona", "id").join(nearest(spots.select("id", "x", "y"), nodes, cell, x_scale).select("id", "node"), "id")
    terminals = snapped.select("node").unionAll(spark.createDataFrame([(home.node,)], "node long")).distinct()
    legs = {(r.a, r.b): (r.d, list(r.path)) for r in shortest_paths(edges, terminals).toLocalIterator()}
    used = spark.createDataFrame([(n,) for n in sorted({n for _, p in legs.values() for n in p} | {home.node})], "node long")
    place = {r.node: (r.x, r.y) for r in nodes.join(F.broadcast(used), "node", "left_semi").toLocalIterator()}

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        asked = [int(n) for n in sorted(set(group["node"]) - {home.node})]
        reached = [n for n in asked if (home.node, n) in legs]
        stops = [home.node, *reached]
        d = np.array([[legs[a, b][0] if (a, b) in legs else math.inf for b in stops] for a in stops])
        order = tour(d)
        line = [home.node]
        for a, b in zip(order, order[1:]):
            line += legs[stops[a], stops[b]][1][1:] if a != b else []
        points = [start, *[place[n] for n in line], start]
        points = [p for i, p in enumerate(points) if not i or p != points[i - 1]]
        length = sum(apart(a, b, geographic) for a, b in zip(points, points[1:]))
        closed = bool(points) and tuple(points[0]) == tuple(points[-1])
        naive = 2 * float(d[0, 1:].sum())
        return pd.DataFrame([[group["persona"].iloc[0], length, naive, len(reached), len(asked) - len(reached), closed, json.dumps(points)]], columns=ROUTE_COLUMNS)

    return snapped.select("persona", "node").distinct().groupBy("persona").applyInPandas(solve, ROUTE)


ROUTE_COLUMNS = ["persona", "length", "naive", "visited", "unreachable", "closed", "points"]


def gates(segments: DataFrame, keys: list[str], end_gap: Column, least_inside: float = 0.98, most_gap: float = 5.0) -> DataFrame:
    """Whether a route's segments (length, inside) lie inside by length and its ends near enough to the start."""
    share = F.sum(F.when(F.col("inside"), F.col("length")).otherwise(0.0)) / F.sum("length")
    return segments.groupBy(*keys).agg(share.alias("inside_share"), F.max(end_gap).alias("end_gap")).withColumn("passed", (F.col("inside_share") >= least_inside) & (F.col("end_gap") <= most_gap))


def valid_start(points: DataFrame, study: DataFrame | None, forbidden: DataFrame) -> DataFrame:
    """(id, valid): inside the study area, which may be unset, and in no forbidden polygon (rings)."""
    nodes = points.select(F.col("id").alias("node"), "x", "y")
    ok = nodes if study is None else walkable_nodes(nodes, study)
    ok = walkable_nodes(ok, forbidden)
    inside = (nodes if study is None else walkable_nodes(nodes, study)).join(ok.select("node"), "node", "left_anti").select(F.col("node").alias("id"), F.lit(True).alias("valid"))
    return points.select("id").join(inside, "id", "left").select("id", F.coalesce("valid", F.lit(False)).alias("valid"))


def mock_targets(nodes: DataFrame, start: int, n: int = 6, seed: int = 42) -> DataFrame:
    """At most n nodes but the start in the order of a seeded hash, inspection and waste by turns."""
    from pyspark.sql import Window

    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("node").cast("string")))
    picked = nodes.filter(F.col("node") != start).orderBy(drawn, "node").limit(n)
    k = F.row_number().over(Window.partitionBy().orderBy(drawn, "node")) - 1
    kind = F.when(F.col("_k") % 2 == 0, "inspection").otherwise("waste")
    prefix = F.when(F.col("_k") % 2 == 0, "MOCK-INSP-").otherwise("MOCK-WASTE-")
    return picked.withColumn("_k", k).select(F.concat(prefix, F.format_string("%02d", F.floor(F.col("_k") / 2))).alias("id"), kind.alias("kind"), "node", "x", "y")
