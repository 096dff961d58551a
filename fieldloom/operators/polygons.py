"""Areas of unions and differences of polygons, without a geometry library.

Axis-aligned boxes are done in window functions. General polygons go through slabs: between two neighbouring vertex or
crossing abscissas no edges cross, so the slab is a stack of trapezoids, and whether one is inside either set follows
by walking the edges upwards.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom import session


def box_slabs(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes (x0, y0, x1, y1) cut at every abscissa at which a box of the group begins or ends: (sx, width, y0, y1), of boxes
    that begin alike in a slab the tallest.

    Both ends of a box are such abscissas, so each box finds by equality the numbers of the slabs it spans."""
    edges = boxes.select(*keys, F.explode(F.array("x0", "x1")).alias("sx")).distinct()
    ordered = Window.partitionBy(*keys).orderBy("sx")
    edges = session.written(edges.withColumns({"ex": F.lead("sx").over(ordered), "_k": F.row_number().over(ordered)}), "slabs")
    slabs = session.small_side(edges)
    b = boxes.select(*keys, "x0", "x1", "y0", "y1")
    for at, k in (("x0", "_i"), ("x1", "_j")):
        b = b.join(slabs.select(*keys, F.col("sx").alias(at), F.col("_k").alias(k)), [*keys, at])
    cut = b.filter("_i < _j").select(*keys, "y0", "y1", F.explode(F.sequence(F.col("_i"), F.col("_j") - 1)).alias("_k"))
    # Boxes of one base in one slab: the tallest covers the others, and few are left before anything is sorted.
    cut = cut.groupBy(*keys, "_k", "y0").agg(F.max("y1").alias("y1"))
    return cut.join(slabs, [*keys, "_k"]).select(*keys, "sx", (F.col("ex") - F.col("sx")).alias("width"), "y0", "y1")


def box_union_area(boxes: DataFrame, keys: list[str], name: str = "area") -> DataFrame:
    """Exact area of the union of each group's boxes: in a slab, each box adds what rises above those before."""
    before = Window.partitionBy(*keys, "sx").orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1)
    raised = box_slabs(boxes, keys).withColumn("_top", F.max("y1").over(before))
    part = F.col("width") * F.greatest(F.lit(0.0), F.col("y1") - F.greatest("y0", F.coalesce("_top", "y0")))
    return raised.groupBy(*keys).agg(F.sum(part).alias(name))


def box_difference_area(strips: DataFrame, boxes: DataFrame, keys: list[str], name: str = "area") -> DataFrame:
    """Area of each strip (id, x0, y0, x1, y1) that no box of its group covers.

    The boxes are clipped to the strip, so the strip's area less their union's is what is left."""
    s = strips.select(*keys, F.col("id"), *[F.col(c).alias(f"s{c}") for c in ("x0", "y0", "x1", "y1")])
    clipped = s.join(boxes.select(*keys, "x0", "y0", "x1", "y1"), keys).select(
        *keys,
        "id",
        F.greatest("sx0", "x0").alias("x0"),
        F.greatest("sy0", "y0").alias("y0"),
        F.least("sx1", "x1").alias("x1"),
        F.least("sy1", "y1").alias("y1"),
    )
    covered = box_union_area(clipped.filter("x0 < x1 AND y0 < y1"), [*keys, "id"], "_covered")
    whole = (F.col("sx1") - F.col("sx0")) * (F.col("sy1") - F.col("sy0"))
    return s.join(covered, [*keys, "id"], "left").select(*keys, "id", (whole - F.coalesce("_covered", F.lit(0.0))).alias(name))


Ring = list[tuple[float, float]]


def _edges(rings: list[Ring], owner: int) -> np.ndarray:
    out = []
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            if ax != bx:
                out.append((ax, ay, bx, by, owner) if ax < bx else (bx, by, ax, ay, owner))
    return np.array(out, np.float64).reshape(-1, 5)


def _abscissas(edges: np.ndarray) -> np.ndarray:
    """Where edges begin, end or cross."""
    xs = [edges[:, 0], edges[:, 2]]
    slope = (edges[:, 3] - edges[:, 1]) / (edges[:, 2] - edges[:, 0])
    base = edges[:, 1] - slope * edges[:, 0]
    order = np.argsort(edges[:, 0], kind="stable")
    starts = edges[order, 0]
    for at, i in enumerate(order):
        rest = order[at + 1 : np.searchsorted(starts, edges[i, 2], "left")]
        turn = slope[i] - slope[rest]
        rest, turn = rest[turn != 0], turn[turn != 0]
        x = (base[rest] - base[i]) / turn
        inside = (x > edges[rest, 0]) & (x < np.minimum(edges[i, 2], edges[rest, 2]))
        xs.append(x[inside])
    return np.unique(np.concatenate(xs))


def trapezoids(polygons: list[tuple[int, list[Ring]]], inside) -> list[tuple[float, float, float, float, float, float]]:
    """(x0, x1, low at x0, high at x0, low at x1, high at x1) of the region where inside(counts of covering polygons
    by owner) holds; each polygon is (owner, rings) and covers by even-odd parity."""
    parts = [_edges(rings, i) for i, (_, rings) in enumerate(polygons)]
    edges = np.concatenate([p for p in parts if len(p)]) if any(map(len, parts)) else np.empty((0, 5))
    if not len(edges):
        return []
    out = []
    xs = _abscissas(edges)
    for x0, x1 in zip(xs, xs[1:]):
        here = edges[(edges[:, 0] <= x0) & (edges[:, 2] >= x1)]
        at = lambda x: here[:, 1] + (here[:, 3] - here[:, 1]) * ((x - here[:, 0]) / (here[:, 2] - here[:, 0]))  # noqa: E731, B023
        order = np.argsort(at((x0 + x1) / 2), kind="stable")
        left, right = at(x0)[order], at(x1)[order]
        odd, counts, low = {}, {}, None
        for k, i in enumerate(here[order, 4].astype(int)):
            was = inside(counts)
            owner = polygons[i][0]
            odd[i] = not odd.get(i, False)
            counts[owner] = counts.get(owner, 0) + (1 if odd[i] else -1)
            now = inside(counts)
            if now and not was:
                low = k
            elif was and not now:
                out.append((x0, x1, left[low], left[k], right[low], right[k]))
    return out


def area_of(parts: list[tuple]) -> float:
    return float(sum((x1 - x0) * ((hl - ll) + (hr - lr)) / 2 for x0, x1, ll, hl, lr, hr in parts))


def union_area(polygons: list[list[Ring]]) -> float:
    """Area of the union of polygons, each a list of rings."""
    return area_of(trapezoids([(0, p) for p in polygons], lambda c: c.get(0, 0) > 0))


def intersection_area(a: list[list[Ring]], b: list[list[Ring]]) -> float:
    return area_of(trapezoids([(0, p) for p in a] + [(1, p) for p in b], lambda c: c.get(0, 0) > 0 and c.get(1, 0) > 0))


def difference(a: list[list[Ring]], b: list[list[Ring]]) -> list[list[tuple]]:
    """The region in a and not in b as connected parts, each a list of trapezoids."""
    pieces = trapezoids([(0, p) for p in a] + [(1, p) for p in b], lambda c: c.get(0, 0) > 0 and not c.get(1, 0))
    label = list(range(len(pieces)))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    ends: dict[float, list[int]] = {}
    for i, p in enumerate(pieces):
        ends.setdefault(p[1], []).append(i)
    for j, p in enumerate(pieces):
        for i in ends.get(p[0], []):
            # Two trapezoids are one part if they share more than a point of the line between them.
            if min(pieces[i][5], p[3]) - max(pieces[i][4], p[2]) > 1e-12:
                label[root(j)] = root(i)
    parts: dict[int, list[tuple]] = {}
    for i, p in enumerate(pieces):
        parts.setdefault(root(i), []).append(p)
    return list(parts.values())


def outline(part: list[tuple], digits: int = 9) -> list[tuple[float, float]]:
    """The outer ring of a connected part of trapezoids, counter-clockwise with y upwards, not closed.

    Every trapezoid's border is walked with the inside on the left; where two share a piece of a vertical line it is walked
    both ways and goes."""
    ends: dict[tuple, list[tuple]] = {}
    uprights: dict[float, list[tuple[float, float, int]]] = {}

    def walk(a: tuple, b: tuple) -> None:
        if a != b:
            ends.setdefault(a, []).append(b)

    for piece in part:
        x0, x1, low0, high0, low1, high1 = (round(v, digits) for v in piece)
        walk((x0, low0), (x1, low1))
        walk((x1, high1), (x0, high0))
        uprights.setdefault(x1, []).append((low1, high1, 1))
        uprights.setdefault(x0, []).append((low0, high0, -1))
    for x, spans in uprights.items():
        ys = sorted({y for low, high, _ in spans for y in (low, high)})
        for low, high in zip(ys, ys[1:]):
            way = sum(sign for a, b, sign in spans if a <= low and high <= b)
            if way:
                walk((x, low), (x, high)) if way > 0 else walk((x, high), (x, low))
    best, area = [], 0.0
    while ends:
        at = start = next(iter(ends))
        ring, heading = [], None
        while True:
            choices = ends[at]
            if heading is None or len(choices) == 1:
                to = choices[0]
            else:
                # Where borders touch, the sharpest turn to the left keeps rings simple.
                turn = lambda p: math.remainder(math.atan2(p[1] - at[1], p[0] - at[0]) - heading, math.tau)  # noqa: E731, B023
                to = max(choices, key=turn)
            choices.remove(to)
            if not choices:
                del ends[at]
            ring.append(at)
            heading, at = math.atan2(to[1] - at[1], to[0] - at[0]), to
            if at == start:
                break
        signed = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]])) / 2
        if signed > area:
            best, area = ring, signed
    out = []
    for before, p, after in zip([best[-1], *best[:-1]] if best else [], best, [*best[1:], *best[:1]]):
        bend = (p[0] - before[0]) * (after[1] - p[1]) - (p[1] - before[1]) * (after[0] - p[0])
        if abs(bend) > 1e-7:
            out.append(p)
    return out


def union_areas(df: DataFrame, keys: list[str], ring: str = "ring", name: str = "area") -> DataFrame:
    """Area of the union of each group's rings (point lists), general polygons."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def area(group: pd.DataFrame) -> pd.DataFrame:
        rings = [[(p["x"], p["y"]) for p in r] for r in group[ring] if r is not None and len(r) >= 3]
        return pd.DataFrame([[*[group[k].iloc[0] for k in keys], union_area([[r] for r in rings])]], columns=[*keys, name])

    return df.select(*keys, ring).groupBy(*keys).applyInPandas(area, f"{kinds}, `{name}` double")


def open_parts(df: DataFrame, keys: list[str], strip: str, cover: DataFrame, ring: str = "ring", least: float = 0.0) -> DataFrame:
    """Parts of each strip that no ring of its group covers: (keys, id, part, area, ring: the outer one), those of at
    least `least`, of strips of at least as much; the largest part of a strip is its part 0."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    id_kind = df.schema["id"].dataType.simpleString()

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        to = lambda r: [(p["x"], p["y"]) for p in r]
        boxes = [(to(r), min(p["x"] for p in r), max(p["x"] for p in r), min(p["y"] for p in r), max(p["y"] for p in r)) for r in right[ring] if r is not None and len(r) >= 3]
        out = []
        for _, row in left.iterrows():
            if row[strip] is None or len(row[strip]) < 3:
                continue
            s = to(row[strip])
            if union_area([[s]]) < least:
                continue
            x0, x1, y0, y1 = min(p[0] for p in s), max(p[0] for p in s), min(p[1] for p in s), max(p[1] for p in s)
            near = [[b[0]] for b in boxes if b[1] < x1 and b[2] > x0 and b[3] < y1 and b[4] > y0]
            found = sorted(((a, outline(part)) for part in difference([[s]], near) if (a := area_of(part)) >= least), reverse=True)
            out += [[*[row[k] for k in keys], row["id"], n, a, [{"x": x, "y": y} for x, y in r]] for n, (a, r) in enumerate(found)]
        return pd.DataFrame(out, columns=[*keys, "id", "part", "area", "ring"])

    # Fresh names on both sides, as they may come of one table.
    df = df.select(*[F.col(c).alias(c) for c in (*keys, "id", strip)])
    cover = cover.select(*[F.col(c).alias(c) for c in (*keys, ring)])
    return df.groupBy(*keys).cogroup(cover.groupBy(*keys)).applyInPandas(cut, f"{kinds}, id {id_kind}, part int, area double, ring array<struct<x: double, y: double>>")
