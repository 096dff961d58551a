"""Raster operators: in SQL where a pixel's value follows from joins and aggregates, else as numpy kernels per tile.

Pixels are rows (tile, x, y, bands). Kernels take and give dense arrays; per_tile() runs one on every tile.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import pixels as px

# ---- In SQL -------------------------------------------------------------------------------------------------------


def block_of(column: str, size: int, blocks: int) -> Column:
    """The grid block of a coordinate; the last one takes the remainder."""
    return F.least(F.floor(F.col(column) / (size // blocks)), F.lit(blocks - 1)).cast("int")


def block_threshold(pixels: DataFrame, value: str, share: float, width: int, height: int, blocks: int = 8) -> DataFrame:
    """(tile, bx, by, threshold): the exact percentile of each block, interpolated."""
    return pixels.groupBy("tile", block_of("x", width, blocks).alias("bx"), block_of("y", height, blocks).alias("byy")).agg(F.percentile(value, F.lit(share)).alias("threshold"))


def block_mask(pixels: DataFrame, value: str, share: float, floor: float, width: int, height: int, blocks: int = 8) -> DataFrame:
    """Pixels above their block's percentile and a fixed floor. The thresholds are few; a tile has blocks squared."""
    limits = block_threshold(pixels, value, share, width, height, blocks)
    here = pixels.withColumns({"bx": block_of("x", width, blocks), "byy": block_of("y", height, blocks)})
    return here.join(limits, ["tile", "bx", "byy"]).filter((F.col(value) > F.col("threshold")) & (F.col(value) > floor)).drop("bx", "byy", "threshold")


def disc(radius: int) -> list[tuple[int, int]]:
    return [(dx, dy) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]


def _moved(mask: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets]))
    return mask.select("tile", "x", "y", near.alias("o")).select("tile", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))


def dilate(mask: DataFrame, radius: int, width: int, height: int) -> DataFrame:
    """Set pixels (tile, x, y) and all within the radius."""
    return _moved(mask, disc(radius)).filter(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)).distinct()


def erode(mask: DataFrame, radius: int, width: int, height: int) -> DataFrame:
    """Set pixels all of whose disc, as far as it lies on the tile, is set."""
    offsets = disc(radius)
    hits = _moved(mask, offsets).groupBy("tile", "x", "y").agg(F.count("*").alias("n"))
    on_tile = sum(
        (F.when((F.col("x") + dx).between(0, width - 1) & (F.col("y") + dy).between(0, height - 1), 1).otherwise(0) for dx, dy in offsets), F.lit(0)
    )
    return hits.filter(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1) & (F.col("n") == on_tile)).select("tile", "x", "y")


def stencil(pixels: DataFrame, value: str, kernel: dict[tuple[int, int], float], name: str) -> DataFrame:
    """Correlation with a sparse kernel; pixels that are missing count as 0. Each pixel is dealt to the places it
    counts for, so one aggregation does it."""
    spread = F.explode(F.array(*[F.struct(F.lit(-dx).alias("dx"), F.lit(-dy).alias("dy"), F.lit(float(w)).alias("w")) for (dx, dy), w in kernel.items()]))
    out = pixels.select("tile", "x", "y", value, spread.alias("s"))
    return out.groupBy("tile", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y")).agg(F.sum(F.col(value) * F.col("s.w")).alias(name))


#: The 5 x 5 Sobel kernels' two factors.
_SLOPE, _ACROSS = (-1, -2, 0, 2, 1), (1, 4, 6, 4, 1)
SOBEL_X = {(x - 2, y - 2): _SLOPE[x] * _ACROSS[y] for y in range(5) for x in range(5) if _SLOPE[x]}
SOBEL_Y = {(x, y): w for (y, x), w in SOBEL_X.items()}


def structure_angle(gradients: DataFrame) -> DataFrame:
    """Dominant line direction of each tile from gradients (gx, gy)."""
    return gradients.groupBy("tile").agg(
        (F.atan2(2 * F.sum(F.col("gx") * F.col("gy")), F.sum(F.col("gx") * F.col("gx")) - F.sum(F.col("gy") * F.col("gy"))) / 2 + math.pi / 2).alias("angle")
    )


def angle_scores(mask: DataFrame, bin_px: float = 6.0, step: float = 0.5) -> DataFrame:
    """(tile, angle, variance): for each angle in steps of half a degree the variance of how many pixels fall into bins
    across it, empty bins included. A tile's pixels move once, and all angles are tried where they are."""
    n = round(180 / step)

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        x, y, out = group["x"].to_numpy(np.float64), group["y"].to_numpy(np.float64), []
        for angle in (k * step for k in range(n)):
            s = np.round(y * math.cos(math.radians(angle)) - x * math.sin(math.radians(angle)), 6)
            counts = np.bincount(np.floor((s - s.min()) / bin_px).astype(np.int64)).astype(np.float64)
            out.append((group["tile"].iloc[0], angle, (counts * counts).sum() / len(counts) - (counts.sum() / len(counts)) ** 2))
        return pd.DataFrame(out, columns=["tile", "angle", "variance"])

    kind = mask.schema["tile"].dataType.simpleString()
    return per_tile(mask.select("tile", "x", "y"), kernel, f"tile {kind}, angle double, variance double")


def best_angle(scores: DataFrame) -> DataFrame:
    """The angle of the greatest variance, the least of equals."""
    best = scores.groupBy("tile").agg(F.min(F.struct((-F.round("variance", 6)).alias("v"), "angle")).alias("m"))
    return best.select("tile", F.col("m.angle").alias("angle"), (-F.col("m.v")).alias("variance"))


def major_axis(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and direction of the greatest spread of each group's pixels, from the sample covariance."""
    return mask.groupBy(*keys).agg(
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        (F.atan2(2 * F.covar_samp("x", "y"), F.var_samp("x") - F.var_samp("y")) / 2).alias("angle"),
        F.count("*").alias("n"),
    )


def centreline(mask: DataFrame, keys: list[str], bins: int = 12, least: int = 15) -> DataFrame:
    """A line of mean points in equal bins along the major axis: (keys, bin, x, y). Pixels on an inner border count in
    both of its bins; bins of few pixels are left out."""
    axes = major_axis(mask, keys)
    placed = mask.join(axes, keys).select(
        *keys,
        "mx",
        "my",
        "angle",
        ((F.col("x") - F.col("mx")) * F.cos("angle") + (F.col("y") - F.col("my")) * F.sin("angle")).alias("t"),
        ((F.col("y") - F.col("my")) * F.cos("angle") - (F.col("x") - F.col("mx")) * F.sin("angle")).alias("s"),
    )
    span = placed.groupBy(*keys).agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    at = F.round((F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")) * bins, 9)
    low = F.least(F.floor(at), F.lit(bins - 1)).cast("int")
    both = F.explode(F.when((at == F.floor(at)) & (at > 0) & (at < bins), F.array(low - 1, low)).otherwise(F.array(low)))
    binned = placed.join(span, keys).filter("t1 > t0").withColumn("bin", both)
    middle = F.col("t0") + (F.col("bin") + 0.5) * (F.col("t1") - F.col("t0")) / bins
    out = binned.groupBy(*keys, "bin", "mx", "my", "angle", "t0", "t1").agg(F.avg("s").alias("s"), F.count("*").alias("n")).filter(F.col("n") >= least)
    return out.select(
        *keys, "bin", (F.col("mx") + middle * F.cos("angle") - F.col("s") * F.sin("angle")).alias("x"), (F.col("my") + middle * F.sin("angle") + F.col("s") * F.cos("angle")).alias("y")
    )


def row_ends(pixels: DataFrame, keys: list[str], along: str, least: int = 20) -> DataFrame:
    """Each row's ends as the first and last percentile of its pixels along it; rows of few pixels are left out."""
    return pixels.groupBy(*keys).agg(F.percentile(along, F.lit(0.01)).alias("t0"), F.percentile(along, F.lit(0.99)).alias("t1"), F.count("*").alias("n")).filter(F.col("n") >= least)


def composite(layers: DataFrame, how: str = "or", count: int | None = None) -> DataFrame:
    """Masks (tile, layer, x, y) of one tile laid over one another: set in any layer, or in all `count` of them."""
    hits = layers.groupBy("tile", "x", "y").agg(F.count_distinct("layer").alias("n"))
    if how == "and":
        if count is None:
            raise ValueError("the number of layers is needed, as an empty layer has no rows")
        hits = hits.filter(F.col("n") == count)
    return hits.select("tile", "x", "y")


def patches(width: int, height: int, side: int = 640, stride: int = 480) -> list[tuple[int, int]]:
    """Upper left corners of overlapping patches, the last ones flush with the edge."""
    starts = lambda n: sorted({*range(0, max(1, n - side + 1), stride), max(0, n - side)})
    return [(x, y) for y in starts(height) for x in starts(width)]


# ---- Kernels on dense arrays ---------------------------------------------------------------------------------------


def gaussian_blur(a: np.ndarray, sigma: float) -> np.ndarray:
    """Separable convolution, mirrored at the edges' middle."""
    radius = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (radius, radius)
        wide = np.pad(a.astype(np.float64), pad, mode="reflect" if a.shape[axis] > 1 else "edge")
        a = sum(w * np.take(wide, range(i, i + a.shape[axis]), axis=axis) for i, w in enumerate(k))
    return a


def dominant_angle(mask: np.ndarray, sigma: float = 9.0) -> float:
    """Direction of the lines in a mask: it is blurred, so that gaps along a line do not count, and the structure tensor of its
    5 x 5 gradients gives the way across them."""
    soft = np.pad(gaussian_blur(mask.astype(np.float64), sigma), 2, mode="reflect")
    h, w = mask.shape
    gx, gy = (sum(v * soft[2 + y : 2 + y + h, 2 + x : 2 + x + w] for (x, y), v in k.items()) for k in (SOBEL_X, SOBEL_Y))
    return math.atan2(2 * (gx * gy).sum(), (gx * gx).sum() - (gy * gy).sum()) / 2 + math.pi / 2


def dominant_angles(pixels: DataFrame, width: int, height: int, sigma: float = 9.0) -> DataFrame:
    """(tile, angle) of the set pixels (tile, x, y) of every tile."""

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        (on,) = dense(group.assign(one=1), width, height, ("one",))
        return pd.DataFrame({"tile": [group["tile"].iloc[0]], "angle": [dominant_angle(on, sigma)]})

    kind = pixels.schema["tile"].dataType.simpleString()
    return per_tile(pixels.select("tile", "x", "y"), kernel, f"tile {kind}, angle double")


def ellipse(size: int) -> list[tuple[int, int]]:
    """Offsets of an elliptic element of so many pixels across, from its middle (the later one of an even size)."""
    r = size // 2
    reach = lambda dy: round(r * math.sqrt((r * r - dy * dy) / (r * r))) if r else 0
    return [(dx, dy) for dy in range(-r, size - r) for dx in range(-r, size - r) if abs(dx) <= reach(dy)]


def _shifted_any(mask: np.ndarray, offsets: list[tuple[int, int]], fill: bool) -> np.ndarray:
    reach = max(max(abs(x), abs(y)) for x, y in offsets)
    wide = np.pad(mask, reach, constant_values=fill)
    views = [wide[reach + y : reach + y + mask.shape[0], reach + x : reach + x + mask.shape[1]] for x, y in offsets]
    return np.logical_or.reduce(views) if not fill else np.logical_and.reduce(views)


def closing(mask: np.ndarray, offsets: list[tuple[int, int]]) -> np.ndarray:
    return _shifted_any(_shifted_any(mask, offsets, False), [(-x, -y) for x, y in offsets], True)


def opening(mask: np.ndarray, offsets: list[tuple[int, int]]) -> np.ndarray:
    return _shifted_any(_shifted_any(mask, offsets, True), [(-x, -y) for x, y in offsets], False)


def line_offsets(angle: float, length: int = 41, thickness: int = 3) -> list[tuple[int, int]]:
    """A line element at an angle, for closing gaps along rows."""
    out = set()
    for t in np.linspace(-length / 2, length / 2, 2 * length):
        for s in range(-(thickness // 2), thickness // 2 + 1):
            out.add((round(t * math.cos(angle) - s * math.sin(angle)), round(t * math.sin(angle) + s * math.cos(angle))))
    return sorted(out)


def label(mask: np.ndarray, eight: bool = True) -> tuple[np.ndarray, int]:
    """Connected components by runs and union-find: labels 1.. in reading order, 0 for unset."""
    parent = [0]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, before, slack = np.zeros(mask.shape, np.int64), [], 1 if eight else 0
    for y, line in enumerate(mask):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], line.astype(np.int8), [0]])))
        now = []
        for a, b in zip(edges[::2], edges[1::2]):
            parent.append(len(parent))
            me = len(parent) - 1
            for c, d, other in before:
                if c < b + slack and a < d + slack:
                    lo, hi = sorted((root(me), root(other)))
                    parent[hi] = lo
            now.append((a, b, me))
            out[y, a:b] = me
        before = now
    roots = np.array([root(i) for i in range(len(parent))])
    names = np.zeros(len(parent), np.int64)
    kept = np.unique(roots[1:]) if len(roots) > 1 else []
    names[kept] = np.arange(1, len(kept) + 1)
    return names[roots][out], len(kept)


def remove_sizes(mask: np.ndarray, least: int = 0, most: float = math.inf) -> np.ndarray:
    """Without the components that are smaller or larger than allowed."""
    labels, n = label(mask)
    sizes = np.bincount(labels.ravel(), minlength=n + 1)
    good = (sizes >= least) & (sizes <= most)
    good[0] = False
    return good[labels]


def distance_transform(mask: np.ndarray) -> np.ndarray:
    """Exact Euclidean distance of each set pixel to the nearest unset one on the array, by two passes of parabolas'
    lower envelopes."""
    far = float(mask.shape[0] ** 2 + mask.shape[1] ** 2)
    f = np.where(mask, far, 0.0)
    for axis in (0, 1):
        n = f.shape[axis]
        lines = np.moveaxis(f, axis, 0)
        q = np.arange(n, dtype=np.float64)
        squares = (q[:, None] - q[None]) ** 2
        f = np.moveaxis(np.stack([(lines + squares[i][:, None]).min(axis=0) for i in range(n)]), 0, axis)
    return np.sqrt(f)


def grey_dilate(a: np.ndarray, radius: int) -> np.ndarray:
    wide = np.pad(a, radius, constant_values=-np.inf)
    return np.max([wide[radius + y : radius + y + a.shape[0], radius + x : radius + x + a.shape[1]] for x, y in disc(radius)], axis=0)


def adaptive_radius(distance: np.ndarray, low: int = 24, high: int = 50, share: float = 0.6) -> int:
    """A seed radius from the median of the distances that are not 0."""
    some = distance[distance > 0]
    return int(min(high, max(low, int(share * np.median(some))))) if len(some) else low


def seeds(distance: np.ndarray, radius: int, share: float = 0.08) -> tuple[np.ndarray, int]:
    """Labelled local maxima of a distance map above a share of its greatest value."""
    top = (distance == grey_dilate(distance, radius)) & (distance > share * distance.max())
    return label(top, eight=False)


def watershed(height: np.ndarray, markers: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Flood from markers, lowest pixels first, equals in the order met; unmasked pixels stay 0."""
    out, heap, n = np.where(mask, markers, 0), [], 0
    for y, x in zip(*np.nonzero(out)):
        heap.append((height[y, x], n, y, x))
        n += 1
    heapq.heapify(heap)
    while heap:
        _, _, y, x = heapq.heappop(heap)
        for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)):
            v, u = y + dy, x + dx
            if 0 <= v < out.shape[0] and 0 <= u < out.shape[1] and mask[v, u] and not out[v, u]:
                out[v, u] = out[y, x]
                heapq.heappush(heap, (height[v, u], n, v, u))
                n += 1
    return out


def contour(mask: np.ndarray) -> list[tuple[int, int]]:
    """The outer border of the first component met, as pixel corners in order: every edge between a set pixel and an
    unset one runs with the set one on its right."""
    wide = np.pad(mask.astype(bool), 1)
    first = np.argwhere(wide)
    if not len(first):
        return []
    y, x = map(int, first[0])
    start = at = (x, y)
    heading, out = (1, 0), []
    while True:
        out.append((at[0] - 1, at[1] - 1))
        ax, ay = at
        # The four pixels around a corner: turn left if that one is set, straight on, or right.
        for turn in ((heading[1], -heading[0]), heading, (-heading[1], heading[0]), (-heading[0], -heading[1])):
            dx, dy = turn
            right = {(1, 0): (ax, ay), (0, 1): (ax - 1, ay), (-1, 0): (ax - 1, ay - 1), (0, -1): (ax, ay - 1)}[turn]
            left = {(1, 0): (ax, ay - 1), (0, 1): (ax, ay), (-1, 0): (ax - 1, ay), (0, -1): (ax - 1, ay - 1)}[turn]
            if wide[right[1], right[0]] and not wide[left[1], left[0]]:
                heading, at = turn, (ax + dx, ay + dy)
                break
        if at == start:
            return out


def simplify(points: list[tuple[float, float]], epsilon: float) -> list[tuple[float, float]]:
    """Douglas-Peucker on a stack: a run is split at its farthest point while that is farther than epsilon."""
    if len(points) < 3:
        return list(points)
    p = np.array(points, np.float64)
    keep, todo = {0, len(p) - 1}, [(0, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        chord, mid = p[b] - p[a], p[a + 1 : b] - p[a]
        n = math.hypot(*chord)
        off = np.abs(mid[:, 0] * chord[1] - mid[:, 1] * chord[0]) / n if n else np.hypot(mid[:, 0], mid[:, 1])
        far = int(np.argmax(off))
        if off[far] > epsilon:
            keep.add(a + 1 + far)
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return [tuple(map(float, p[i])) for i in sorted(keep)]


def simplify_ring(points: list[tuple[float, float]], share: float) -> list[tuple[float, float]]:
    """Simplify a closed outline by a share of its perimeter."""
    ring = [*points, points[0]]
    return simplify(ring, share * sum(math.dist(a, b) for a, b in zip(ring, ring[1:])))[:-1]


def ring_pixels(ring: list[tuple[float, float]], width: int, height: int) -> np.ndarray:
    """Mask of the pixels whose centres lie in a ring, by even-odd crossings."""
    ys, xs = np.mgrid[0:height, 0:width] + 0.5
    out = np.zeros((height, width), bool)
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        if ay != by:
            out ^= ((ay > ys) != (by > ys)) & (xs < (bx - ax) * (ys - ay) / (by - ay) + ax)
    return out


def merge_collinear(lines: list[list[tuple[float, float]]], gap: float = 90.0, turn: float = 12.0, epsilon: float = 8.0) -> list[list[tuple[float, float]]]:
    """Join lines whose ends are near and whose headings agree, until none can be: the first pair in order joins, its
    points sorted along the first one's heading and simplified."""
    heading = lambda line: math.atan2(line[-1][1] - line[0][1], line[-1][0] - line[0][0]) % math.pi
    out = [list(line) for line in lines]
    while True:
        pair = next(
            (
                (i, j)
                for i in range(len(out))
                for j in range(i + 1, len(out))
                if min(math.dist(p, q) for p in (out[i][0], out[i][-1]) for q in (out[j][0], out[j][-1])) <= gap
                and min((d := abs(heading(out[i]) - heading(out[j])) % math.pi), math.pi - d) <= math.radians(turn)
            ),
            None,
        )
        if pair is None:
            return out
        i, j = pair
        a = heading(out[i])
        out[i] = simplify(sorted(out[i] + out[j], key=lambda p: p[0] * math.cos(a) + p[1] * math.sin(a)), epsilon)
        del out[j]


def merged_lines(rows: DataFrame, gap: float = 90.0, turn: float = 12.0, epsilon: float = 8.0) -> DataFrame:
    """(tile, row, points): each tile's lines (tile, row, points) after merge_collinear, renumbered; a tile has few lines."""
    kind = rows.schema["tile"].dataType.simpleString()

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        lines = [[(p["x"], p["y"]) for p in points] for points in group.sort_values("row")["points"] if points is not None and len(points) >= 2]
        merged = merge_collinear(lines, gap, turn, epsilon)
        return pd.DataFrame({"tile": group["tile"].iloc[0], "row": range(len(merged)), "points": [[{"x": x, "y": y} for x, y in line] for line in merged]})

    return per_tile(rows.select("tile", "row", "points"), kernel, f"tile {kind}, row int, points array<struct<x: double, y: double>>")


def keep_apart(points: list[tuple[float, float]], least: float) -> list[int]:
    """Indices of the points that are at least that far from every one kept before them."""
    kept: list[int] = []
    for i, p in enumerate(points):
        if all(math.dist(p, points[k]) >= least for k in kept):
            kept.append(i)
    return kept


def closed_along(pixels: DataFrame, width: int, height: int, length: int = 41, thickness: int = 3) -> DataFrame:
    """Set pixels (tile, x, y) after gaps along each tile's dominant direction are closed, by a line element."""
    kind = pixels.schema["tile"].dataType.simpleString()

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        (on,) = dense(group.assign(one=1), width, height, ("one",))
        ys, xs = closing(on > 0, line_offsets(dominant_angle(on), length, thickness)).nonzero()
        return pd.DataFrame({"tile": group["tile"].iloc[0], "x": xs, "y": ys})

    return per_tile(pixels.select("tile", "x", "y"), kernel, f"tile {kind}, x int, y int")


#: The parameters of the second way to crowns, which has no colour gate, and to covers.
VARIANT_CROWNS = {"least": 130, "most": 9000, "share": 0.38, "epsilon": 0.008}
VARIANT_GREEN, VARIANT_LEAST_PIXELS = 25.0, 1


def crowns(green: np.ndarray, mask: np.ndarray, least: int = 240, most: int = 12800, share: float = 0.08, epsilon: float = 0.004, radius: int | None = None) -> list[dict]:
    """Crown outlines of one tile: close and open the mask with elements of 4 and 2 pixels across, drop blobs of over `most`, split touching crowns by a watershed
    from the distance map's peaks, trace and simplify."""
    clean = remove_sizes(opening(closing(mask, ellipse(4)), ellipse(2)), most=most)
    if not clean.any():
        return []
    d = distance_transform(clean)
    markers, n = seeds(d, radius or adaptive_radius(d), share)
    regions = watershed(-green.astype(np.float64), markers, clean)
    out = []
    for k in range(1, n + 1):
        own = regions == k
        size = int(own.sum())
        if least <= size <= most:
            outline = contour(own)
            # The outline's area is less than the pixels where a crown falls apart.
            area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(outline, [*outline[1:], outline[0]]))) / 2
            ring = simplify_ring(outline, epsilon)
            if area >= least and len(ring) >= 3:
                out.append({"pixels": size, "ring": ring})
    return out


def distinct_crowns(found: DataFrame, least: float = 15.0) -> DataFrame:
    """Crowns (tile, crown, ring) without those whose vertex mean is nearer than `least` to one kept before, in the order
    of `crown`; a tile has few crowns."""
    kind = found.schema["tile"].dataType.simpleString()

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("crown").reset_index(drop=True)
        middle = [tuple(np.mean([(p["x"], p["y"]) for p in ring], axis=0)) for ring in group["ring"]]
        return group.iloc[keep_apart(middle, least)]

    rings = found.filter("size(ring) > 0").select("tile", "crown", "ring")
    return per_tile(rings, kernel, f"tile {kind}, crown int, ring array<struct<x: double, y: double>>")


def blob_prompts(mask: np.ndarray, least: float = 120.0, most: int = 300) -> list[tuple[float, float]]:
    """Centroids of a mask's 8-connected blobs of at least `least` pixels, in reading order; of more than `most` blobs
    the largest ones, largest first."""
    labels, n = label(mask)
    sizes = np.bincount(labels.ravel(), minlength=n + 1)
    kept = [k for k in range(1, n + 1) if sizes[k] >= least]
    if len(kept) > most:
        kept = sorted(kept, key=lambda k: (-sizes[k], -k))[:most]
    return [(float(xs.mean()), float(ys.mean())) for k in kept for ys, xs in [np.nonzero(labels == k)]]


def prompted_crowns(green: np.ndarray, answers: list[np.ndarray], least: float = 240.0, most: float = 12800.0, epsilon: float = 0.004, apart: float = 15.0) -> list[list[tuple[float, float]]]:
    """Crown outlines from a prompted model's masks (probabilities): over one half, on green only, of the largest part
    the outline, within the area's bounds, and not where an earlier one has its middle."""
    rings = []
    for answer in answers:
        on = (answer > 0.5) & green
        labels, n = label(on)
        outlines = [contour(labels == k) for k in range(1, n + 1)]
        area = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, [*r[1:], r[0]]))) / 2
        ring = max(outlines, key=area, default=None)
        if ring and least <= area(ring) <= most and len(simple := simplify_ring(ring, epsilon)) >= 3:
            rings.append(simple)
    return [rings[i] for i in keep_apart([tuple(np.mean(r, axis=0)) for r in rings], apart)]


def prompt_crowns(pixels: DataFrame, load, width: int, height: int, **limits) -> DataFrame:
    """(tile, crown, ring) of every tile by a prompted model, called once a worker: load() gives a function of an image
    (height x width x 3) and point prompts that returns a mask of probabilities for each. pixels carry `on`, the green mask."""
    kind = pixels.schema["tile"].dataType.simpleString()
    model = []

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        if not model:
            model.append(load())
        r, g, b, on = dense(group, width, height, ("r", "g", "b", "on"))
        prompts = blob_prompts(on > 0)
        rings = prompted_crowns(on > 0, model[0](np.stack([r, g, b], axis=2), prompts), **limits) if prompts else []
        return pd.DataFrame({"tile": group["tile"].iloc[0], "crown": range(len(rings)), "ring": [[{"x": x, "y": y} for x, y in ring] for ring in rings]})

    return per_tile(pixels, kernel, f"tile {kind}, crown int, ring array<struct<x: double, y: double>>")


def infer_patches(pixels: DataFrame, load, width: int, height: int, side: int = 640, stride: int = 480) -> DataFrame:
    """(tile, x, y) that a model sets on any of a tile's overlapping patches: load() gives a function of a patch
    (height x width x 3) that returns its mask, and is called once a worker."""
    kind = pixels.schema["tile"].dataType.simpleString()
    model = []

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        if not model:
            model.append(load())
        image, out = np.stack(dense(group, width, height, ("r", "g", "b")), axis=2), np.zeros((height, width), bool)
        for x, y in patches(width, height, side, stride):
            out[y : y + side, x : x + side] |= np.asarray(model[0](image[y : y + side, x : x + side])) > 0
        ys, xs = out.nonzero()
        return pd.DataFrame({"tile": group["tile"].iloc[0], "x": xs, "y": ys})

    return per_tile(pixels.select("tile", "x", "y", "r", "g", "b"), kernel, f"tile {kind}, x int, y int")


def dense(group: pd.DataFrame, width: int, height: int, bands: tuple[str, ...]) -> list[np.ndarray]:
    out = []
    for b in bands:
        a = np.zeros((height, width), np.float64)
        a[group["y"], group["x"]] = group[b]
        out.append(a)
    return out


def per_tile(pixels: DataFrame, kernel, schema: str) -> DataFrame:
    """Run a kernel (a tile's pixels as pandas to rows) on every tile; a tile is a bounded group."""
    return pixels.groupBy("tile").applyInPandas(kernel, schema)


def green_mask(pixels: DataFrame, width: int, height: int, share: float = 0.87, floor: float = 15.0, gate: bool = True) -> DataFrame:
    """(tile, x, y, r, g, b, exg) of the pixels that are greener than their block's percentile and, with the gate, of a
    plant's colour."""
    green = pixels.withColumn("exg", px.raw_excess_green(F.col("r"), F.col("g"), F.col("b")))
    mask = block_mask(green, "exg", share, floor, width, height)
    return mask.filter(px.green_gate(F.col("r"), F.col("g"), F.col("b"))) if gate else mask


def ring_shares(rings: DataFrame, pixels: DataFrame, least_green: float = 20.0) -> DataFrame:
    """(tile, id, n, share): how many pixels (tile, x, y, r, g, b) have their centre in a ring (tile, id, ring), and which
    share of them is green. Rings of tiles without pixels are left out; a tile's rings and pixels are bounded."""
    kind, id_kind = (rings.schema[c].dataType.simpleString() for c in ("tile", "id"))

    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(right):
            height, width = int(right["y"].max()) + 1, int(right["x"].max()) + 1
            r, g, b, there = dense(right.assign(there=1), width, height, ("r", "g", "b", "there"))
            green = 2 * g - r - b > least_green
            for tile, name, ring in zip(left["tile"], left["id"], left["ring"]):
                xs, ys = [p["x"] for p in ring], [p["y"] for p in ring]
                x0, y0 = max(0, math.floor(min(xs))), max(0, math.floor(min(ys)))
                x1, y1 = min(width, math.ceil(max(xs)) + 1), min(height, math.ceil(max(ys)) + 1)
                n = hits = 0
                if x0 < x1 and y0 < y1:
                    on = ring_pixels([(x - x0, y - y0) for x, y in zip(xs, ys)], x1 - x0, y1 - y0) & (there[y0:y1, x0:x1] > 0)
                    n, hits = int(on.sum()), int((on & green[y0:y1, x0:x1]).sum())
                out.append((tile, name, n, hits / n if n else None))
        return pd.DataFrame(out, columns=["tile", "id", "n", "share"])

    left, right = rings.filter("size(ring) >= 3").select("tile", "id", "ring"), pixels.select("tile", "x", "y", "r", "g", "b")
    return left.groupBy("tile").cogroup(right.groupBy("tile")).applyInPandas(kernel, f"tile {kind}, id {id_kind}, n long, share double")


def segment_crowns(pixels: DataFrame, width: int, height: int, quantile: float = 0.87, floor: float = 15.0, gate: bool = True, **limits) -> DataFrame:
    """Crown polygons (tile, crown, pixels, ring) of every tile from its bands: block-percentile mask, colour gate in
    SQL, then the crown kernel with its limits (the second way: gate=False, **VARIANT_CROWNS)."""
    green = pixels.withColumn("exg", px.raw_excess_green(F.col("r"), F.col("g"), F.col("b")))
    mask = green_mask(pixels, width, height, quantile, floor, gate)
    flagged = green.join(mask.select("tile", "x", "y", F.lit(1).alias("on")), ["tile", "x", "y"], "left").select("tile", "x", "y", "exg", F.coalesce("on", F.lit(0)).alias("on"))

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        exg, on = dense(group, width, height, ("exg", "on"))
        found = crowns(exg, on > 0, **limits)
        rows = [(group["tile"].iloc[0], i, c["pixels"], [{"x": x, "y": y} for x, y in c["ring"]]) for i, c in enumerate(found)]
        return pd.DataFrame(rows, columns=["tile", "crown", "pixels", "ring"])

    kind = pixels.schema["tile"].dataType.simpleString()
    return per_tile(flagged, kernel, f"tile {kind}, crown int, pixels int, ring array<struct<x: double, y: double>>")


def infer(tiles: DataFrame, load, schema: str) -> DataFrame:
    """Run a pluggable model on tiles: load() gives a function of a pandas batch and is called once a worker."""

    def run(batches):
        model = load()
        for batch in batches:
            yield model(batch)

    return tiles.mapInPandas(run, schema)


def resample(pixels: DataFrame, targets: DataFrame) -> DataFrame:
    """Bilinear values of target points (tile, tx, ty, sx, sy) from the pixels (tile, x, y, v) of their source place."""
    fx, fy = F.floor("sx"), F.floor("sy")
    corners = F.array(
        *[
            F.struct((fx + dx).cast("int").alias("x"), (fy + dy).cast("int").alias("y"), ((F.col("sx") - fx if dx else 1 - (F.col("sx") - fx)) * (F.col("sy") - fy if dy else 1 - (F.col("sy") - fy))).alias("w"))
            for dx in (0, 1)
            for dy in (0, 1)
        ]
    )
    asked = targets.select("tile", "tx", "ty", F.explode(corners).alias("c")).select("tile", "tx", "ty", "c.*")
    return asked.join(pixels.select("tile", "x", "y", "v"), ["tile", "x", "y"]).groupBy("tile", "tx", "ty").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("v"))
