"""Queries of raster operators and of scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import pixels as px
from fieldloom.operators import evaluate, raster, stitching
from fieldloom.operators.measure import cover_class
from fieldloom.sources import tiles

from . import fixtures as fx
from .catalogue import query


def frame(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.PX).withColumn("exg", px.raw_excess_green(F.col("r"), F.col("g"), F.col("b")))


_MASK = """e AS (SELECT *, 2 * g - r - b AS exg, least(x // 8, 7) AS bx, least(y // 8, 7) AS byy FROM px),
lim AS (SELECT tile, bx, byy, quantile_cont(exg, 0.87) AS t FROM e GROUP BY 1, 2, 3),
m AS (SELECT e.tile, e.x, e.y, e.exg FROM e JOIN lim USING (tile, bx, byy) WHERE exg > t AND exg > 15)"""


def masked(spark, sf_dir):
    return raster.block_mask(frame(spark, sf_dir), "exg", 0.87, 15, 64, 64)


@query("q48_block_mask", fx.with_fixtures(f"WITH {_MASK} SELECT tile, x, y, exg FROM m"))
def block_mask(spark, sf_dir):
    return masked(spark, sf_dir).select("tile", "x", "y", "exg")


@query("q48b_excess_green", fx.with_fixtures("SELECT tile, x, y, least(greatest(2 * g - r - b, 0), 255) AS green FROM px WHERE r + g + b > 0"))
def excess_green(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX).filter(px.covered(F.col("r"), F.col("g"), F.col("b")))
    return p.select("tile", "x", "y", px.excess_green(F.col("r"), F.col("g"), F.col("b")).alias("green"))


@query(
    "q49_colour_gate",
    fx.with_fixtures(
        """WITH a AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM px),
        h AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN v = r THEN 60.0::DOUBLE * (g - b) / d WHEN v = g THEN 120 + 60.0::DOUBLE * (b - r) / d ELSE 240 + 60.0::DOUBLE * (r - g) / d END AS raw FROM a),
        s AS (SELECT *, CAST(floor(CASE WHEN raw < 0 THEN raw + 360 ELSE raw END / 2 + 0.5) AS INTEGER) % 180 AS hue, CASE WHEN v = 0 THEN 0 ELSE CAST(floor(d * 255.0::DOUBLE / v + 0.5) AS INTEGER) END AS sat FROM h)
        SELECT tile, x, y, hue, sat, v AS val FROM s WHERE hue BETWEEN 15 AND 55 AND sat >= 30 AND v >= 25"""
    ),
)
def colour_gate(spark, sf_dir):
    bands = [F.col(c) for c in "rgb"]
    h, s, v = px.hsv(*bands)
    return fx.frame(spark, sf_dir, fx.PX).filter(px.green_gate(*bands)).select("tile", "x", "y", h.alias("hue"), s.alias("sat"), v.alias("val"))


@query(
    "q50_best_angle",
    fx.with_fixtures(
        """WITH p AS (SELECT tile, x, y, k * 0.5::DOUBLE AS angle FROM px, range(360) t(k) WHERE g > 200),
        s AS (SELECT *, round(y * cos(radians(angle)) - x * sin(radians(angle)), 6) AS s FROM p), l AS (SELECT tile, angle, min(s) AS low FROM s GROUP BY 1, 2),
        c AS (SELECT s.tile, s.angle, floor((s - low) / 6) AS bin, count(*) AS c FROM s JOIN l ON s.tile = l.tile AND s.angle = l.angle GROUP BY 1, 2, 3),
        v AS (SELECT tile, angle, round(sum(c * c) / (max(bin) + 1) - (sum(c) / (max(bin) + 1)) ** 2, 6) AS variance FROM c GROUP BY 1, 2)
        SELECT tile, arg_min(angle, (-variance, angle)) AS angle, max(variance) AS variance FROM v GROUP BY 1"""
    ),
)
def best_angle(spark, sf_dir):
    """Of 360 angles the one across which pixels bunch most."""
    return raster.best_angle(raster.angle_scores(frame(spark, sf_dir).filter("g > 200").select("tile", "x", "y")))


_DISC = "o(dx, dy) AS (SELECT a - 2, b - 2 FROM range(5) t(a), range(5) u(b) WHERE (a - 2) ** 2 + (b - 2) ** 2 <= 4)"


@query(
    "q51_dilate_erode",
    fx.with_fixtures(
        f"""WITH m AS (SELECT tile, x, y FROM px WHERE g > 120), {_DISC}, grid AS (SELECT tile, a AS x, b AS y FROM (SELECT DISTINCT tile FROM m), range(64) t(a), range(64) u(b)),
        d AS (SELECT DISTINCT m.tile, m.x + dx AS x, m.y + dy AS y FROM m, o WHERE m.x + dx BETWEEN 0 AND 63 AND m.y + dy BETWEEN 0 AND 63),
        e AS (SELECT g.tile, g.x, g.y FROM grid g, o WHERE g.x + dx BETWEEN 0 AND 63 AND g.y + dy BETWEEN 0 AND 63 GROUP BY 1, 2, 3
          HAVING count(*) = count(*) FILTER (WHERE (g.tile, g.x + dx, g.y + dy) IN (SELECT (tile, x, y) FROM d)))
        SELECT 'dilated' AS step, tile, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM d UNION ALL SELECT 'closed', tile, CAST(x AS INTEGER), CAST(y AS INTEGER) FROM e"""
    ),
)
def dilate_erode(spark, sf_dir):
    mask = frame(spark, sf_dir).filter("g > 120").select("tile", "x", "y")
    grown = raster.dilate(mask, 2, 64, 64)
    step = lambda df, name: df.select(F.lit(name).alias("step"), "tile", "x", "y")
    return step(grown, "dilated").unionAll(step(raster.erode(grown, 2, 64, 64), "closed"))


_SOBEL = {n: ", ".join(f"({dx}, {dy}, {w})" for (dx, dy), w in k.items()) for n, k in (("x", raster.SOBEL_X), ("y", raster.SOBEL_Y))}


@query(
    "q52_structure_tensor",
    fx.with_fixtures(
        f"""WITH kx(dx, dy, w) AS (VALUES {_SOBEL["x"]}), ky(dx, dy, w) AS (VALUES {_SOBEL["y"]}),
        gx AS (SELECT tile, x - dx AS x, y - dy AS y, sum(g * w)::DOUBLE AS v FROM px, kx GROUP BY 1, 2, 3), gy AS (SELECT tile, x - dx AS x, y - dy AS y, sum(g * w)::DOUBLE AS v FROM px, ky GROUP BY 1, 2, 3)
        SELECT gx.tile, round(0.5 * atan2(2 * sum(gx.v * gy.v), sum(gx.v * gx.v) - sum(gy.v * gy.v)) + pi() / 2, 6) AS angle FROM gx JOIN gy ON gx.tile = gy.tile AND gx.x = gy.x AND gx.y = gy.y GROUP BY 1"""
    ),
)
def structure_tensor(spark, sf_dir):
    p = frame(spark, sf_dir)
    both = raster.stencil(p, "g", raster.SOBEL_X, "gx").join(raster.stencil(p, "g", raster.SOBEL_Y, "gy"), ["tile", "x", "y"])
    return raster.structure_angle(both).withColumn("angle", F.round("angle", 6))


_HOLE = "h AS (SELECT tile, x, y FROM px WHERE g <= 60), s AS (SELECT tile, a AS x, b AS y FROM (SELECT DISTINCT tile FROM h), range(64) t(a), range(64) u(b))"


@query(
    "q53_distance_transform",
    fx.with_fixtures(
        f"""WITH {_HOLE} SELECT s.tile, CAST(s.x AS INTEGER) AS x, CAST(s.y AS INTEGER) AS y, round(sqrt(min((s.x - h.x) ** 2 + (s.y - h.y) ** 2)), 6) AS d FROM s JOIN h ON s.tile = h.tile GROUP BY 1, 2, 3
        HAVING min((s.x - h.x) ** 2 + (s.y - h.y) ** 2) > 0"""
    ),
)
def distance_transform(spark, sf_dir):
    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        (holes,) = raster.dense(group.assign(one=1), 64, 64, ("one",))
        d = raster.distance_transform(holes == 0)
        ys, xs = (d > 0).nonzero()
        return pd.DataFrame({"tile": group["tile"].iloc[0], "x": xs, "y": ys, "d": d[ys, xs].round(6)})

    holes = frame(spark, sf_dir).filter("g <= 60").select("tile", "x", "y")
    return raster.per_tile(holes, kernel, "tile int, x int, y int, d double")


_CC = """p AS (SELECT tile, x, y, CAST(tile AS BIGINT) * 4096 + y * 64 + x AS id FROM px WHERE g > 215), e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.tile = b.tile AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
reach AS (SELECT id AS node, id AS seen FROM p UNION SELECT r.node, e.b FROM reach r JOIN e ON r.seen = e.a), c AS (SELECT node, min(seen) AS blob FROM reach GROUP BY node)"""
_BLOBS = f"WITH RECURSIVE {_CC} SELECT blob, count(*) AS n, round(avg(x), 6) AS mx, round(avg(y), 6) AS my FROM c JOIN p ON node = id GROUP BY blob HAVING count(*) >= 3"


@query("q54_blobs", fx.with_fixtures(_BLOBS))
def blobs(spark, sf_dir):
    """Components of set pixels as a graph, 8-connected, with size and centroid."""
    p = frame(spark, sf_dir).filter("g > 215").select("tile", "x", "y", (F.col("tile").cast("long") * 4096 + F.col("y") * 64 + F.col("x")).alias("id"))
    near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (0, 1), (1, 1), (-1, 1))]))
    asked = p.select(F.col("id").alias("a"), "tile", "x", "y", near.alias("o")).select("a", "tile", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))
    edges = asked.join(p.withColumnRenamed("id", "b"), ["tile", "x", "y"]).select("a", "b")
    out = stitching.labelled(p, edges, "blob").groupBy("blob").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mx"), F.round(F.avg("y"), 6).alias("my"))
    return out.filter("n >= 3")


@query("q54b_blobs_by_kernel", fx.with_fixtures(f"WITH RECURSIVE {_CC} SELECT CAST(blob // 4096 AS INTEGER) AS tile, count(*) AS n FROM c GROUP BY blob HAVING count(*) >= 3"))
def blobs_by_kernel(spark, sf_dir):
    """The same by the run-length kernel on whole tiles."""

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        (on,) = raster.dense(group.assign(one=1), 64, 64, ("one",))
        labels, n = raster.label(on > 0)
        sizes = pd.Series(labels.ravel()).value_counts().drop(0, errors="ignore")
        return pd.DataFrame({"tile": group["tile"].iloc[0], "n": sizes[sizes >= 3].to_numpy()})

    return raster.per_tile(frame(spark, sf_dir).filter("g > 215").select("tile", "x", "y"), kernel, "tile int, n long")


_AXIS = """m AS (SELECT tile, y // 16 AS row, x, y FROM px WHERE g > 100 AND y % 16 BETWEEN 5 AND 9), a AS (SELECT tile, row, avg(x) AS mx, avg(y) AS my, 0.5 * atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) AS angle FROM m GROUP BY 1, 2),
t AS (SELECT m.tile, m.row, mx, my, angle, (x - mx) * cos(angle) + (y - my) * sin(angle) AS t, (y - my) * cos(angle) - (x - mx) * sin(angle) AS s FROM m JOIN a ON m.tile = a.tile AND m.row = a.row),
r AS (SELECT tile, row, min(t) AS t0, max(t) AS t1 FROM t GROUP BY 1, 2)"""


@query(
    "q55_centreline",
    fx.with_fixtures(
        f"""WITH {_AXIS}, f AS (SELECT t.*, t0, t1, round((t - t0) / (t1 - t0) * 12, 9) AS p FROM t JOIN r ON t.tile = r.tile AND t.row = r.row),
        b AS (SELECT *, CAST(least(floor(p), 11) AS INTEGER) AS bin FROM f UNION ALL SELECT *, CAST(p AS INTEGER) - 1 FROM f WHERE p = floor(p) AND p > 0 AND p < 12)
        SELECT tile, CAST(row AS INTEGER) AS row, bin, round(avg(mx) + (avg(t0) + (bin + 0.5) * (avg(t1) - avg(t0)) / 12) * cos(avg(angle)) - avg(s) * sin(avg(angle)), 3) AS x,
        round(avg(my) + (avg(t0) + (bin + 0.5) * (avg(t1) - avg(t0)) / 12) * sin(avg(angle)) + avg(s) * cos(avg(angle)), 3) AS y FROM b GROUP BY 1, 2, 3 HAVING count(*) >= 5"""
    ),
)
def centreline(spark, sf_dir):
    rows = frame(spark, sf_dir).filter("g > 100 AND y % 16 BETWEEN 5 AND 9").select("tile", F.floor(F.col("y") / 16).cast("int").alias("row"), "x", "y")
    return raster.centreline(rows, ["tile", "row"], 12, 5).select("tile", "row", "bin", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(
    "q55b_row_ends",
    fx.with_fixtures("SELECT tile, CAST(y // 16 AS INTEGER) AS row, round(quantile_cont(x, 0.01), 6) AS t0, round(quantile_cont(x, 0.99), 6) AS t1, count(*) AS n FROM px WHERE g > 100 GROUP BY 1, 2 HAVING count(*) >= 20"),
)
def row_ends(spark, sf_dir):
    rows = frame(spark, sf_dir).filter("g > 100").select("tile", F.floor(F.col("y") / 16).cast("int").alias("row"), F.col("x").cast("double").alias("x"))
    return raster.row_ends(rows, ["tile", "row"], "x").withColumns({"t0": F.round("t0", 6), "t1": F.round("t1", 6)})


@query(
    "q56_band_profile",
    fx.with_fixtures(
        """WITH s AS (SELECT tile, unnest(['r', 'g', 'b']) AS band, unnest([r, g, b])::DOUBLE AS v FROM px) SELECT tile, band, min(v) AS least, max(v) AS most, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation FROM s GROUP BY 1, 2"""
    ),
)
def band_profile(spark, sf_dir):
    return tiles.band_profile(fx.frame(spark, sf_dir, fx.PX)).withColumns({"mean": F.round("mean", 6), "deviation": F.round("deviation", 6)})


@query(
    "q37_cover_class",
    fx.with_fixtures(
        """WITH s AS (SELECT tile, y // 8 AS strip, avg(CASE WHEN 2 * g - r - b > 20 THEN 1 ELSE 0 END) AS share, count(*) AS n FROM px WHERE x BETWEEN 10 AND 40 GROUP BY 1, 2)
        SELECT tile, CAST(strip AS INTEGER) AS strip, round(share, 6) AS share, CASE WHEN n < 50 THEN 'unassessable' WHEN share < 0.25 THEN 'bare_soil' WHEN share > 0.75 THEN 'vegetation' ELSE 'mixed' END AS cover FROM s"""
    ),
)
def cover(spark, sf_dir):
    inside = frame(spark, sf_dir).filter("x BETWEEN 10 AND 40").groupBy("tile", F.floor(F.col("y") / 8).cast("int").alias("strip"))
    shares = inside.agg(F.avg((F.col("exg") > 20).cast("int")).alias("share"), F.count("*").alias("n"))
    return shares.select("tile", "strip", F.round("share", 6).alias("share"), cover_class(F.col("share"), F.col("n")).alias("cover"))


@query("q48c_crowns")
def crown_polygons(spark, sf_dir):
    """Crown outlines by watershed; the order in which ties are flooded has no SQL form."""
    found = raster.segment_crowns(fx.frame(spark, sf_dir, fx.PX), 64, 64, 0.3, -600.0, least=4, most=4096, radius=3)
    return found.select("tile", "crown", "pixels", F.size("ring").alias("vertices"))


@query(
    "q48d_composite",
    fx.with_fixtures("SELECT 'or' AS how, tile, x, y FROM px WHERE r > 240 OR g > 240 UNION ALL SELECT 'and', tile, x, y FROM px WHERE r > 200 AND g > 200"),
)
def composite(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX)
    layers = lambda least: p.filter(F.col("r") > least).select("tile", F.lit("r").alias("layer"), "x", "y").unionAll(p.filter(F.col("g") > least).select("tile", F.lit("g").alias("layer"), "x", "y"))
    out = lambda how, least: raster.composite(layers(least), how, 2).select(F.lit(how).alias("how"), "tile", "x", "y")
    return out("or", 240).unionAll(out("and", 200))


@query(
    "q48e_resample",
    fx.with_fixtures(
        """WITH t AS (SELECT DISTINCT tile, i AS tx, j AS ty, i * 1.5 + 0.25 AS sx, j * 1.5 + 0.75 AS sy FROM px, range(20) u(i), range(20) w(j)),
        c AS (SELECT tile, tx, ty, floor(sx) + dx AS x, floor(sy) + dy AS y, (CASE dx WHEN 1 THEN sx - floor(sx) ELSE 1 - sx + floor(sx) END) * (CASE dy WHEN 1 THEN sy - floor(sy) ELSE 1 - sy + floor(sy) END) AS w FROM t, range(2) e(dx), range(2) f(dy))
        SELECT c.tile, CAST(tx AS INTEGER) AS tx, CAST(ty AS INTEGER) AS ty, round(sum(g * w) / sum(w), 4) AS v FROM c JOIN px ON px.tile = c.tile AND px.x = c.x AND px.y = c.y GROUP BY 1, 2, 3"""
    ),
)
def resample(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX)
    spots = p.select("tile").distinct().withColumn("tx", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(19))))
    spots = spots.withColumns({"sx": F.col("tx") * 1.5 + 0.25, "sy": F.col("ty") * 1.5 + 0.75})
    return raster.resample(p.withColumn("v", F.col("g").cast("double")), spots).withColumn("v", F.round("v", 4))


_IOU = """i AS (SELECT p.tile, p.id AS pred, r.id AS ref, (least(p.x1, r.x1) - greatest(p.x0, r.x0)) * (least(p.y1, r.y1) - greatest(p.y0, r.y0)) AS shared, (p.x1 - p.x0) * (p.y1 - p.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) AS sum
FROM preds p JOIN refs r ON p.tile = r.tile AND p.x0 < r.x1 AND r.x0 < p.x1 AND p.y0 < r.y1 AND r.y0 < p.y1)"""


def boxes(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.PRED), fx.frame(spark, sf_dir, fx.REF)


@query("q57_box_iou", fx.with_fixtures(f"WITH {_IOU} SELECT tile, pred, ref, round(shared / (sum - shared), 6) AS iou FROM i", preds=fx.PRED))
def box_iou(spark, sf_dir):
    p, r = boxes(spark, sf_dir)
    return evaluate.box_ious(p, r, ["tile"]).withColumn("iou", F.round("iou", 6))


@query(
    "q58_greedy_f1",
    fx.with_fixtures(
        f"""WITH RECURSIVE {_IOU}, c AS (SELECT tile, pred, ref, row_number() OVER (PARTITION BY tile ORDER BY pred, shared / (sum - shared) DESC, ref DESC) AS n FROM i WHERE shared / (sum - shared) >= 0.5),
        reach AS (SELECT DISTINCT tile, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS ps, CAST([] AS BIGINT[]) AS rs FROM refs
          UNION ALL SELECT m.tile, c.n, CASE WHEN list_contains(ps, pred) OR list_contains(rs, ref) THEN ps ELSE list_append(ps, pred) END, CASE WHEN list_contains(ps, pred) OR list_contains(rs, ref) THEN rs ELSE list_append(rs, ref) END
          FROM reach m JOIN c ON c.tile = m.tile AND c.n = m.n + 1),
        t AS (SELECT tile, max(len(ps)) AS tp FROM reach GROUP BY tile), np AS (SELECT tile, count(*) AS n FROM preds GROUP BY tile), nr AS (SELECT tile, count(*) AS n FROM refs GROUP BY tile),
        f AS (SELECT tile, tp, coalesce(np.n, 0) - tp AS fp, nr.n - tp AS fn, CASE WHEN tp > 0 THEN 2 * (tp / np.n) * (tp / nr.n) / (tp / np.n + tp / nr.n) ELSE 0 END AS f1 FROM t JOIN nr USING (tile) LEFT JOIN np USING (tile))
        SELECT tile, tp, fp, fn, round(f1, 6) AS f1 FROM f UNION ALL SELECT -1, 0, 0, 0, round(avg(f1), 6) FROM f""",
        preds=fx.PRED,
    ),
)
def greedy_f1(spark, sf_dir):
    """Scores of greedy matching and their mean."""
    p, r = boxes(spark, sf_dir)
    scores = session.written(evaluate.f1_scores(evaluate.greedy_box_matches(p, r, "tile"), p, r, "tile"), "scores")
    mean = scores.agg(F.avg("f1").alias("f1"))
    return scores.select("tile", "tp", "fp", "fn", F.round("f1", 6).alias("f1")).unionAll(mean.select(F.lit(-1), F.lit(0), F.lit(0), F.lit(0), F.round("f1", 6)))


@query(
    "q59_class_iou",
    fx.with_fixtures("SELECT tile, round(count(*) FILTER (WHERE g > 100 AND r > 100) * 1.0 / count(*), 6) AS iou FROM px WHERE g > 100 OR r > 100 GROUP BY tile"),
)
def class_iou(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX)
    return evaluate.class_iou(p.filter("g > 100"), p.filter("r > 100"), "tile").withColumn("iou", F.round("iou", 6))
