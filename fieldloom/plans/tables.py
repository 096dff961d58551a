"""Queries of roll-ups, tallies and ordered sequences."""

from __future__ import annotations



from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.operators import measure as m
from fieldloom.operators import sequences as q

from . import fixtures as fx
from .catalogue import query

_BLOCK, _ROW = "printf('V%02d', r + 1)", "printf('V%02d-R%02d', r + 1, k + 1)"
_LENGTH = "sqrt((bx - ax) ** 2 + (by_ - ay) ** 2)"


def with_ids(df, block="vineyard_id", row="row_id"):
    return df.withColumn(block, F.format_string("V%02d", F.col("r") + 1)).withColumn(row, F.format_string("V%02d-R%02d", F.col("r") + 1, F.col("k") + 1))


_ROLLUP = f"""WITH lines AS (SELECT {_BLOCK} AS v, {_ROW} AS w, {_LENGTH} AS len FROM wseg),
crowns AS (SELECT {_BLOCK} AS v, (x1 - x0) * (y1 - y0) * 0.000625 AS a, status FROM box),
tot AS (SELECT 'block_count' AS metric, '' AS vineyard_id, '' AS row_id, CAST((SELECT count(DISTINCT v) FROM (SELECT v FROM lines UNION SELECT v FROM crowns)) AS DOUBLE) AS value, 'count' AS unit
 UNION ALL SELECT 'row_count', '', '', (SELECT count(DISTINCT w) FROM lines), 'count'
 UNION ALL SELECT 'total_row_length', '', '', (SELECT sum(len) FROM lines), 'm'
 UNION ALL SELECT 'total_canopy_area', '', '', (SELECT sum(a) FROM crowns WHERE status = 'O'), 'm2'
 UNION ALL SELECT 'total_interrow_area', '', '', (SELECT sum(a) FROM crowns WHERE status <> 'O'), 'm2'
 UNION ALL SELECT 'canopy_area', v, '', sum(CASE WHEN status = 'O' THEN a ELSE 0 END), 'm2' FROM crowns GROUP BY v
 UNION ALL SELECT 'interrow_area', v, '', sum(CASE WHEN status <> 'O' THEN a ELSE 0 END), 'm2' FROM crowns GROUP BY v
 UNION ALL SELECT 'row_length', v, w, sum(len), 'm' FROM lines GROUP BY v, w)
SELECT metric, vineyard_id, row_id, round(value, 6) AS value, unit FROM tot"""


@query("q10_measurement_rollup", fx.with_fixtures(_ROLLUP))
def measurement_rollup(spark, sf_dir):
    lines = with_ids(fx.frame(spark, sf_dir, fx.WSEG))
    line = F.array(g.point(F.col("ax"), F.col("ay")), g.point(F.col("bx"), F.col("by_")))
    rows = lines.select("vineyard_id", "row_id", g.polyline_length(line).alias("length"))
    boxes = with_ids(fx.frame(spark, sf_dir, fx.BOX)).withColumn("area", g.ring_area(g.box_ring(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])) * g.PIXEL**2)
    canopy, strips = boxes.filter("status = 'O'").select("vineyard_id", "area"), boxes.filter("status <> 'O'").select("vineyard_id", "area")
    out = m.measurement_rollup(rows, canopy, strips)
    return out.withColumn("value", F.round("value", 6))


@query(
    "q11_tallies",
    fx.with_fixtures(
        """WITH t AS (SELECT r, c, CASE WHEN status = 'P' THEN '' ELSE status END AS s FROM box)
        SELECT r, c, 'tally' AS kind, CASE WHEN s = '' THEN 'None' ELSE s END AS value, count(*) AS n FROM t GROUP BY ALL
        UNION ALL SELECT r, c, 'fixed', v, count_if(s = v) FROM t, (VALUES ('F'), ('O'), ('X')) f(v) GROUP BY ALL"""
    ),
)
def tallies(spark, sf_dir):
    t = fx.frame(spark, sf_dir, fx.BOX).withColumn("s", F.when(F.col("status") == "P", "").otherwise(F.col("status")))
    free, fixed = m.tally(t, ["r", "c"], "s"), m.tally_fixed(t, ["r", "c"], "s", ["F", "O", "X"])
    return free.withColumn("kind", F.lit("tally")).unionByName(fixed.withColumn("kind", F.lit("fixed"))).select("r", "c", "kind", "value", "n")


@query(
    "q12_block_tallies",
    fx.with_fixtures(
        f"""SELECT coalesce(a.v, b.v) AS vineyard_id, coalesce(canopy, 0) AS canopy, coalesce(rows, 0) AS rows, coalesce(interrow, 0) AS interrow, coalesce(waste, 0) AS waste FROM
        (SELECT {_BLOCK} AS v, count_if(status = 'O') AS canopy, count_if(status = 'F') AS interrow, count_if(status = 'P') AS waste FROM box GROUP BY 1) a
        FULL JOIN (SELECT {_BLOCK} AS v, count(DISTINCT k) AS rows FROM seg GROUP BY 1) b ON a.v = b.v"""
    ),
)
def block_tallies(spark, sf_dir):
    rows, boxes = with_ids(fx.frame(spark, sf_dir, fx.SEG)), with_ids(fx.frame(spark, sf_dir, fx.BOX))
    layer = lambda s: boxes.filter(F.col("status") == s)
    return m.block_tallies(layer("O"), rows, layer("F"), layer("P"))


@query(
    "q12b_legend",
    fx.with_fixtures(
        """SELECT CAST(row_number() OVER (ORDER BY CASE value WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, value) AS INTEGER) AS place, value, n
        FROM (SELECT status AS value, count(*) AS n FROM box GROUP BY 1)"""
    ),
)
def legend(spark, sf_dir):
    return m.legend(fx.frame(spark, sf_dir, fx.BOX), "status", ["P", "F"]).select("place", "value", "n")


@query(
    "q12c_layer_counts",
    fx.with_fixtures(
        """SELECT r, count_if(status = 'F') AS disrupted, count_if(status IS DISTINCT FROM 'F') AS others, min(x0) AS x0, max(y1) AS y1 FROM box WHERE k = 3 GROUP BY r"""
    ),
)
def layer_counts(spark, sf_dir):
    """Sub-filters keep what is null or ''; the same filter gives the extent to zoom to."""
    box = fx.frame(spark, sf_dir, fx.BOX).filter((F.col("k") == 3) | F.lit("" == "all"))
    is_f = F.col("status").eqNullSafe("F")
    return box.groupBy("r").agg(F.count_if(is_f).alias("disrupted"), F.count_if(~is_f).alias("others"), F.min("x0").alias("x0"), F.max("y1").alias("y1"))


@query(
    "q13_tile_discovery",
    fx.with_fixtures(
        """WITH names AS (SELECT DISTINCT printf('tile_r%03d_c%03d', r, c) AS stem FROM seg),
        asked(stem) AS (VALUES ('tile_r001_c001'), ('tile_r003_c002'), ('tile_r099_c001'), ('tile_r000_c004')),
        found AS (SELECT stem, row_number() OVER (ORDER BY stem) AS place FROM names WHERE stem IN (SELECT stem FROM asked))
        SELECT stem, CAST(place AS INTEGER) AS place, 'found' AS state FROM found WHERE place <= 2
        UNION ALL SELECT stem, 0, 'missing' FROM asked WHERE stem NOT IN (SELECT stem FROM names)"""
    ),
)
def tile_discovery(spark, sf_dir):
    """Asked stems, with or without the prefix: the first two in order, and a report of those that are missing."""
    from fieldloom.sources import tiles

    names = fx.frame(spark, sf_dir, fx.SEG).select(F.format_string("/data/tile_r%03d_c%03d.tif", "r", "c").alias("path")).distinct()
    asked = ["r001_c001", "tile_r003_c002", "r099_c001", "tile_r000_c004"]
    found = tiles.select_tiles(names, asked, limit=2, prefix="tile_")
    missing = tiles.missing_tiles(names, asked, prefix="tile_")
    return found.select("stem", "place", F.lit("found").alias("state")).unionByName(missing.select("stem", F.lit(0).alias("place"), F.lit("missing").alias("state")))


@query(
    "q14_gap_split",
    fx.with_fixtures(
        """WITH s AS (SELECT id, r, c, y0 + (id * 37) % 90 AS v FROM seg),
        f AS (SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY r, c ORDER BY v) > 45 THEN 1 ELSE 0 END AS n FROM s),
        g AS (SELECT r, c, v, CAST(sum(n) OVER (PARTITION BY r, c ORDER BY v ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM f)
        SELECT r, c, cluster, count(*) AS n, min(v) AS low, max(v) AS high FROM g GROUP BY ALL HAVING count(*) >= 2"""
    ),
)
def gap_split(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).withColumn("v", F.col("y0") + F.col("id") * 37 % 90)
    split = q.gap_split(seg, ["r", "c"], "v", 45, least=2)
    return split.groupBy("r", "c", "cluster").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


@query(
    "q15_row_structure",
    fx.with_fixtures(
        """WITH s AS (SELECT r, c, k, x0 * 0.025 AS t FROM seg), f AS (SELECT *, t - lag(t) OVER (PARTITION BY r, c, k ORDER BY t) AS step FROM s)
        SELECT r, c, k, round(max(step), 6) AS max_gap, count(*) AS n, CASE WHEN count(*) < 2 THEN 'unassessable' WHEN max(step) >= 5 THEN 'disrupted' ELSE 'regular' END AS row_structure FROM f GROUP BY ALL"""
    ),
)
def row_structure(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).withColumn("t", F.col("x0") * 0.025)
    return q.row_structure(seg, ["r", "c", "k"], "t", 5.0).withColumn("max_gap", F.round("max_gap", 6))


_PROFILE = "SELECT tile, y, CAST(sum(g) AS DOUBLE) AS v FROM px GROUP BY 1, 2"


def profile(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.PX).groupBy("tile", "y").agg(F.sum("g").cast("double").alias("v"))


@query(
    "q16_local_maxima",
    fx.with_fixtures(
        f"""WITH p AS ({_PROFILE}), n AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b, max(v) OVER (PARTITION BY tile) AS top FROM p WINDOW w AS (PARTITION BY tile ORDER BY y))
        SELECT tile, y, v FROM n WHERE v >= a AND v > b AND v > 0.13 * top"""
    ),
)
def local_maxima(spark, sf_dir):
    return q.local_maxima(profile(spark, sf_dir), ["tile"], "y", "v")


@query(
    "q17_consecutive_pairs",
    fx.with_fixtures(
        """WITH rows AS (SELECT r, c, k, min(x0) AS t0, max(x1) AS t1, avg(y0) AS s FROM seg GROUP BY 1, 2, 3),
        n AS (SELECT *, lead(k) OVER w AS next_k, lead(s) OVER w AS next_s FROM rows WINDOW w AS (PARTITION BY r, c ORDER BY s))
        SELECT r, c, k, next_k, round((t1 - t0) * (next_s - s - 40), 4) AS area FROM n WHERE next_k IS NOT NULL AND next_s - s <= 168"""
    ),
)
def consecutive_pairs(spark, sf_dir):
    """Quads between neighbouring rows, drawn in by 20 px on each side, left out over wide gaps."""
    rows = fx.frame(spark, sf_dir, fx.SEG).groupBy("r", "c", "k").agg(F.min("x0").alias("t0"), F.max("x1").alias("t1"), F.avg("y0").alias("s"))
    pairs = q.consecutive_pairs(rows, ["r", "c"], ["s"], ["k", "s"]).filter(F.col("next_s") - F.col("s") <= 168)
    quad = g.clamp_points(g.inset_quad(F.col("t0"), F.col("t1"), F.col("s"), F.col("next_s"), F.lit(0.0), 20.0), F.lit(2048.0), F.lit(2048.0))
    return pairs.select("r", "c", "k", "next_k", F.round(g.ring_area(quad), 4).alias("area"))


@query(
    "q18_dense_labels",
    fx.with_fixtures(
        """WITH b AS (SELECT c, min(x0) + c * 2048 AS east FROM seg GROUP BY c), v AS (SELECT c, printf('V%02d', row_number() OVER (ORDER BY east)) AS vineyard_id FROM b),
        w AS (SELECT c, k, avg(x0) AS mx, avg(y0) AS my FROM seg GROUP BY 1, 2)
        SELECT vineyard_id, k, printf('%s-R%02d', vineyard_id, row_number() OVER (PARTITION BY w.c ORDER BY mx, my)) AS row_id, printf('tile-R%02d', row_number() OVER (PARTITION BY w.c ORDER BY k) - 1) AS provisional
        FROM w JOIN v ON w.c = v.c"""
    ),
)
def dense_labels(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG)
    blocks = seg.groupBy("c").agg((F.min("x0") + F.col("c") * 2048).alias("east")).select("c", q.dense_label([F.col("east")], "V").alias("vineyard_id"))
    rows = seg.groupBy("c", "k").agg(F.avg("x0").alias("mx"), F.avg("y0").alias("my"))
    place = F.row_number().over(Window.partitionBy("c").orderBy("mx", "my"))
    first = F.row_number().over(Window.partitionBy("c").orderBy("k")) - 1
    # Only the labels' numbers are windowed per block, so rows never meet in one task.
    return rows.withColumns({"n": place, "p": first}).join(blocks, "c").select("vineyard_id", "k", F.format_string("%s-R%02d", "vineyard_id", "n").alias("row_id"), F.format_string("tile-R%02d", "p").alias("provisional"))


@query(
    "q19_natural_sort",
    "SELECT name, CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS place FROM (SELECT DISTINCT 'V' || (p_partkey % 120) AS name, p_partkey % 120 AS n FROM part)",
)
def natural_sort(spark, sf_dir):
    names = fx.table(spark, sf_dir, "part").select(F.concat(F.lit("V"), F.col("p_partkey") % 120).alias("name")).distinct()
    return names.select("name", q.natural_rank("name").alias("place"))


@query(
    "q20_top_k",
    fx.with_fixtures(
        """SELECT r, c, id, area, CAST(rank AS INTEGER) AS rank FROM (SELECT r, c, id, (x1 - x0) * (y1 - y0) AS area, row_number() OVER (PARTITION BY r, c ORDER BY (x1 - x0) * (y1 - y0) DESC, id) AS rank FROM box) WHERE rank <= 300"""
    ),
)
def top_k(spark, sf_dir):
    box = fx.frame(spark, sf_dir, fx.BOX).select("r", "c", "id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return q.top_k(box, ["r", "c"], [F.desc("area"), F.col("id")], 300)


@query(
    "q20b_largest",
    fx.with_fixtures("SELECT r, c, max((x1 - x0) * (y1 - y0)) AS area, arg_min(id, (-(x1 - x0) * (y1 - y0), id)) AS id FROM box GROUP BY r, c"),
)
def largest(spark, sf_dir):
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    best = fx.frame(spark, sf_dir, fx.BOX).groupBy("r", "c").agg(F.min(F.struct((-area).alias("a"), "id")).alias("m"))
    return best.select("r", "c", (-F.col("m.a")).alias("area"), F.col("m.id").alias("id"))


@query(
    "q20c_hash_sample",
    "SELECT count(*) AS n FROM (SELECT 1 FROM lineitem LIMIT 4000)",
)
def hash_sample(spark, sf_dir):
    """Sampling at most 4000 pixels in hash order: repeatable, without replacement."""
    px = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return px.orderBy(F.xxhash64("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").limit(4000).agg(F.count("*").alias("n"))


@query(
    "q21_dominant_angle",
    fx.with_fixtures(
        f"SELECT r, c, round(0.5 * atan2(sum({_LENGTH} * sin(2 * atan2(by_ - ay, bx - ax))), sum({_LENGTH} * cos(2 * atan2(by_ - ay, bx - ax)))), 6) + 0 AS angle FROM wseg WHERE {_LENGTH} > 1 GROUP BY r, c"
    ),
)
def dominant_angle(spark, sf_dir):
    dx, dy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    wseg = fx.frame(spark, sf_dir, fx.WSEG).select("r", "c", F.sqrt(dx * dx + dy * dy).alias("len"), F.atan2(dy, dx).alias("a")).filter("len > 1")
    return wseg.groupBy("r", "c").agg((F.round(m.dominant_angle(F.col("len"), F.col("a")), 6) + 0.0).alias("angle"))


@query(
    "q22_row_filter",
    fx.with_fixtures(
        """WITH s AS (SELECT id, r, c, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS path, atan2(y1 - y0, x1 - x0) AS a FROM seg),
        d AS (SELECT r, c, 0.5 * atan2(sum(path * sin(2 * a)), sum(path * cos(2 * a))) AS main FROM s GROUP BY 1, 2),
        k AS (SELECT s.* FROM s JOIN d USING (r, c) WHERE path >= 300 AND degrees(abs(a - main)) <= 0.3), n AS (SELECT r, c FROM k GROUP BY 1, 2 HAVING count(*) >= 6)
        SELECT id, round(path, 4) AS path FROM k JOIN n USING (r, c)"""
    ),
)
def row_filter(spark, sf_dir):
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    seg = fx.frame(spark, sf_dir, fx.SEG).select("id", "r", "c", F.sqrt(dx * dx + dy * dy).alias("path"), F.atan2(dy, dx).alias("angle")).withColumn("chord", F.col("path"))
    return m.row_filter(seg, ["r", "c"], 300, 0.9, 0.3, 6).select("id", F.round("path", 4).alias("path"))


_WEIGHTS = ", ".join(f"({k}, {w:.20f}::DOUBLE)" for k, w in q.gaussian_weights(2.0))


@query(
    "q23_gaussian_smoothing",
    fx.with_fixtures(
        f"""WITH p AS ({_PROFILE}), weights(k, w) AS (VALUES {_WEIGHTS}),
        spots AS (SELECT t.tile, y.y AS y, CASE WHEN y.y + k < 0 THEN -(y.y + k) - 1 WHEN y.y + k > 63 THEN 127 - (y.y + k) ELSE y.y + k END AS src, w
          FROM (SELECT DISTINCT tile FROM p) t, (SELECT CAST(range AS INTEGER) AS y FROM range(64)) y, weights)
        SELECT spots.tile, spots.y, round(sum(v * w), 4) AS smooth FROM spots JOIN p ON p.tile = spots.tile AND p.y = src GROUP BY 1, 2"""
    ),
)
def gaussian_smoothing(spark, sf_dir):
    return q.gaussian_smooth(profile(spark, sf_dir), ["tile"], "y", "v", 64, 2.0).withColumn("smooth", F.round("smooth", 4))


@query(
    "q24_ordered_distinct",
    fx.with_fixtures("SELECT r, c, first, CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER) AS place FROM (SELECT r, c, min(id) AS first FROM seg GROUP BY r, c)"),
)
def ordered_distinct(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).withColumn("first", F.col("id"))
    return q.first_occurrences(seg, ["r", "c"], "first").select("r", "c", "first", "place")


@query(
    "q24b_line_order",
    fx.with_fixtures("SELECT r, c, k, string_agg(CAST(id AS VARCHAR), ',' ORDER BY x0, id) AS ids, count(*) AS n FROM seg GROUP BY r, c, k"),
)
def line_order(spark, sf_dir):
    """A cluster's members in order along the axis, as one polyline's vertices."""
    members = F.array_sort(F.collect_list(F.struct("x0", "id")))
    return fx.frame(spark, sf_dir, fx.SEG).groupBy("r", "c", "k").agg(F.array_join(F.transform(members, lambda v: v["id"].cast("string")), ",").alias("ids"), F.count("*").alias("n"))


