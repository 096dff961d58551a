"""Queries of row assembly and detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.operators import rows

from . import fixtures as fx
from .catalogue import query


def instances(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.PX)
    return p.select("tile", (F.floor(F.col("y") / 8) * 8 + F.floor(F.col("x") / 8)).cast("int").alias("inst"), (F.col("b") % 2).alias("cls"), (F.col("g") / 255).alias("p"), "x", "y")


_INST = "i AS (SELECT tile, CAST(y // 8 * 8 + x // 8 AS INTEGER) AS inst, x, y FROM px WHERE b % 2 = 1 AND g / 255 > 0.5), k AS (SELECT *, count(*) OVER (PARTITION BY tile, inst) AS n FROM i)"


@query("q66_instance_filter", fx.with_fixtures(f"WITH {_INST} SELECT tile, inst, count(*) AS n FROM k WHERE n >= 12 GROUP BY 1, 2"))
def instance_filter(spark, sf_dir):
    kept = rows.instance_filter(instances(spark, sf_dir), {0: "trunk", 1: "vine_row"}, {"row", "vine_row"}, least=12)
    return kept.groupBy("tile", "inst").agg(F.count("*").alias("n"))


@query(
    "q66b_row_members",
    fx.with_fixtures(
        f"""WITH {_INST}, m AS (SELECT tile, inst, avg(x) AS x, avg(y) AS y FROM k WHERE n >= 12 GROUP BY 1, 2), s AS (SELECT tile, inst, round(y * cos(0.1) - x * sin(0.1), 6) AS s FROM m),
        f AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY tile ORDER BY s) > 1.5 THEN 1 ELSE 0 END AS step FROM s), c AS (SELECT *, CAST(sum(step) OVER (PARTITION BY tile ORDER BY s ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM f)
        SELECT tile, cluster, count(*) AS n FROM c GROUP BY 1, 2 HAVING count(*) >= 2"""
    ),
)
def row_members(spark, sf_dir):
    kept = rows.instance_filter(instances(spark, sf_dir), {0: "trunk", 1: "vine_row"}, {"vine_row"}, least=12)
    return rows.row_members(kept, F.lit(0.1), 1.5).groupBy("tile", "cluster").agg(F.count("*").alias("n"))


@query("q66c_assembled_rows")
def assembled_rows(spark, sf_dir):
    """The rows as simplified lines; simplifying is recursive and has no SQL form."""
    kept = rows.instance_filter(instances(spark, sf_dir), {0: "trunk", 1: "vine_row"}, {"vine_row"}, least=12)
    return rows.assemble_rows(kept, F.lit(0.1), 1.5, epsilon=1.0).select("tile", "row", F.size("points").alias("vertices"), F.round(g.polyline_length(F.col("points")), 4).alias("length"))


_A = "(atan2(by_ - ay, bx - ax) + CASE WHEN atan2(by_ - ay, bx - ax) < 0 THEN pi() ELSE 0 END)"


@query(
    "q67_global_rows",
    fx.with_fixtures(
        f"""WITH a AS (SELECT *, {_A} AS a FROM wseg), b AS (SELECT arg_min(a, id) AS b FROM a), o AS (SELECT a.*, b + fmod(a - b + 1.5 * pi(), pi()) - pi() / 2 AS u FROM a, b), m0 AS (SELECT median(u) AS m FROM o), m AS (SELECT fmod(m + 1.5 * pi(), pi()) - pi() / 2 AS m FROM m0),
        s AS (SELECT id, round((ay + by_) / 2 * cos(m) - (ax + bx) / 2 * sin(m), 6) AS s FROM a, m), f AS (SELECT *, CASE WHEN s - lag(s) OVER (ORDER BY s, id) > 0.207 THEN 1 ELSE 0 END AS step FROM s)
        SELECT id, printf('V01-R%02d', CAST(sum(step) OVER (ORDER BY s, id ROWS UNBOUNDED PRECEDING) AS BIGINT) + 1) AS row_id FROM f"""
    ),
)
def global_rows(spark, sf_dir):
    return rows.global_rows(fx.frame(spark, sf_dir, fx.WSEG), 0.207)


@query(
    "q67b_cross_axis_order",
    fx.with_fixtures("SELECT r, c, id, CAST(row_number() OVER (PARTITION BY r, c ORDER BY (y0 + y1 + id * 0.001) / 2, id) AS INTEGER) AS place FROM seg WHERE y0 = y1"),
)
def cross_axis_order(spark, sf_dir):
    seg = fx.frame(spark, sf_dir, fx.SEG).filter("y0 = y1")
    line = F.array(g.point(F.col("x0"), F.col("y0") + F.col("id") * 0.0005), g.point(F.col("x1"), F.col("y0") + F.col("id") * 0.0005))
    return rows.cross_axis_order(seg.select("r", "c", "id", line.alias("points")), ["r", "c"]).select("r", "c", "id", "place")


@query("q68_detected_rows")
def detected_rows(spark, sf_dir):
    """Rows found in the vegetation; which of two close peaks gives way depends on those before, so tests use stripes."""
    found = rows.detect_rows(fx.frame(spark, sf_dir, fx.PX).filter("g > 150").select("tile", "x", "y"), 6.0)
    return found.select("tile", "row", F.round("angle", 4).alias("angle"), F.round("s", 2).alias("s"), F.round("t0", 3).alias("t0"), F.round("t1", 3).alias("t1"))
