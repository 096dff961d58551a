"""Survey-like inputs derived by arithmetic from the star-schema tables, in SQL that Spark and DuckDB read alike.

A table's name stands in braces; Spark binds a DataFrame to it, DuckDB's view has that name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fieldloom.session import table

#: Row segments in pixels of tile (r, c); k is the row within the tile.
SEG = """SELECT c_custkey AS id, CAST(floor(c_nationkey / 5.0) AS INT) AS r, CAST(c_nationkey % 5 AS INT) AS c, CAST(c_custkey % 12 AS INT) AS k,
  CAST((c_custkey * 131) % 1400 AS DOUBLE) AS x0, CAST((c_custkey * 131) % 1400 + 200 + (c_custkey * 17) % 400 AS DOUBLE) AS x1,
  CAST(100 + 160 * (c_custkey % 12) AS DOUBLE) AS y0, CAST(100 + 160 * (c_custkey % 12) + (c_custkey % 5) - 2 AS DOUBLE) AS y1 FROM {customer}"""
#: The same in metres.
WSEG = f"""SELECT id, r, c, k, 51.2E0 * (12285 + c) + 0.025E0 * (x0 + 0.5E0) AS ax, 51.2E0 * (101977 - r) - 0.025E0 * (y0 + 0.5E0) AS ay,
  51.2E0 * (12285 + c) + 0.025E0 * (x1 + 0.5E0) AS bx, 51.2E0 * (101977 - r) - 0.025E0 * (y1 + 0.5E0) AS by_ FROM ({SEG}) seg"""
#: Crown and litter boxes in pixels.
BOX = """SELECT o_orderkey AS id, CAST(floor(c_nationkey / 5.0) AS INT) AS r, CAST(c_nationkey % 5 AS INT) AS c, CAST(c_custkey % 12 AS INT) AS k, o_orderstatus AS status,
  CAST((c_custkey * 131) % 1400 + (o_orderkey * 53) % 200 AS DOUBLE) AS x0, CAST(92 + 160 * (c_custkey % 12) AS DOUBLE) AS y0,
  CAST((c_custkey * 131) % 1400 + (o_orderkey * 53) % 200 + 10 + o_orderkey % 30 AS DOUBLE) AS x1,
  CAST(92 + 160 * (c_custkey % 12) + 8 + o_orderkey % 12 AS DOUBLE) AS y1 FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
#: Pixels with three bands, 64 x 64 at most on each of 25 tiles.
PX = """SELECT CAST(l_suppkey % 25 AS INT) AS tile, CAST((l_orderkey * 7 + l_linenumber * 13) % 64 AS INT) AS x, CAST((l_partkey * 11 + l_linenumber) % 64 AS INT) AS y,
  max(CAST(l_quantity * 5 AS INT)) AS r, max(CAST(l_partkey % 256 AS INT)) AS g, max(CAST((l_orderkey * 3) % 256 AS INT)) AS b FROM {lineitem} GROUP BY 1, 2, 3"""
#: Reference boxes and predictions that are a few pixels off; each seventh is missed.
REF = """SELECT p_partkey AS id, CAST(p_partkey % 25 AS INT) AS tile, CAST((p_partkey * 37) % 1900 AS DOUBLE) AS x0, CAST((p_partkey * 91) % 1900 AS DOUBLE) AS y0,
  CAST((p_partkey * 37) % 1900 + 20 + p_size % 20 AS DOUBLE) AS x1, CAST((p_partkey * 91) % 1900 + 20 + p_size % 15 AS DOUBLE) AS y1 FROM {part}"""
PRED = f"SELECT id, tile, x0 + id % 9 AS x0, y0 + id % 6 AS y0, x1 + id % 9 AS x1, y1 + id % 6 AS y1 FROM ({REF}) refs WHERE id % 7 <> 0"
#: A walkable lattice of 12 x 12 with holes, 2 m apart.
CELL = """SELECT CAST(a.n_nationkey * 12 + b.n_nationkey AS BIGINT) AS node, CAST(a.n_nationkey AS INT) AS x, CAST(b.n_nationkey AS INT) AS y
  FROM {nation} a CROSS JOIN {nation} b WHERE a.n_nationkey < 12 AND b.n_nationkey < 12 AND (a.n_nationkey * 7 + b.n_nationkey * 11) % 5 <> 0"""
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The DataFrame of a fixture."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    """The same for DuckDB."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def with_fixtures(sql: str, **more: str) -> str:
    """DuckDB SQL with the fixtures as common table expressions, those that it names."""
    known = {"seg": SEG, "wseg": WSEG, "box": BOX, "px": PX, "refs": REF, "preds": PRED, "cells": CELL} | more
    # DuckDB's count_if is a HUGEINT; a filtered count is a BIGINT like Spark's.
    sql = re.sub(r"count_if\(([^()]*)\)", r"count(*) FILTER (WHERE \1)", sql)
    named = {n: s for n, s in known.items() if re.search(rf"\b{n}\b", sql) or any(re.search(rf"\b{n}\b", m) for m in more.values())}
    recursive = " RECURSIVE" if "UNION" in sql and "reach" in sql else ""
    ctes = ", ".join(f"{n} AS ({duck(s)})" for n, s in named.items())
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH{recursive} {ctes}, {body[5:].removeprefix('RECURSIVE ')}"
    return f"WITH {ctes} {body}"
