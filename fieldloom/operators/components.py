"""Connected components of a distributed graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom import session


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, larger: bool, few: bool) -> DataFrame:
    """One star step: tie a node's larger (or smaller) neighbours to the least node around it.

    Only minima are aggregated, so a node with very many neighbours is never gathered in one place. Where the nodes are
    few, their minima are sent to the edges, so that no node's edges move to one task either; beyond that, adaptive
    execution splits the join."""
    around = _both_ways(edges) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = around.join(F.broadcast(least) if few else least, "a")
    if larger:
        pairs = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return pairs.filter("a <> b")
    pairs = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return pairs.filter("a <> b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node on an edge (a, b) of longs; the label is the component's least node.

    Each round halves the depth of what is left, and is written to shared storage. Self-loops, repeated edges and
    edges with a null count for nothing; without edges the result is empty.
    """
    now = session.written(edges.select("a", "b").dropna().filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state, edges_left = None, now.count()
    for _ in range(most_rounds):
        # A step makes no more nodes, and of each edge there are two at most.
        few = 2 * edges_left <= session.BROADCAST_ROWS
        now = session.written(_star(_star(now, True, few), False, few), "stars")
        count, mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if (count, mark) == state or not count:
            break
        state, edges_left = (count, mark), count
    else:
        raise RuntimeError("components did not settle")
    # Now every node but the least of its component points at that one.
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
