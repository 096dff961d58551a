"""Nearest neighbours by randomly rotated one-bit codes.

Every vector o is rotated at random in a larger space and keeps the sign of each coordinate, packed, with two
correction scalars: its length and the inner product c of the rotated unit vector with its own code. Against a
query q the code gives an unbiased estimate of <q, o>, whose error exceeds

    |q| |o| sqrt(1 - c*c) / c * CONFIDENCE / sqrt(bits - 1)

with a probability that falls exponentially in CONFIDENCE squared. A vector is scored exactly if its upper
bound reaches the k-th largest lower bound; the others are decided by their codes alone.

Codes are made once and stored beside the vectors. Queries and rows meet in a grid of cells, a block of queries by a
block of rows, each of bounded size; a cell's rows come with their codes, by which nearly all are decided, and their
vectors, for those that are scored. Codes meet queries as a product of signs, which in numpy is several times faster
than counting bits of a quantised query.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bits of a code for each dimension, and the width of the error bound.
BITS_PER_DIM, CONFIDENCE = 4, 2.6
#: Rows and queries of a cell, and what is estimated or scored at once within it.
ROWS_PER_CELL, QUERIES_PER_CELL, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 32_768, 16_384, 256, 1 << 19
SEED = 7
CODE = ["code", "length", "correction"]

FOUND = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@functools.cache
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """The first dim columns of a random rotation of as many dimensions as a code has bits."""
    bits = -(-dim * BITS_PER_DIM // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths and corrections c of the rows of a matrix."""
    turned = vectors @ rotation(vectors.shape[1]).T
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    corrections = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]) / lengths
    return np.packbits(turned >= 0, axis=1), lengths, np.clip(corrections, 1e-6, 1.0)


def exact_scores(queries: np.ndarray, vectors: np.ndarray, qi: np.ndarray, oi: np.ndarray) -> np.ndarray:
    """Inner products of pairs in double precision, added up in the order of the dimensions.

    Takes both matrices transposed, a row for each dimension."""
    total = np.zeros(len(qi))
    for q, v in zip(queries, vectors):
        total += q[qi] * v[oi]
    return total


def search_cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
    """The k best rows of one block, with their codes, for each query of one block: (query index, row index, score)."""
    packed, lengths, c = codes
    turn = rotation(vectors.shape[1])
    bits = turn.shape[0]
    scale = (lengths / c / np.sqrt(bits)).astype(np.float32)
    spread = (lengths * np.sqrt(1 - c * c) / c * CONFIDENCE / np.sqrt(bits - 1)).astype(np.float32)
    across, down = np.ascontiguousarray(queries.T), np.ascontiguousarray(vectors.T)
    out = []
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[low : low + QUERIES_AT_ONCE]
        turned = (some @ turn.T).astype(np.float32)
        estimate = np.empty((len(some), len(ids)), np.float32)
        for at in range(0, len(ids), 8192):
            signs = np.unpackbits(packed[at : at + 8192], axis=1, count=bits).astype(np.float32) * 2 - 1
            estimate[:, at : at + 8192] = turned @ signs.T * scale[at : at + 8192]
        own = query_ids[low : low + QUERIES_AT_ONCE, None] == ids[None]
        for i in range(len(some)):
            width = spread * np.float32(np.sqrt((some[i] * some[i]).sum()))
            lower = estimate[i] - width
            lower[own[i]] = -np.inf
            least = np.partition(lower, -k)[-k] if len(lower) > k else -np.inf
            reached = np.flatnonzero((estimate[i] + width >= least) & ~own[i])
            scores = np.concatenate([exact_scores(across[:, low + i : low + i + 1], down, np.zeros(len(part), np.int64), part) for at in range(0, len(reached), PAIRS_AT_ONCE) if len(part := reached[at : at + PAIRS_AT_ONCE])] or [np.empty(0)])
            best = np.lexsort((ids[reached], -scores))[:k]
            out.append((np.full(len(best), low + i), reached[best], scores[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)]


def usable(vectors: str):
    """Whether a vector takes part: neither null nor zero, and all of its components finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vectors)
    return F.coalesce(~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def search(df: DataFrame, is_query, k: int = 20, rows_per_cell: int = ROWS_PER_CELL, queries_per_cell: int = QUERIES_PER_CELL) -> DataFrame:
    """The k rows of (vec_id, embedding) with the largest inner product for each row where is_query holds.

    Returns query_id, rank (from 1), vec_id and score, nearest first, ties to the smaller vec_id. Candidates
    are all rows of the same dimension but those with the query's own vec_id; with fewer than k all of them
    come. Where one vec_id has several vectors, each is a candidate, and all of its queries share one list of k. Vectors that are null, zero or hold null or non-finite components and rows without vec_id take no part.
    Rows repeated with the same vec_id and vector count once. An empty df gives an empty result. Other columns
    are not read.
    """
    rows = (
        df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
        .filter(F.col("vec_id").isNotNull() & usable("v"))
        .dropDuplicates()
    )

    def coded(batches):
        for batch in batches:
            dims, flat = batch.column("dim").to_numpy(), batch.column("v").flatten().to_numpy()
            begin = np.concatenate([[0], np.cumsum(dims)])[:-1]
            code, length, correction = [None] * len(dims), np.zeros(len(dims)), np.ones(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                packed, length[at], correction[at] = encode(flat[begin[at][:, None] + np.arange(dim)])
                for i, row in zip(at, packed):
                    code[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.binary()), pa.array(length), pa.array(correction)], names=[*batch.schema.names, "code", "length", "correction"])

    rows = rows.withColumn("dim", F.size("v")).mapInArrow(coded, "vec_id long, v array<double>, q boolean, dim int, code binary, length double, correction double")
    rows = common.written(rows, "vectors")
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    n_parts, n_blocks = max(1, -(-n // rows_per_cell)), max(1, -(-n_queries // queries_per_cell))
    if n_blocks == 1:
        n_parts = max(n_parts, min(16, n // 2048 + 1))
    spot = lambda seed, count: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(count)).cast("int")
    # Every block of rows meets every block of queries in one cell.
    index = rows.select("dim", spot(1, n_parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(False).alias("q"), "vec_id", "v", *CODE)
    asked = rows.filter("q").select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"), spot(2, n_blocks).alias("block"), F.lit(True).alias("q"), "vec_id", "v", *CODE)

    def cell(table: pa.Table) -> pa.Table:
        is_q = table.column("q").to_numpy(zero_copy_only=False)
        ids = table.column("vec_id").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        at = np.flatnonzero(~is_q)
        at = at[np.argsort(ids[at], kind="stable")]
        row_ids, vectors = ids[at], flat[at]
        packed = np.frombuffer(b"".join(table.column("code").take(at).to_pylist()), np.uint8).reshape(len(at), -1) if len(at) else np.empty((0, 0), np.uint8)
        codes = packed, *(table.column(c).to_numpy()[at] for c in CODE[1:])
        query_ids, queries = ids[is_q], flat[is_q]
        qi, oi, scores = search_cell(query_ids, queries, row_ids, vectors, codes, k) if len(row_ids) and len(query_ids) else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": pa.array(query_ids[qi], pa.int64()), "vec_id": pa.array(row_ids[oi], pa.int64()), "score": pa.array(scores, pa.float64())})

    near = index.unionByName(asked).groupBy("dim", "part", "block").applyInArrow(cell, FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.select("query_id", place.cast("int").alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, among all embeddings."""
    return search(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op3_nearest": op3_nearest}
ORACLES = {
    "op3_nearest": """
WITH rows AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
         list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * r.v[i])) AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
"""
}
