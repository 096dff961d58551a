import numpy as np
from pyspark.sql import functions as F

from fieldloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, v string, q int, part int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k):
    """Exact in the order of the dimensions."""
    out = {}
    for qi, q in rows:
        if qi % 20:
            continue
        scores = []
        for i, v in rows:
            if i != qi:
                total = 0.0
                for a, b in zip(q, v):
                    total += float(np.float32(a)) * float(np.float32(b))
                scores.append((-total, i))
        out[qi] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def recall(spark, rows, **cells):
    want = brute(rows, 20)
    got = {}
    for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 20, **cells).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q, best in want.items():
        assert sorted(got[q]) == list(range(1, len(best) + 1))
        scores = [got[q][k][1] for k in sorted(got[q])]
        assert scores == sorted(scores, reverse=True)
        exact = dict(brute(rows, len(rows))[q]) if len(rows) < 200 else dict(best)
        for i, s in got[q].values():
            assert i not in exact or exact[i] == s
        hits += len({i for i, _ in got[q].values()} & {i for i, _ in best})
        total += len(best)
    return hits / total


def test_recall_in_one_cell_and_in_a_grid(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((600, 64)))]
    assert recall(spark, rows) >= 0.98
    assert recall(spark, rows, rows_per_cell=100, queries_per_cell=7) >= 0.98
    centres = rng.standard_normal((5, 64)) * 3
    assert recall(spark, [(i, centres[i % 5] + v) for i, v in rows]) >= 0.98


def test_ties_copies_and_unusable_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(50)] + [(7, same)]
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()]
    assert got[:20] == [(0, k + 1, k + 1) for k in range(20)] and got[20:40] == [(20, k + 1, k) for k in range(20)]
    bad = [(60, None), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [1.0, float("nan"), 2.0]), (140, [1.0, float("inf"), 0.0]), (160, []), (None, same), (0, [1.0, 0.0, 0.0]), (3, [2.0, 1.0, 0.0])]
    got = ann.search(frame(spark, bad), F.col("vec_id") % 20 == 0, 20).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 2.0)]
    assert ann.search(frame(spark, bad).limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    o, q = rng.standard_normal((3000, 64)), rng.standard_normal(64)
    packed, lengths, c = ann.encode(o)
    turn = ann.rotation(64)
    bits = turn.shape[0]
    signs = np.unpackbits(packed, axis=1, count=bits).astype(float) * 2 - 1
    estimate = signs @ (turn @ q) * lengths / c / np.sqrt(bits)
    width = lengths * np.sqrt(1 - c * c) / c * ann.CONFIDENCE / np.sqrt(bits - 1) * np.linalg.norm(q)
    off = np.abs(estimate - o @ q)
    assert abs((estimate - o @ q).mean()) < 0.2 and (off <= width).mean() > 0.98
