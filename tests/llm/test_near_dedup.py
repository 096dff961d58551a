import os
import random

import duckdb
import numpy as np
import pytest

from fieldloom.llm import common, near_dedup

DATA = "/root/testdata/sf0.001"


def brute(rows, size):
    sets = []
    for _, t in rows:
        w = common.ascii_lower_words(t)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None] if sets[i] else [doc]
        least = min(group, default=None)
        out.append((doc, len(sets[i]), least, doc is not None and doc == least))
    return out


def noisy(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, documents, size):
    rng = random.Random(size)
    rows, at = [], 0
    for _ in range(25):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.randint(5, 150))]
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            rows.append((at, noisy(rng, base, rng.choice([0, 0, 1, 2, 4, 8]))))
            at += 1
    base = [f"g{k}" for k in range(200)]
    rows += [(1000 + k, noisy(rng, base, 3)) for k in range(60)]
    got = near_dedup.near_duplicates(documents(rows), size).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, size))


def test_odd_documents(odd, documents):
    from .conftest import ODD

    got = near_dedup.near_duplicates(odd, 2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(ODD, 2), key=key)
    assert near_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_stage_keeps_one_of_each(spark, odd):
    kept = near_dedup.near_dedup_stage(spark, odd, DATA)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert kept.filter("doc_id IS NULL").count() == 1


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")
def test_matches_duckdb(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = c.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({near_dedup.ORACLES['op1_near_dedup']})").fetchall()
    got = near_dedup.op1_near_dedup(spark, DATA).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_candidates_are_linear_in_a_group(documents):
    rows = [(k, " ".join([f"g{i}" for i in range(300)] + [f"x{k}"])) for k in range(400)]
    signed = near_dedup.sign(documents(rows), 2)
    edges = near_dedup.candidate_stars(signed, near_dedup.regions(signed)).count()
    assert 399 <= edges <= 400 * near_dedup.TREES


def test_repeated_rows_near_one_another(spark, documents):
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = [(i, noisy(rng, base, e)) for i, e in enumerate([0, 2, 9, 30, 40])]
    rows = rows * 3 + [(1, "another text under the same id altogether"), (9, "another text under the same id altogether")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_dedup.near_duplicates(documents(rows), 2).collect()}
    want = {(d, n): c for d, n, c, _ in brute(rows, 2)}
    assert got == want


def test_pairs_in_dense_regions(documents):
    rng = random.Random(12)
    base, fresh = [f"b{k}" for k in range(200)], iter(range(10**6))

    def edited(words, edits):
        words = list(words)
        for k in rng.sample(range(len(words)), edits):
            words[k] = f"x{next(fresh)}"
        return words

    # A family just below the threshold of one another, and a pair just above it for some of its members.
    family = [edited(base, 15) for _ in range(700)]
    texts = family + [edited(t, 21) for t in family[:60]]
    rng.shuffle(texts)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want = brute(rows, 1)
    assert sum(not kept for *_, kept in want) >= 50
    got = near_dedup.near_duplicates(documents(rows), 1).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def planted(count, pairs, seed):
    """Texts at about 0.775 to one another, and so many pairs of them at 0.817."""
    rng, fresh = random.Random(seed), iter(range(10**9))
    shared = [f"s{k}" for k in range(201)]
    texts = []
    for k in range(count):
        own = [f"o{next(fresh)}" for _ in range(29)]
        if k < 2 * pairs and k % 2:
            own[:6] = texts[-1][201:207]
        texts.append(shared + own)
    order = list(range(count))
    rng.shuffle(order)
    rows = [(doc, " ".join(texts[k])) for doc, k in enumerate(order)]
    place = {k: doc for doc, k in enumerate(order)}
    return rows, {tuple(sorted((place[2 * i], place[2 * i + 1]))) for i in range(pairs)}


@pytest.mark.parametrize("count", [3000, 30000])
def test_every_planted_pair_in_a_dense_family(documents, count):
    rows, want = planted(count, 300, count)
    got = near_dedup.near_duplicates(documents(rows), 2).filter("NOT kept").select("component_id", "doc_id").collect()
    assert set(map(tuple, got)) == want


@pytest.mark.parametrize("block_bytes, region", [(20_000, 10**6), (60_000, 10**6), (20_000, 50), (10**9, 50)])
def test_large_families_in_blocks(documents, monkeypatch, block_bytes, region):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(near_dedup, "REGION", region)
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 3)
    rng = random.Random(14)
    rows, _ = planted(120, 20, 1)
    base = [f"b{k}" for k in range(200)]
    rows += [(1000 + k, noisy(rng, base, rng.choice([2, 3, 9]))) for k in range(200)]
    rows += [(2000 + k, " ".join(base)) for k in range(12)] + [(3000, None), (3001, "")]
    got = near_dedup.near_duplicates(documents(rows), 2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 2))


def test_exact_heads_against_all_pairs():
    rng = random.Random(15)
    for seed in range(30):
        base = rng.sample(range(1000), 40)
        sets = [np.unique(np.array(rng.sample(base, 34) + rng.sample(range(1000), rng.randint(0, 8)), np.uint64)) for _ in range(40)]
        labels = np.arange(40) if seed % 2 else np.array([k % 30 for k in range(40)])
        label = {k: k for k in range(40)}
        for i in range(40):
            for j in range(i):
                if labels[i] == labels[j] or near_dedup.linked(sets[i], sets[j]):
                    low, high = sorted((label[i], label[j]))
                    label = {k: low if v == high else v for k, v in label.items()}
        assert near_dedup.exact_heads(sets, labels).tolist() == [label[k] for k in range(40)]
