import random

from fieldloom.llm import common, decontamination as dc

VOCABULARY = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("an", "er", "in", "on", "oth", "e", "ai")] + ["the", "of", "and"] * 12


def passage(rng, n):
    return rng.choices(VOCABULARY, k=n)


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at, how = rng.randrange(len(words)), rng.randrange(3)
        if how == 0:
            words[at] = rng.choice(VOCABULARY)
        elif how == 1:
            words.insert(at, rng.choice(VOCABULARY))
        else:
            del words[at]
    return words


def brute(items, text):
    h = common.WordHasher()
    t = h.hashes(dc.words(text))
    out = {}
    for i, x in items:
        w = h.hashes(dc.words(x))
        if len(w):
            edits = dc.edit_distance_within(w, t)[0]
            if edits <= dc.allowed(len(w)):
                out[i] = edits
    return out


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_distance():
    rng = random.Random(1)
    h = common.WordHasher()
    for _ in range(100):
        a, b = passage(rng, rng.randint(1, 15)), passage(rng, rng.randint(0, 30))
        code = lambda w: h.hashes([x.encode() for x in w])
        assert dc.edit_distance_within(code(a), code(b))[0] == plain_distance(a, b)


def test_recall_and_precision_against_all_alignments():
    rng = random.Random(2)
    items = [(i, " ".join(passage(rng, rng.choice([1, 2, 3, 5, 6, 8, 12, 20, 35, 60, 130])))) for i in range(60)]
    index = dc.ItemIndex(items)
    found = wanted = 0
    for _ in range(150):
        _, x = rng.choice(items)
        w = x.split()
        text = " ".join(passage(rng, rng.randint(0, 40)) + edited(rng, w, rng.randint(0, dc.allowed(len(w)))) + passage(rng, rng.randint(0, 40)))
        got, want = {i: e for i, (e, _) in dc.hits_of(index, text).items()}, brute(items, text)
        assert set(got) <= set(want)
        found += len(got)
        wanted += len(want)
    assert found >= 0.99 * wanted


def test_case_and_punctuation_do_not_matter():
    index = dc.ItemIndex([(1, "Alpha beta gamma, delta epsilon zeta eta theta.")])
    assert dc.hits_of(index, "x\nALPHA; beta (gamma) delta\tepsilon zeta eta theta!") == {0: (0, 9)}
    assert not dc.hits_of(index, "alpha beta gamma delta") and not dc.hits_of(index, None) and not dc.hits_of(index, "")


def test_odd_tables(spark, odd, monkeypatch):
    items = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (None, "one two"), (4, "x x x x x x x")], "item_id long, text string")
    got = sorted(tuple(r)[:3] for r in dc.find_items(odd, items).collect())
    assert got == [(5, 1, 0), (6, 1, 0), (7, 4, 0)]
    monkeypatch.setattr(dc, "ITEMS_PER_PASS", 1)
    assert len(list(dc.passes(items))) == 4 and sorted(tuple(r)[:3] for r in dc.find_items(odd, items).collect()) == got
    assert dc.find_items(odd.limit(0), items).count() == 0 and dc.find_items(odd, items.limit(0)).count() == 0


def test_stage_drops_only_leaking_documents(spark, odd, tmp_path):
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = dc.decontamination_stage(spark, odd, str(tmp_path))
    assert left.columns == odd.columns and left.count() == odd.count() - 3 and not left.filter("doc_id IN (5, 6)").count()


def test_passes_of_any_size_find_alike(spark, documents, monkeypatch):
    rng = random.Random(4)
    short, long = passage(rng, 20), passage(rng, 40)
    items = spark.createDataFrame([(1, " ".join(short)), (1, " ".join(long)), (2, " ".join(short)), (3, " ".join(long[:20]))], "item_id long, text string")
    docs = documents([(1, " ".join(long + ["x"] + edited(rng, short, 2))), (2, " ".join(short)), (2, " ".join(long)), (3, "")])
    once = sorted(map(tuple, dc.find_items(docs, items).collect()))
    assert len({r[:2] for r in once if r[0] == 1}) == len([r for r in once if r[0] == 1])
    assert all(r[3] == 40 for r in once if r[:2] == (1, 1)) and {r[3] for r in once if r[:2] == (2, 1)} == {20, 40}
    for size in (1, 2, 3):
        monkeypatch.setattr(dc, "ITEMS_PER_PASS", size)
        assert sorted(map(tuple, dc.find_items(docs, items).collect())) == once


def test_edits_in_one_place():
    rng = random.Random(5)
    for n in (31, 47, 59, 63, 100, 127):
        found, trials = 0, 60
        for trial in range(trials):
            item = [f"i{rng.randrange(10**6)}" for _ in range(n)]
            k = dc.allowed(n)
            # Every other word at the head, at the tail, or in the middle.
            begin = (0, n - 2 * k, (n - 2 * k) // 2)[trial % 3]
            text = list(item)
            for i in range(begin, begin + 2 * k, 2):
                text[i] = f"e{rng.randrange(10**6)}"
            around = lambda: [f"a{rng.randrange(10**6)}" for _ in range(30)]
            found += 0 in dc.hits_of(dc.ItemIndex([(7, " ".join(item))], seed=trial), " ".join(around() + text + around()))
        assert found >= 0.98 * trials, (n, found)
