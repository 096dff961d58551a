import random

import numpy as np

from fieldloom.llm import quality

WORDS = [a + b for a in ("an", "er", "in", "on", "th") for b in ("ed", "es", "ing", "ly", "ou", "at")]


def text(rng, grade):
    words = rng.choices(WORDS, k=rng.randint(20, 120))
    if grade == 1:
        words = [w + rng.choice(["###", "%%%"]) for w in words]
    if grade == 0:
        words[rng.randrange(len(words))] = rng.choice(["dreadful", "nasty", "vile"])
    return " ".join(words) + "."


def test_held_out_accuracy():
    rng = random.Random(1)
    rows = [(g, text(rng, g)) for g in rng.choices([0, 1, 2], weights=[1, 1, 4], k=1500)]
    examples = [(g, np.fromiter(sorted(quality.features(t)), np.int32)) for g, t in rows]
    model = quality.fit(examples[:1000])
    assert model.thresholds[0] < model.thresholds[1]
    right = sum((model.grades(t)[1] >= 0.5) == (g == 2) for g, t in rows[1000:])
    assert right >= 490
    good, bad = model.grades(text(rng, 2)), model.grades(text(rng, 0))
    assert good[0] > 1.5 > bad[0] and 0 <= bad[1] <= good[1] <= 1


def test_no_labels_and_one_grade(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(odd, labels)
    assert all(model.grades(t)[1] > 0.5 for t in (None, "", "anything"))
    same = quality.train(odd, spark.createDataFrame([(5, 1, 0), (6, 1, 0)], labels.schema))
    assert same.grades("one two")[1] > 0.5


def test_grades_of_labels(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, 0), (None, 1, 0), (5, 1, None)]
    got = {r.doc_id: r.grade for r in quality.graded(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()}
    assert got == {1: 1, 2: 0, 3: 2}


def test_query_and_stage(spark, odd, tmp_path):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, text(rng, i % 3)) for i in range(300)] + [(None, None), (7, None), (400, "")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = quality.op8_quality(spark, str(tmp_path))
    assert got.count() == 303 and got.filter("tail_probability IS NULL").count() == 0
    kept = quality.quality_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(i % 3 == 2 for i in ids if i is not None and i < 300) >= 98 and sum(i % 3 != 2 for i in ids if i is not None and i < 300) <= 6
    assert quality.quality_stage(spark, odd, str(tmp_path)).columns == odd.columns
    assert quality.quality_stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def objective(weights, cuts, examples, slots, penalty):
    """Mean negative log likelihood and L1 penalty, written out anew for each text."""
    import math

    total = 0.0
    for grade, found in examples:
        s = sum(weights[slots.index(f)] for f in found if f in slots)
        below = [0.0, *(1 / (1 + math.exp(s - t)) for t in cuts), 1.0]
        total -= math.log(max(1e-12, below[grade + 1] - below[grade]))
    return total / len(examples) + penalty * sum(map(abs, weights))


def test_fit_against_a_second_optimiser():
    rng = random.Random(3)
    slots, true = list(range(100, 108)), [1.5, -1.5, 0.8, -0.4, 0, 0, 2, -2]
    examples = []
    for _ in range(400):
        found = [f for f in slots if rng.random() < 0.4]
        score = sum(true[slots.index(f)] for f in found) + np.log(1 / rng.uniform(1e-9, 1 - 1e-9) - 1)
        examples.append((0 if score < -1.5 else 1 if score < 0 else 2, np.array(found, np.int32)))
    penalty = 1e-3
    model = quality.fit(examples, rounds=1500, penalty=penalty)
    got = objective([model.weights.get(f, 0.0) for f in slots], model.thresholds, examples, slots, penalty)
    # Pattern search: steps along one coordinate at a time, halved when none helps.
    x, step = [0.0] * len(slots) + [-1.0, 1.0], 1.0
    value = lambda x: objective(x[:-2], x[-2:], examples, slots, penalty)
    best = value(x)
    while step > 0.01:
        moved = False
        for i in range(len(x)):
            for change in (step, -step):
                y = [v + change * (k == i) for k, v in enumerate(x)]
                if y[-2] < y[-1] and (now := value(y)) < best - 1e-9:
                    x, best, moved = y, now, True
        step = step if moved else step / 2
    assert got <= best + 2e-3
    assert max(abs(a - b) for a, b in zip(x, [*(model.weights.get(f, 0.0) for f in slots), *model.thresholds])) < 0.25


def test_very_long_and_repeated_texts(spark):
    rng = random.Random(4)
    rows = [(i % 50, text(rng, i % 3)) for i in range(150)] + [(60, text(rng, 2) * 2000), (60, None)] * 2
    labels = spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i in range(61)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    one, two = quality.train(docs, labels), quality.train(docs.repartition(7), labels)
    assert one.weights == two.weights and one.thresholds == two.thresholds
    assert 0 <= one.grades(rows[-2][1])[1] <= 1
