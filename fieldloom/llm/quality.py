"""A quality classifier: cumulative-link (proportional-odds) regression on graded ratings.

The grades are ordered: 0 toxic, 1 poor, 2 good. One weight vector over hashed words and hashed shape features
gives a text's score s, and ordered thresholds t0 < t1 cut it: P(grade <= k) = sigmoid(t_k - s). From that come
the expected grade and the tail probability P(grade = 2), by which texts are selected.

Weights are fitted on a bounded sample of labelled texts (SAMPLE, by the hash of doc_id) with a penalty that
keeps only weights which the ratings support; every text is then scored whole.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Labelled texts that the model is fitted on, at most.
SAMPLE = 12_000
#: Width of the hashed weight vector, and labelled texts that must share a feature.
DIMENSIONS, LEAST_TEXTS = 1 << 18, 6
#: Texts below this probability of the best grade are rejected.
LEAST_TAIL = 0.5
GRADES = 3

WORDS = regex.compile(r"\p{L}+")
SYMBOLS = regex.compile(r"[^\w\s.,;:'\"()?!|-]")
_slots = common.owned("quality", common.TwoGenerationCache(60_000))


def slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % DIMENSIONS


def shape(text: str, tokens: list[str]) -> list[str]:
    """Coarse measures of a text's form, as features of their own."""
    n = max(1, len(tokens))
    share = lambda name, x: f"\0{name}={min(9, int(10 * x))}"
    measures = {
        "repeats": sum(map(str.__eq__, tokens, tokens[1:])) / n,
        "bars": text.count("|") / n,
        "symbols": len(SYMBOLS.findall(text)) / n,
        "shouting": sum(map(str.isupper, tokens)) / n,
        "exclaims": text.count("!") / n / 2,
    }
    some = [share(name, x) for name, x in measures.items()]
    some += [f"\0{name}>{least}" for name, x in measures.items() for least in (0.02, 0.05, 0.1, 0.2, 0.4) if x > least]
    some.append(f"\0length={min(12, n.bit_length())}")
    some.append(share("distinct", len(set(tokens)) / n))
    return some


def features(text: str | None) -> set[int]:
    """The hashed features of a whole text; each counts once."""
    text = text or ""
    found = {_slots.find(w, slot) if len(w) < 40 else slot(w) for w in set(WORDS.findall(text.lower()))}
    found.update(map(slot, shape(text, text.split())))
    return found


@dataclass
class OrdinalModel:
    """Nonzero weights by slot, and the thresholds in ascending order."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def grades(self, text: str | None) -> tuple[float, float]:
        """Expected grade and probability of the best grade."""
        find = self.weights.get
        score = math.fsum([w for f in features(text) if (w := find(f))])
        below = [1 / (1 + math.exp(min(700.0, score - t))) for t in self.thresholds]
        return len(below) - math.fsum(below), 1 - below[-1]


def fit(examples: list[tuple[int, np.ndarray]], rounds: int = 160, rate: float = 0.15, penalty: float = 4e-4) -> OrdinalModel:
    """Maximum likelihood with an L1 penalty, by proximal adaptive gradient steps over all examples."""
    if not examples:
        # Without ratings nothing speaks against a text.
        return OrdinalModel({}, tuple(-20.0 + k for k in range(GRADES - 1)))
    y = np.array([g for g, _ in examples])
    flat = np.concatenate([f for _, f in examples]).astype(np.int32)
    texts = np.bincount(flat, minlength=DIMENSIONS)
    used = np.flatnonzero(texts >= min(LEAST_TEXTS, len(examples)))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(y), dtype=np.int32), [len(f) for _, f in examples])
    keep = place[flat] >= 0
    at, owner = place[flat][keep], owner[keep]
    del flat, keep

    weights, squares = np.zeros(len(used)), np.full(len(used), 1e-8)
    # t0, and the logarithm of t1 - t0.
    cuts, cut_squares = np.array([-2.0, 0.0]), np.full(2, 1e-8)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for _ in range(rounds):
        t0, gap = cuts[0], np.exp(cuts[1])
        s = np.bincount(owner, weights[at], minlength=len(y))
        a, b = sigmoid(t0 - s), sigmoid(t0 + gap - s)
        p = np.clip(np.select([y == 0, y == 1], [a, b - a], 1 - b), 1e-9, None)
        da, db = a * (1 - a), b * (1 - b)
        # d log p / d t0, d t1; that by s is the negative of their sum.
        by0 = np.select([y == 0, y == 1], [da, -da], 0) / p
        by1 = np.select([y == 1, y == 2], [db, -db], 0) / p
        slope = np.bincount(at, (by0 + by1)[owner], minlength=len(used)) / len(y)
        squares += slope * slope
        step = rate / np.sqrt(squares)
        weights -= step * slope
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * penalty)
        cut_slope = -np.array([(by0 + by1).mean(), (by1 * gap).mean()])
        cut_squares += cut_slope * cut_slope
        cuts -= rate / np.sqrt(cut_squares) * cut_slope
    t0 = float(cuts[0])
    nonzero = np.flatnonzero(weights)
    return OrdinalModel({int(used[i]): float(weights[i]) for i in nonzero}, (t0, t0 + float(np.exp(cuts[1]))))


def graded(labels: DataFrame) -> DataFrame:
    """One grade for each doc_id: the worst of its ratings; ratings with a null are left out."""
    grade = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> OrdinalModel:
    """Fit the model on at most bound rated documents, chosen by the hash of doc_id.

    Ratings with a null are left out. A null text counts as empty, and of several texts of one doc_id the one with the
    least features, in byte order, is taken. Without any rated document the model keeps every text."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)

    def extract(batches):
        common.claim("quality")
        for whole in batches:
            for batch in common.slices(whole):
                found = [np.fromiter(sorted(features(t.as_py())), np.int32).tobytes() for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade").cast(pa.int32()), pa.array(found, pa.binary())], names=["doc_id", "grade", "slots"])

    # The bound proves the size of the broadcast side. Features are made where the texts are read, and only they move.
    rated = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")
    rows = rated.mapInArrow(extract, "doc_id long, grade int, slots binary").groupBy("doc_id", "grade").agg(F.min("slots").alias("slots")).collect()
    # In a fixed order, sums come out the same in every run.
    return fit([(r.grade, np.frombuffer(r.slots, np.int32)) for r in sorted(rows, key=lambda r: r.doc_id)])


SCORED = T.StructType(
    [
        T.StructField("expected_grade", T.DoubleType()),
        T.StructField("tail_probability", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def score(text, model: OrdinalModel, least_tail: float = LEAST_TAIL):
    """A column of (expected_grade, tail_probability, kept) for a column of whole texts; a null counts as empty."""
    schema = pa.struct([("expected_grade", pa.float64()), ("tail_probability", pa.float64()), ("kept", pa.bool_())])

    @F.arrow_udf(SCORED)
    def scored(texts: pa.Array) -> pa.Array:
        common.claim("quality")
        rows = [model.grades(t.as_py()) for t in texts]
        return pa.array([{"expected_grade": e, "tail_probability": p, "kept": p >= least_tail} for e, p in rows], schema)

    return scored(text)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade, probability of the best grade and whether it is kept.

    A null text counts as empty. Rows are scored one by one, so repeated rows and null ids give a row each.
    Without any labelled document all are kept.
    """
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, common.table(spark, sf_dir, "labels"))
    return documents.select("doc_id", score(F.col("text"), model).alias("s")).select("doc_id", "s.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's first stage: documents that the classifier rejects go; columns stay as they are.

    Rows are judged by their text alone, so null ids and repeated rows are like others; a null text counts as empty.
    Without labels all stay, and an empty docs stays empty."""
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return docs.filter(score(docs["text"], model)["kept"])


QUERIES = {"op8_quality": op8_quality}
ORACLES: dict[str, str] = {}
