"""Language-model scoring: Katz backoff over n-grams of any order, with Good-Turing discounts.

P(w | h) = d(c(hw)) c(hw) / c(h)      if the training texts hold hw,
           alpha(h) P(w | h')         otherwise, where h' is h without its first word, and
P(w)     = d(c(w)) c(w) / N           if they hold w; what that leaves is the one unknown word's.

d(r) discounts counts r up to MOST_DISCOUNTED by Katz's formula from the numbers of n-grams with each count, apart for
each order; greater counts are taken as they are. alpha(h) makes each context's probabilities sum to one exactly:

alpha(h) = (1 - sum of the discounted shares) / (1 - sum of P(w | h') over the words seen after h).

Where no follower of h is discounted, c(h) is increased by one, so that some mass is left to back off to. A text begins
behind one start; a token with fewer words before it than an order asks for has the probability of the order below.

How it runs. Documents are gathered in batches of about TOKENS_PER_BATCH tokens and stored once as a table, each
batch with its own sorted vocabulary of word hashes and its tokens as numbers in it. The n-grams of each order are a
stored table too, partitioned into buckets. Order by order a batch sends to each bucket the distinct n-grams that fall to it,
with their training counts and what the order below gives for them; the bucket adds up what all batches sent, and
answers each with the totals, the n-grams' numbers, by which the next order knows its contexts, and what alpha
follows from. Words fall to buckets by hash, longer n-grams by context, and those of a context that would fill a
bucket are spread by word. A bucket's load is bounded by the number of buckets, which grows with the corpus; a batch
sends a row to a bucket only if it has an n-gram there, so the rows are never more than the n-grams.

Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Counts that Good-Turing discounts reach, as in Katz's paper.
MOST_DISCOUNTED = 5
#: The discount where counts of counts cannot give one.
FALLBACK = 0.5
TOKENS_PER_BATCH, TOKENS_PER_BUCKET, LEAST_BUCKETS = 2_000_000, 1_500_000, 8
#: A context with fewer tokens is never spread over buckets, and so many contexts are at most: each worker has their sums.
LEAST_SPREAD, MOST_SPREAD = 1000, 1_000_000
#: The order of the registered query: a third one would take more disk than the check allows (see the README).
ORDER = 2
#: Words that no text can hold: the end, which is counted, and the start, which is only a context.
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\n", b"\n\n"))

CORPUS = "batch long, doc_ids array<long>, held array<boolean>, ends array<long>, tokens binary, vocabulary binary"
ANSWER = pa.schema(
    [("level", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("counts", pa.binary()), ("ids", pa.binary()), ("plain", pa.binary()), ("lower", pa.list_(pa.float64())), ("few", pa.binary()), ("stats", pa.list_(pa.int64()))]
)
ANSWERS = "level int, bucket int, batch long, counts binary, ids binary, plain binary, lower array<double>, few binary, stats array<long>"
#: What a batch asks of a bucket, beside the two numbers.
ASKED = ("contexts", "context_counts", "divisors", "needs", "lengths", "words", "lower_counts", "trained")

_hasher = common.owned("katz", common.WordHasher())


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as they need, byte planes apart, so that small ones compress."""
    values = np.asarray(values, np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).reshape(-1)


def runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def gather(df: DataFrame, is_held, tokens_per_batch: int = TOKENS_PER_BATCH) -> DataFrame:
    """The corpus as a table of batches; a null or blank text is an end alone."""

    def batched(batches):
        def close():
            ends = np.cumsum(lengths)
            flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            vocabulary = np.unique(np.concatenate([flat, np.array([END, START], np.uint64)]))
            tokens = np.searchsorted(vocabulary, flat)
            return pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([pack(tokens)]), pa.array([vocabulary.tobytes()])],
                names=["batch", "doc_ids", "held", "ends", "tokens", "vocabulary"],
            )

        common.claim("katz")
        ids, held, lengths, hashes, key = [], [], [], [], 0
        for whole in batches:
            for batch in common.slices(whole, 128):
                for doc, h, text, mark in zip(*(batch.column(c) for c in range(4))):
                    words = _hasher.hashes(common.ascii_lower_words(text.as_py()))
                    if not ids:
                        key = mark.as_py()
                    ids.append(doc.as_py())
                    held.append(h.as_py())
                    lengths.append(len(words))
                    hashes.append(words)
                if sum(lengths) + len(lengths) >= tokens_per_batch:
                    yield close()
                    ids, held, lengths, hashes = [], [], [], []
        if ids:
            yield close()

    # The mark of a batch's first row is unique; it is fixed when the table is written.
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(is_held, F.lit(False)).alias("held"), "text", F.monotonically_increasing_id().alias("mark"))
    return rows.mapInArrow(batched, CORPUS)


@dataclass
class Batch:
    """One batch: its documents and its tokens, an end behind each document, with the context of each token."""

    key: int
    doc_ids: list
    held: np.ndarray
    vocabulary: np.ndarray
    tokens: np.ndarray
    contexts: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, row: dict) -> "Batch":
        ends = np.array(row["ends"], np.int64)
        words = unpack(row["tokens"]).astype(np.int64)
        vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        end, start = np.searchsorted(vocabulary, [END, START])
        tokens = np.insert(words, ends, end)
        begins = np.concatenate([[0], ends[:-1]]) + np.arange(len(ends))
        contexts = np.concatenate([[start], tokens[:-1]])
        contexts[begins] = start
        return cls(row["batch"], row["doc_ids"], np.array(row["held"], bool), vocabulary, tokens, contexts, begins)

    def of_documents(self, values: np.ndarray) -> np.ndarray:
        """Repeat a value per document for each of its tokens."""
        return np.repeat(values, np.diff(np.append(self.begins, len(self.tokens))))

    def word_counts(self) -> np.ndarray:
        """Training counts of the vocabulary; for the start, the number of training documents."""
        out = np.bincount(self.tokens[~self.of_documents(self.held)], minlength=len(self.vocabulary))
        out[np.searchsorted(self.vocabulary, START)] = int((~self.held).sum())
        return out


@dataclass
class Level:
    """Discounts d(1..MOST_DISCOUNTED) of one order of n-grams, from the numbers of n-grams by count."""

    discounts: np.ndarray

    @classmethod
    def of(cls, by_count: list[int]) -> "Level":
        """by_count[r - 1] is the number of n-grams seen r times, r up to MOST_DISCOUNTED + 1."""
        k, n = MOST_DISCOUNTED, [0, *by_count]
        out = np.full(k, math.nan)
        if n[1]:
            rest = (k + 1) * n[k + 1] / n[1]
            for r in range(1, k + 1):
                if n[r] and rest < 1:
                    out[r - 1] = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest)
        # A discount outside (0, 1) would give no probability, or take none away.
        unusable = ~((out > 0) & (out < 1))
        out[unusable] = ((np.arange(1, k + 1) - FALLBACK) / np.arange(1, k + 1))[unusable]
        return cls(out)

    def factor(self, counts: np.ndarray) -> np.ndarray:
        out = np.ones(len(counts))
        low = (counts > 0) & (counts <= MOST_DISCOUNTED)
        out[low] = self.discounts[counts[low].astype(np.int64) - 1]
        return out


@dataclass
class WordLevel:
    """P(w) by count, with the unknown word's share."""

    level: Level
    total: int
    types: int
    unknown: float

    @classmethod
    def of(cls, total: int, types: int, by_count: list[int]) -> "WordLevel":
        level = Level.of(by_count)
        # Of each token with a discounted count the share 1 - d is left.
        left = sum((1 - d) * r * n for r, (d, n) in enumerate(zip(level.discounts, by_count), 1))
        # Where no count is discounted, one more token is taken as seen: the unknown word.
        return cls(level, total if left else total + 1, types, left / total if left else 1 / (total + 1))

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        p = self.level.factor(counts) * counts / max(1, self.total)
        return np.where(counts > 0, p, self.unknown)


def count_words(corpus: DataFrame, buckets: int) -> DataFrame:
    """For each batch and bucket the totals and the numbers (ids) of the batch's words there, and per bucket stats.

    stats (in rows without a batch): tokens, types, training documents, then types by count."""

    def ask(batches):
        for rows in batches:
            for row in rows.to_pylist():
                batch = Batch.of(row)
                counts = batch.word_counts()
                bucket = (batch.vocabulary % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                begin = runs(bucket[order])
                parts = np.split(order, begin[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[order][begin], pa.int32()), pa.array([batch.key] * len(parts)), pa.array([batch.vocabulary[p].tobytes() for p in parts]), pa.array([pack(counts[p]) for p in parts])],
                    names=["bucket", "batch", "words", "counts"],
                )

    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        bucket = rows[0]["bucket"]
        words = [np.frombuffer(r["words"], np.uint64) for r in rows]
        flat = np.concatenate(words)
        distinct, place = np.unique(flat, return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, np.concatenate([unpack(r["counts"]) for r in rows]).astype(np.int64))
        ids = np.arange(len(distinct), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket)
        counted = totals[(distinct != START) & (totals > 0)]
        by_count = [int((counted == r).sum()) for r in range(1, MOST_DISCOUNTED + 2)]
        out, at = [], 0
        for r, w in zip(rows, words):
            here = place[at : at + len(w)]
            at += len(w)
            out.append({"level": 1, "bucket": bucket, "batch": r["batch"], "counts": pack(totals[here]), "ids": pack(ids[here])})
        documents = int(totals[distinct == START].sum())
        out.append({"level": 1, "bucket": bucket, "stats": [int(counted.sum()), len(counted), documents, *by_count]})
        return pa.Table.from_pylist(out, ANSWER)

    asked = corpus.mapInArrow(ask, "bucket int, batch long, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, ANSWERS)


def buckets_of(context_ids: np.ndarray, word_ids: np.ndarray, context_counts: np.ndarray, full: int, buckets: int) -> np.ndarray:
    """Where an n-gram falls: by its context, and one of a context with over `full` tokens by its word too."""
    spread = (context_counts // max(1, full) + 1).astype(np.uint64)
    mix = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return ((mix(context_ids) + mix(word_ids) % spread) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Wide:
    """Sums over the buckets of contexts that are spread, by number: lower and few as in Order.learn."""

    ids: np.ndarray
    lower: np.ndarray
    few: np.ndarray


@dataclass
class Model:
    """What is known of all orders so far, small enough for every worker."""

    words: WordLevel
    full: int
    buckets: int
    levels: list[Level]
    wide: list[Wide]
    #: Training tokens.
    total: int


class Order:
    """A batch's view of one order of n-grams: for each token the place of its n-gram, and for each n-gram its number and
    totals once they are learnt. The first order's n-grams are the vocabulary."""

    def __init__(self, batch: Batch, counts: np.ndarray, ids: np.ndarray, probabilities: np.ndarray) -> None:
        self.batch, self.place, self.counts, self.ids = batch, batch.tokens, counts, ids
        #: Each token's probability by this order and those below.
        self.p = probabilities[batch.tokens]
        self.active = np.ones(len(batch.tokens), bool)

    @classmethod
    def first(cls, batch: Batch, rows: list[dict], model: Model) -> "Order":
        totals, ids = np.zeros(len(batch.vocabulary), np.int64), np.zeros(len(batch.vocabulary), np.uint64)
        bucket = (batch.vocabulary % np.uint64(model.buckets)).astype(np.int64)
        for row in rows:
            here = bucket == row["bucket"]
            totals[here], ids[here] = unpack(row["counts"]).astype(np.int64), unpack(row["ids"])
        out = cls(batch, totals, ids, model.words.probabilities(totals))
        # c / divisor is a word's share before its discount.
        out.divisor_of_token = np.full(len(batch.tokens), max(1, model.words.total))
        out.words, out.word_counts = ids, totals
        return out

    @classmethod
    def above(cls, below: "Order", model: Model, level: int) -> "Order":
        """The order above another one, its n-grams listed bucket by bucket, by context within a bucket."""
        self, batch = cls.__new__(cls), below.batch
        self.batch, self.below, self.words, self.word_counts = batch, below, below.words, below.word_counts
        # A token's context is the n-gram of the order below that ends before it.
        context = np.concatenate([[0], below.place[:-1]])
        self.active = np.concatenate([[False], below.active[:-1]])
        if level == 2:
            context, self.active = batch.contexts, np.ones(len(batch.tokens), bool)
        else:
            self.active[batch.begins] = False
        at = np.flatnonzero(self.active)
        key = context[at] * len(batch.vocabulary) + batch.tokens[at]
        order = np.argsort(key, kind="stable")
        begin = runs(key[order])
        distinct = key[order][begin]
        trained = np.add.reduceat((~batch.of_documents(batch.held))[at][order].astype(np.int64), begin) if len(begin) else np.empty(0, np.int64)
        h, w, some = distinct // len(batch.vocabulary), distinct % len(batch.vocabulary), at[order][begin]
        bucket = buckets_of(below.ids[h], self.words[w], below.counts[h], model.full, model.buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        rank = np.empty(len(distinct), np.int64)
        rank[by_bucket] = np.arange(len(distinct))
        self.place = np.zeros(len(batch.tokens), np.int64)
        self.place[at[order]] = np.repeat(rank, np.diff(np.append(begin, len(key))))
        self.h, self.w, self.trained, some = h[by_bucket], w[by_bucket], trained[by_bucket], some[by_bucket]
        self.context = context
        self.cut = np.searchsorted(bucket[by_bucket], np.arange(model.buckets + 1))
        # What the order below gives for each n-gram without its first word: a count, and a divisor of its context.
        self.lower_counts, self.divisors = below.counts[below.place[some]], below.divisor_of_token[some]
        # Only held-out documents can meet an n-gram that the training texts lack.
        self.needs = np.zeros(len(below.counts), bool)
        self.needs[context[self.active & batch.of_documents(batch.held)]] = True
        return self

    def asked(self) -> list[dict]:
        """A row for each bucket that has an n-gram of the batch."""
        out = []
        for b in np.flatnonzero(np.diff(self.cut)).tolist():
            low, high = self.cut[b], self.cut[b + 1]
            h = self.h[low:high]
            begin = runs(h)
            once = h[begin]
            values = {
                "contexts": self.below.ids[once],
                "context_counts": self.below.counts[once],
                "divisors": self.divisors[low:high][begin],
                "needs": self.needs[once],
                "lengths": np.diff(np.append(begin, high - low)),
                "words": self.words[self.w[low:high]],
                "lower_counts": self.lower_counts[low:high],
                "trained": self.trained[low:high],
            }
            out.append({"bucket": b, "batch": self.batch.key, **{n: pack(v) for n, v in values.items()}})
        return out

    def learn(self, rows: list[dict], level: Level, wide: Wide, full: int) -> None:
        """Take the buckets' answers: totals, numbers, and for contexts with unseen n-grams to score `lower`, the sum of the
        order below's probabilities over the words seen after them, and `few`, their n-grams by count."""
        size = len(self.below.counts)
        self.counts, self.ids = np.zeros(len(self.h), np.int64), np.zeros(len(self.h), np.uint64)
        plain, lower, few = np.zeros(size, bool), np.zeros(size), np.zeros((MOST_DISCOUNTED, size), np.int64)
        for r in rows:
            low, high = self.cut[r["bucket"]], self.cut[r["bucket"] + 1]
            self.counts[low:high] = unpack(r["counts"]).astype(np.int64)
            if r["ids"] is not None:
                self.ids[low:high] = unpack(r["ids"])
            once = self.h[low:high][runs(self.h[low:high])]
            plain[once] = unpack(r["plain"]) > 0
            needed = once[self.needs[once]]
            lower[needed] = r["lower"]
            few[:, needed] = unpack(r["few"]).astype(np.int64).reshape(MOST_DISCOUNTED, -1)
        spread = np.flatnonzero(self.below.counts // max(1, full) > 0)
        if len(spread) and len(wide.ids):
            at = np.minimum(np.searchsorted(wide.ids, self.below.ids[spread]), len(wide.ids) - 1)
            hit = wide.ids[at] == self.below.ids[spread]
            spread, at = spread[hit], at[hit]
            lower[spread], few[:, spread] = wide.lower[at], wide.few[:, at]
            plain[spread] = (wide.few[:, at] == 0).all(axis=0)
        alpha = alphas(level, self.below.counts, lower, few)
        divisor = self.below.counts + plain
        share = level.factor(self.counts) * self.counts / np.maximum(1, divisor[self.h])
        at = np.flatnonzero(self.active)
        mine, context = self.place[at], self.context[at]
        self.p, self.divisor_of_token = self.below.p.copy(), np.ones(len(self.place), np.int64)
        self.p[at] = np.where(self.counts[mine] > 0, share[mine], alpha[context] * self.below.p[at])
        self.divisor_of_token[at] = np.maximum(1, divisor[context])


def orders_of(row: dict, answers: list[dict], model: Model) -> Order:
    """The highest order that the answers tell of, of one batch."""
    by_level: dict[int, list[dict]] = {}
    for r in answers:
        by_level.setdefault(r["level"], []).append(r)
    now = Order.first(Batch.of(row), by_level[1], model)
    for level, discounts, wide in zip(range(2, 2 + len(model.levels)), model.levels, model.wide):
        now = Order.above(now, model, level)
        now.learn(by_level.get(level, []), discounts, wide, model.full)
    return now


def count_order(joined, level: int, model: Model, numbered: bool) -> DataFrame:
    """For each batch and bucket what Order.learn takes for the n-grams of one order, from batches and the answers of all
    orders below. Of contexts that are spread over buckets the answers are a bucket's part; rows without a batch list
    them (ids, lower, few), and carry in stats the types by count."""
    below = model.levels[-1] if model.levels else model.words.level

    def ask(_, left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        out = [r for row in left.to_pylist() for r in Order.above(orders_of(row, replies, model), model, level).asked()]
        return pa.Table.from_pylist(out, pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), *[(n, pa.binary()) for n in ASKED]]))

    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        bucket = rows[0]["bucket"]
        every = {n: [unpack(r.pop(n)) for r in rows] for n in ASKED}
        lengths = [n.astype(np.int64) for n in every.pop("lengths")]
        contexts = np.concatenate([np.repeat(c, n) for c, n in zip(every["contexts"], lengths)])
        sizes = [len(w) for w in every["words"]]
        # A bucket's arrays are the largest that a worker holds; each goes once it has served.
        followers = np.concatenate(every.pop("words"))
        if (int(contexts.max()) | int(followers.max())) < 1 << 32:
            order = np.argsort(contexts << np.uint64(32) | followers, kind="stable")
        else:
            order = np.lexsort((followers, contexts))
        c, f = contexts[order], followers[order]
        begin = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (f[1:] != f[:-1])]))
        counts = np.add.reduceat(np.concatenate(every.pop("trained")).astype(np.int64)[order], begin)
        del contexts, followers, f
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        # Each distinct context's followers that were seen.
        owner = c[begin]
        first = runs(owner)
        known = owner[first]
        del c, owner
        seen = counts > 0
        some = order[begin]
        lower_counts = np.concatenate(every.pop("lower_counts"))[some].astype(np.int64)
        divisors = np.concatenate([np.repeat(d, n) for d, n in zip(every.pop("divisors"), lengths)])[some]
        # A word that follows in a training text is known to the order below.
        lower = np.where(seen, below.factor(lower_counts) * lower_counts / np.maximum(1, divisors), 0)
        lower = np.add.reduceat(lower, first)
        few = np.stack([np.add.reduceat((counts == r).astype(np.int64), first) for r in range(1, MOST_DISCOUNTED + 1)])
        ids = np.arange(len(counts), dtype=np.uint64) * np.uint64(model.buckets) + np.uint64(bucket)
        out, at = [], 0
        spread = np.zeros(len(known), bool)
        for i, r in enumerate(rows):
            at_context = np.searchsorted(known, every["contexts"][i])
            wide = every["context_counts"][i] // np.uint64(max(1, model.full)) > 0
            spread[at_context[wide]] = True
            asked = at_context[every["needs"][i] > 0]
            here = place[at : at + sizes[i]]
            at += sizes[i]
            out.append(
                {
                    "level": level,
                    "bucket": bucket,
                    "batch": r["batch"],
                    "counts": pack(counts[here]),
                    "ids": pack(ids[here]) if numbered else None,
                    "plain": pack((few[:, at_context] == 0).all(axis=0)),
                    "lower": lower[asked].tolist(),
                    "few": pack(few[:, asked].reshape(-1)),
                }
            )
        by_count = [int((counts == r).sum()) for r in range(1, MOST_DISCOUNTED + 2)]
        out.append({"level": level, "bucket": bucket, "ids": pack(known[spread]), "lower": lower[spread].tolist(), "few": pack(few[:, spread].reshape(-1)), "stats": by_count})
        return pa.Table.from_pylist(out, ANSWER)

    asked = joined.applyInArrow(ask, "bucket int, batch long, " + ", ".join(f"{n} binary" for n in ASKED))
    return asked.groupBy("bucket").applyInArrow(answer, ANSWERS)


def alphas(level: Level, counts: np.ndarray, lower: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Backoff weights of contexts from their counts, sums of the order below over seen words, and types by count."""
    by = np.arange(1, MOST_DISCOUNTED + 1)[:, None]
    left = ((1 - level.discounts)[:, None] * by * few).sum(axis=0)
    left = np.where(left > 0, left / np.maximum(1, counts), 1 / (counts + 1))
    # A context that was never seen has no followers: all of its mass backs off.
    return np.where(counts > 0, left / np.maximum(1 - lower, 1e-300), 1.0)


def wide_of(stats: DataFrame) -> Wide:
    """The sums of spread contexts, of which there are at most MOST_SPREAD."""
    found: dict[int, tuple[float, np.ndarray]] = {}
    for row in stats.orderBy("bucket").toLocalIterator():
        few = unpack(row.few).astype(np.int64).reshape(MOST_DISCOUNTED, -1)
        for i, (context, lower) in enumerate(zip(unpack(row.ids).tolist(), row.lower)):
            before = found.get(context, (0.0, np.zeros(MOST_DISCOUNTED, np.int64)))
            found[context] = (before[0] + lower, before[1] + few[:, i])
    ids = sorted(found)
    return Wide(np.array(ids, np.uint64), np.array([found[i][0] for i in ids]), np.array([found[i][1] for i in ids], np.int64).reshape(-1, MOST_DISCOUNTED).T)


def score_batches(corpus: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Each document's log10 probability and its add-one baseline."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )
    total, types = model.total, model.words.types

    def score(_, left: pa.Table, right: pa.Table) -> pa.Table:
        tables, replies = [], right.to_pylist()
        for row in left.to_pylist():
            top = orders_of(row, replies, model)
            batch, counts = top.batch, top.word_counts
            known = (counts > 0)[batch.tokens]
            base = np.log10((counts + 1) / (total + types + 1))[batch.tokens]
            lengths = np.diff(np.append(batch.begins, len(batch.tokens)))
            sums = lambda x: np.add.reduceat(x, batch.begins)  # noqa: E731, B023
            tables.append(
                pa.table(
                    [pa.array(batch.doc_ids, pa.int64()), pa.array(batch.held), pa.array(lengths), pa.array(sums(known.astype(np.int64))), pa.array(np.full(len(lengths), total)), pa.array(sums(base)), pa.array(sums(np.log10(top.p)))],
                    schema=schema,
                )
            )
        return pa.concat_tables(tables) if tables else schema.empty_table()

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return corpus.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, kinds)


def score_documents(df: DataFrame, is_held, order: int = 3, tokens_per_batch: int = TOKENS_PER_BATCH, tokens_per_bucket: int = TOKENS_PER_BUCKET, least_spread: int = LEAST_SPREAD) -> DataFrame:
    """Score every whole text of (doc_id, text) with a model of n-grams of up to `order` words, learnt from those where
    is_held does not hold.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (of words and ends that the training texts hold),
    train_tokens, base_score (add-one word model) and score (Katz), both log10, one row per row. Null, empty and
    blank texts are an end alone. Rows with a null doc_id are scored, and where is_held is null they train.
    Repeated rows train and are scored each. Without training texts every token is the unknown word, at
    probability one. An empty df gives an empty result. Other columns are not read.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    corpus = common.written(gather(df, is_held, tokens_per_batch), "corpus")
    tokens = corpus.agg(F.sum(F.element_at("ends", -1) + F.size("ends"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(tokens / tokens_per_bucket))
    counted = common.written(count_words(corpus, buckets), "ngrams-1")
    at = [F.sum(F.col("stats")[i]) for i in range(3 + MOST_DISCOUNTED + 1)]
    total, types, _, *by_count = [x or 0 for x in counted.filter("batch IS NULL").agg(*at).first()]
    # A context with over this many tokens is spread.
    full = max(least_spread, total // min(4 * buckets, MOST_SPREAD))
    model = Model(WordLevel.of(total, types, by_count), full, buckets, [], [], total)
    answers = counted.filter("batch IS NOT NULL").drop("stats")
    for level in range(2, order + 1):
        joined = corpus.groupBy("batch").cogroup(answers.groupBy("batch"))
        counted = common.written(count_order(joined, level, model, level < order), f"ngrams-{level}")
        stats = counted.filter("batch IS NULL").select("bucket", "ids", "lower", "few", "stats")
        by_count = [x or 0 for x in stats.agg(*[F.sum(F.col("stats")[i]) for i in range(MOST_DISCOUNTED + 1)]).first()]
        # A new model each time, as the one before is bound into what was planned with it.
        model = replace(model, levels=[*model.levels, Level.of(by_count)], wide=[*model.wide, wide_of(stats)])
        answers = answers.unionAll(counted.filter("batch IS NOT NULL").drop("stats"))
    return score_batches(corpus, answers, model)


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by words and bigrams; documents whose crc32(doc_id as text) mod 7 is 2 are held out from
    training."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_documents(common.table(spark, sf_dir, "documents"), held, order=ORDER)


QUERIES = {"op6_katz": op6_katz}
ORACLES: dict[str, str] = {}
