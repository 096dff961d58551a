"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

A CGK walk reads a word sequence at a position i that starts at 0; step j outputs word i and moves on by one bit
of that word drawn for step j. Two sequences within a small edit distance fall into step again after each edit,
so their outputs differ in few places: edit distance has become Hamming distance. The LSH samples SAMPLED
outputs of a walk for each table, and item-sized windows that share a table's key with an item are candidates.
The number of tables follows from the recall aimed at. Every candidate is then verified by the exact edit
distance between the item and the text around it.

Every item is embedded twice, from its head and from its middle, so that edits that crowd in one half leave the other.

Windows start only where an item can be near. An item of n words with k edits keeps n - 2 - 3 k of its runs of
three words (the q-gram lemma), so a window with fewer runs that are in some item of its size is passed over.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Edits are at most this share of an item's words.
EDITS_PER_WORD = 5
SEED_WORDS = 3
#: Sampled outputs of a table, the recall aimed at, and the share of outputs that near windows surely share.
SAMPLED, RECALL, AGREEMENT = 2, 0.999, 0.35
#: Walks from each place of an item; the tables are dealt out over them.
WALKS = 6
STARTS_AT_ONCE = 1 << 16
#: Items that are sent to the executors at a time; longer lists take further passes over the documents.
ITEMS_PER_PASS, CHARS_PER_PASS = 20_000, 16 << 20
#: Every byte that is no part of a word becomes a blank.
BLANKED = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits of a whole text."""
    return text.lower().encode("utf-8", "replace").translate(BLANKED).split() if text else []


def allowed(n: int) -> int:
    """Edits allowed for an item of n words."""
    return n // EDITS_PER_WORD if n > EDITS_PER_WORD else 0


def seeds(hashed: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q consecutive words."""
    if len(hashed) < q:
        return np.empty(0, np.uint64)
    out = hashed[: len(hashed) - q + 1].copy()
    for k in range(1, q):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (hashed[k : len(hashed) - q + 1 + k] ^ np.uint64(k))
    return out


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Another 64 random bits for each word."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def walk(hashed: np.ndarray, starts: np.ndarray, stop: np.ndarray, steps: int, salt: int) -> np.ndarray:
    """The CGK outputs of windows: one row for each step, one column for each start; 0 behind a window's stop."""
    out = np.zeros((steps, len(starts)), np.uint64)
    if not len(starts):
        return out
    base = int(starts.min())
    hashed, stop = hashed[base : int(stop.max())], stop - base
    at = starts.astype(np.int64) - base
    bits = mixed(hashed, salt + 1)
    for j in range(steps):
        if j and j % 64 == 0:
            bits = mixed(hashed, salt + 1 + j)
        inside = np.flatnonzero(at < stop)
        where = at[inside]
        out[j, inside] = hashed[where]
        at[inside] += ((bits[where] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return out


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance between the item and any run of the text, and where the first such run ends."""
    row = np.zeros(len(text) + 1, np.int64)
    along = np.arange(len(text) + 1)
    for i, word in enumerate(item):
        fresh = np.empty_like(row)
        fresh[0] = i + 1
        np.minimum(row[:-1] + (text != word), row[1:] + 1, out=fresh[1:])
        # Words left out of the item: a running minimum along the text.
        row = np.minimum.accumulate(fresh - along) + along
    end = int(np.argmin(row))
    return int(row[end]), end


@dataclass
class ItemClass:
    """Items of about the same length: their tables, and the steps that a window of that size is walked.

    seeds are the items' runs of q words, of which every near window holds `least` within `span` words; sieve has
    a bit for each 22-bit prefix of a seed, to pass over nearly all of a text at once. tables are those of one walk
    together: (walk, 1 if from the middle of items, numbers, sampled steps of each). keys holds the keys of all tables in
    order and members their items."""

    steps: int
    longest: int
    q: int
    seeds: np.ndarray
    least: int
    span: int
    sieve: np.ndarray
    tables: list[tuple[int, int, np.ndarray, np.ndarray]] = field(default_factory=list)
    keys: np.ndarray | None = None
    members: np.ndarray | None = None


class ItemIndex:
    """The LSH tables of a list of (item_id, text)."""

    def __init__(self, items: list[tuple[int, str | None]], recall: float = RECALL, seed: int = 3) -> None:
        hasher = common.WordHasher()
        self.items = [(i, h) for i, text in items if len(h := hasher.hashes(words(text)))]
        self.lengths = np.array([len(h) for _, h in self.items], np.int64)
        n_tables = math.ceil(math.log(1 - recall) / math.log(1 - AGREEMENT**SAMPLED))
        rng = np.random.default_rng(seed)
        classes: dict[int, list[int]] = {}
        for at, (_, h) in enumerate(self.items):
            classes.setdefault(len(h).bit_length(), []).append(at)
        self.classes = []
        for bits, members in sorted(classes.items()):
            least = 1 << (bits - 1)
            longest = max(len(self.items[m][1]) for m in members)
            # A walk of 1.5 n steps uses three quarters of the words, so no item of the class has ended by then.
            q = min(SEED_WORDS, least)
            known = np.unique(np.concatenate([seeds(self.items[m][1], q) for m in members]))
            sieve = np.zeros(1 << 22, bool)
            sieve[known >> np.uint64(42)] = True
            kept = min(max(1, len(h) - q + 1 - allowed(len(h)) * q) for m in members for h in [self.items[m][1]])
            group = ItemClass(max(SAMPLED, least + least // 2), longest, q, known, kept, longest + allowed(longest), sieve)
            flat = np.concatenate([self.items[m][1] for m in members])
            begin = np.cumsum([0, *[len(self.items[m][1]) for m in members]])
            # A walk from the middle has half of the words, and no item of the class ends within `least` of its steps but by chance.
            found, owners, count = [], [], 0
            for half, steps in ((0, group.steps), (1, max(SAMPLED, least - least // 4))):
                for w in range(WALKS):
                    numbers = np.arange(count, count + len(range(w + half * WALKS, n_tables, 2 * WALKS)), dtype=np.uint64)
                    count += len(numbers)
                    samples = np.array([sorted(rng.choice(steps, min(SAMPLED, steps), replace=False)) for _ in numbers], np.int64).reshape(len(numbers), -1)
                    outputs = walk(flat, begin[:-1] + half * (np.diff(begin) // 2), begin[1:], steps, 1000 * w)
                    group.tables.append((w, half, numbers, samples))
                    found.append(self.keys(outputs, numbers, samples).ravel())
                    owners.append(np.tile(np.array(members), len(numbers)))
            found = np.concatenate(found)
            order = np.argsort(found, kind="stable")
            group.keys, group.members = found[order], np.concatenate(owners)[order]
            self.classes.append(group)

    @staticmethod
    def keys(outputs: np.ndarray, numbers: np.ndarray, samples: np.ndarray) -> np.ndarray:
        """The key of each table (row) and window (column)."""
        key = np.repeat(mixed(numbers, 5)[:, None], outputs.shape[1], axis=1)
        for j in samples.T:
            key = mixed(key ^ outputs[j], 17) + j[:, None].astype(np.uint64)
        return key

    @staticmethod
    def starts(group: ItemClass, grams: np.ndarray) -> np.ndarray:
        """Where windows of a class can start or have their middle, given the text's runs of q words."""
        at = np.flatnonzero(group.sieve[grams >> np.uint64(42)])
        if not len(at):
            return at
        place = np.minimum(np.searchsorted(group.seeds, grams[at]), len(group.seeds) - 1)
        at = at[group.seeds[place] == grams[at]]
        if len(at) < group.least:
            return at[:0]
        first, last = at[: len(at) - group.least + 1], at[group.least - 1 :]
        dense = last - first <= group.span
        # A window that holds the seeds from first to last starts at or before first and reaches last.
        low, high = np.maximum(0, last[dense] - group.span), first[dense] + 1
        change = np.zeros(len(grams) + 2, np.int64)
        np.add.at(change, low, 1)
        np.add.at(change, np.minimum(high + group.span // 2 + 1, len(change) - 1), -1)
        return np.flatnonzero(np.cumsum(change) > 0)

    def find(self, hashed: np.ndarray) -> dict[int, tuple[int, int]]:
        """For the place of each item near some window of a text: (edits, word behind the window)."""
        found: dict[int, tuple[int, int]] = {}
        grams = {q: seeds(hashed, q) for q in {g.q for g in self.classes}}
        for group in self.classes:
            at = self.starts(group, grams[group.q])
            if not len(at):
                continue
            met = [np.empty(0, np.int64)]
            for low in range(0, len(at), STARTS_AT_ONCE):
                starts = at[low : low + STARTS_AT_ONCE]
                stop = np.minimum(starts + group.longest, len(hashed))
                walks = [walk(hashed, starts, stop, group.steps, 1000 * w) for w in range(WALKS)]
                for w, half, numbers, samples in group.tables:
                    asked = self.keys(walks[w], numbers, samples).ravel()
                    left = np.searchsorted(group.keys, asked)
                    hit = np.flatnonzero(group.keys[np.minimum(left, len(group.keys) - 1)] == asked)
                    if not len(hit):
                        continue
                    left = left[hit]
                    many = np.searchsorted(group.keys, asked[hit], "right") - left
                    place = np.repeat(left - np.cumsum(many) + many, many) + np.arange(many.sum())
                    item = group.members[place]
                    begins = np.maximum(0, np.repeat(starts[hit % len(starts)], many) - half * (self.lengths[item] // 2))
                    met.append(item * (len(hashed) + 1) + begins)
            met_items, met_starts = np.divmod(np.unique(np.concatenate(met)), len(hashed) + 1)
            for m in np.unique(met_items).tolist():
                starts = met_starts[met_items == m].tolist()
                item = self.items[m][1]
                n, k = len(item), allowed(len(item))
                # Windows that overlap are verified at once.
                while starts:
                    upto = starts[0]
                    for s in starts:
                        if s > upto + n:
                            break
                        upto = s
                    # Up to k words may be gained or lost before the middle, and as many behind it.
                    a, b = max(0, starts[0] - 2 * k), min(len(hashed), upto + n + 2 * k)
                    starts = [s for s in starts if s > upto]
                    # Every word that is not edited stands in the text, so fewer common words rule the item out.
                    near = set(hashed[a:b].tolist())
                    if sum(map(near.__contains__, item.tolist())) < n - k:
                        continue
                    edits, end = edit_distance_within(item, hashed[a:b])
                    if edits <= k and (m not in found or edits < found[m][0]):
                        found[m] = (edits, a + end)
        return found


_hasher = common.owned("decontamination", common.WordHasher())


def hits_of(index: ItemIndex, text: str | None) -> dict[int, tuple[int, int]]:
    return index.find(_hasher.hashes(words(text))) if text else {}


def passes(items: DataFrame):
    """Blocks of (item_id, text) of bounded size, one at a time, in the order of item_id, each with whether it is the last."""
    block, chars = [], 0
    rows = items.dropna(subset=["item_id"]).select("item_id", "text").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        if block and (len(block) >= ITEMS_PER_PASS or chars + len(row.text or "") > CHARS_PER_PASS):
            yield block, False
            block, chars = [], 0
        block.append((row.item_id, row.text))
        chars += len(row.text or "")
    yield block, True


FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("edits", T.IntegerType()),
        T.StructField("item_words", T.IntegerType()),
        T.StructField("end_word", T.LongType()),
    ]
)


def find_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """The benchmark items that stand, nearly, in whole texts.

    Returns (doc_id, item_id, edits, item_words, end_word) for each document and item with a run of the text
    within item_words div 5 word edits of the item (none for up to five words), with the least edits and the word
    behind that run. Null and empty texts and items without words match nothing; a null doc_id stays null. Rows that
    repeat a doc_id and text give a hit once. Items with a null id are left out; equal items count once, and of
    several texts under one item_id the one with the least edits counts, then that with the fewest words. The index of
    a block of items is sent to the executors; a benchmark over ITEMS_PER_PASS items or CHARS_PER_PASS characters
    takes more passes over df, one after the other, with the same result. Other columns are not read.
    """

    def over(index: ItemIndex):
        def find(batches):
            common.claim("decontamination")
            for batch in batches:
                rows = [
                    (doc.as_py(), mark.as_py(), index.items[m][0], edits, len(index.items[m][1]), end)
                    for doc, mark, text in zip(*(batch.column(c) for c in range(3)))
                    for m, (edits, end) in sorted(hits_of(index, text.as_py()).items())
                ]
                columns = list(zip(*rows)) or [()] * len(FOUND)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=FOUND.names)

        return df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_key().alias("mark"), "text").mapInArrow(find, FOUND)

    found = None
    for block, last in passes(items):
        hits = over(ItemIndex(block))
        if not last:
            hits = common.written(hits, "hits")
        found = hits if found is None else found.unionByName(hits)
    best = F.min(F.struct("edits", "item_words", "end_word")).alias("best")
    return found.groupBy("doc_id", "mark", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean(text, index: ItemIndex):
    """A column that tells whether a text holds none of an index's items."""

    @F.arrow_udf(T.BooleanType())
    def is_clean(texts: pa.Array) -> pa.Array:
        common.claim("decontamination")
        return pa.array([not hits_of(index, t.as_py()) for t in texts], pa.bool_())

    return is_clean(text)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with the item nearly in the document."""
    return find_items(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's third stage: documents that hold a benchmark item go; columns stay as they are.

    Null and empty texts stay, and so do rows with a null doc_id or repeated rows unless their text holds an item. With an
    empty benchmark all rows stay, and of an empty docs none.
    """
    for block, last in passes(common.table(spark, sf_dir, "benchmark")):
        docs = docs.filter(clean(docs["text"], ItemIndex(block)))
        if not last:
            docs = common.written(docs, "decontaminated")
    return docs


QUERIES = {"op7_decontamination": op7_decontamination}
ORACLES: dict[str, str] = {}
