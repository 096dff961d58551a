"""Substring dedup by sliding sentence spans.

A text is cut into sentences, and sentences over LEAST_WORDS words into pieces of at most WORDS_PER_PIECE, at places
that depend on the words around them alone. Every run of SENTENCES consecutive ones, lengthened where it has under
RUN_WORDS words, is hashed, and equal hashes are joined globally. Of each hash the occurrence with the smallest
(doc_id, position) is the first; all sentences that any other occurrence covers are removed from their texts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SENTENCES, WORDS_PER_PIECE, LEAST_WORDS = 3, 16, 8
#: Words of a run at least; shorter ones are lengthened. A passage of over 50 words holds such a run behind the partial pieces
#: at its ends, while phrases that texts share by chance are shorter.
RUN_WORDS = 24

BREAK = re.compile(r"[.!?]+(?:[ \t\n\r\f\v]+|\Z)|\n[ \t\n\r\f\v]*")
#: The same words as str.split() gives, whatever white space parts them.
WORD = re.compile(r"\S+")
#: Rows from which on a span counts as hot.
HOT_ROWS = 100_000
#: A piece ends where a word pair's hash is the least among so many on both sides; so pieces have REACH + 1 words or more.
REACH = 2

_hasher = common.owned("substring_dedup", common.WordHasher())


def least_places(pairs: np.ndarray) -> list[int]:
    """Places whose value is below the REACH values before and not above the REACH values behind."""
    n = len(pairs) - 2 * REACH
    if n <= 0:
        return []
    here, least = pairs[REACH : REACH + n], np.ones(n, bool)
    for k in range(1, REACH + 1):
        least &= (here < pairs[REACH - k : REACH - k + n]) & (here <= pairs[REACH + k : REACH + k + n])
    return (np.flatnonzero(least) + REACH).tolist()


def inner(places: list[int], a: int, b: int) -> list[int]:
    """Those of the sorted places that leave more than REACH words on either side of words a to b."""
    return places[bisect_left(places, a + REACH + 1) : bisect_right(places, b - REACH - 1)]


def piece_cuts(hashed: np.ndarray, bounds: list[tuple[int, int]]) -> list[list[int]]:
    """For each sentence (first word, word behind its last) the words at which its pieces begin after the first.

    Whether a word begins a piece depends on the few words around it, so a passage is cut alike wherever it stands."""
    pairs = np.zeros(len(hashed), np.uint64)
    pairs[1:] = (hashed[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ hashed[1:]
    pairs *= np.uint64(0xBF58476D1CE4E5B9)
    pairs ^= pairs >> np.uint64(31)
    first, second, out = least_places(pairs), None, []
    for a, b in bounds:
        if b - a <= LEAST_WORDS:
            out.append([])
            continue
        cuts = inner(first, a, b)
        edges = [a, *cuts, b]
        if max(y - x for x, y in zip(edges, edges[1:])) > WORDS_PER_PIECE:
            if second is None:
                again = pairs * np.uint64(0x94D049BB133111EB)
                second = least_places(again ^ (again >> np.uint64(29)))
            cuts = sorted(cuts + [c for x, y in zip(edges, edges[1:]) if y - x > WORDS_PER_PIECE for c in inner(second, x, y)])
            edges = [a, *cuts, b]
            for x, y in zip(edges, edges[1:]):
                if y - x > WORDS_PER_PIECE:
                    # One word or two in turn, over and over: evenly, from the least pair on.
                    low = x + REACH + 1
                    low += int(np.argmin(pairs[low : min(x + WORDS_PER_PIECE, y - REACH - 1) + 1]))
                    cuts += range(low, y - REACH, WORDS_PER_PIECE)
            cuts.sort()
        out.append(cuts)
    return out


def lowered(text: str) -> str:
    """The text in lower case, of the same length: a character whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def hashes_of(words: list[str]) -> np.ndarray:
    return _hasher.hashes(" ".join(words).encode("utf-8", "replace").split(b" ")) if words else np.empty(0, np.uint64)


def sentences(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised words, number of words) of a whole text's sentences and pieces.

    Each reaches to the next one's start, so the slices of the kept ones join to the text that is left."""
    if not text:
        return []
    found, words, start, low = [], [], 0, lowered(text)
    for m in [*BREAK.finditer(low), None]:
        stop, end = (m.start(), m.end()) if m else (len(text), len(text))
        at = len(words)
        words += low[start:stop].split()
        if len(words) > at:
            found.append((start, stop, end, at, len(words)))
        elif found:
            found[-1] = (*found[-1][:2], end, *found[-1][3:])
        start = end
    out, bounds = [], [(a, b) for *_, a, b in found]
    for (start, stop, end, a, b), cuts in zip(found, piece_cuts(hashes_of(words), bounds)):
        if not cuts:
            out.append((start, end, " ".join(words[a:b]), b - a))
            continue
        places = [w.start() for w in WORD.finditer(text, start, stop)]
        begins = [start, *(places[c - a] for c in cuts), end]
        for x, y, i, j in zip(begins, begins[1:], [a, *cuts], [*cuts, b]):
            out.append((x, y, " ".join(words[i:j]), j - i))
    return out


def unit_edges(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a whole text's words, and the words at which its sentences and pieces begin, with the end: the same
    units as sentences() gives."""
    parts = [part.split() for part in BREAK.split(lowered(text))] if text else []
    hashed, bounds, at = hashes_of([w for part in parts for w in part]), [], 0
    for part in parts:
        if part:
            bounds.append((at, at + len(part)))
            at += len(part)
    edges = [x for (a, _), cuts in zip(bounds, piece_cuts(hashed, bounds)) for x in (a, *cuts)]
    return hashed, np.array([*edges, at] if edges else [], np.int64)


def run_ends(edges: np.ndarray) -> np.ndarray:
    """Of every run the unit behind its last: SENTENCES units, or more until they have RUN_WORDS words. Begins that leave
    too few have none."""
    n = len(edges) - 1
    if n < SENTENCES:
        return np.empty(0, np.int64)
    ends = np.maximum(np.searchsorted(edges, edges[:-1] + RUN_WORDS), np.arange(n) + SENTENCES)
    return ends[: np.searchsorted(ends, n, "right")]


#: An odd number and its inverse: the powers by which words count in a run's hash, and by which its place is taken out.
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of both, kept for texts of ordinary length."""
    if n <= len(_powers[0]):
        return [p[:n] for p in _powers]
    made = []
    for base in (_STEP, _BACK):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 1 << 18:
        _powers[:] = made
    return made


def span_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of every run of a whole text: from sums of its words' hashes, each times a power for its place."""
    hashed, edges = unit_edges(text)
    ends = run_ends(edges)
    if not len(ends):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = powers(len(hashed) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * up[:-1], dtype=np.uint64)])
    begin, end = edges[: len(ends)], edges[ends]
    out = (sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)
    for shift in (32, 29):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.arange(len(ends)), out ^ (out >> np.uint64(32))


def documents_of(df: DataFrame) -> DataFrame:
    """(doc_id, mark, text): a document is known by its doc_id and its text's hash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_key().alias("mark"), "text")


def spans(docs: DataFrame) -> DataFrame:
    """(span, doc_id, mark, at) of every run in every text."""

    def cut(batches):
        common.claim("substring_dedup")
        for whole in batches:
            for batch in common.slices(whole, 512):
                span, owner, at = [], [], []
                for i, t in enumerate(batch.column("text")):
                    places, found = span_hashes(t.as_py())
                    at.append(places)
                    span.append(found)
                    owner.append(np.full(len(found), i))
                take = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(span).view(np.int64)), batch.column("doc_id").take(take), batch.column("mark").take(take), pa.array(np.concatenate(at).astype(np.int32))],
                    names=["span", "doc_id", "mark", "at"],
                )

    return docs.mapInArrow(cut, "span long, doc_id long, mark long, at int")


def met(rows: DataFrame, sides: DataFrame) -> DataFrame:
    """Join rows by span with sides (span, n, ...), where n is the number of the span's rows.

    Spans of very many rows, of which there can only be few, are sent to all; the others meet by a shuffle at any size."""
    hot, cold = sides.filter(F.col("n") > HOT_ROWS), sides.filter(F.col("n") <= HOT_ROWS)
    met_cold = rows.join(cold.hint("merge"), "span")
    return met_cold if hot.isEmpty() else met_cold.unionAll(rows.join(common.small_side(hot), "span"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, at: array of positions, sources: array of doc_ids) of every document with a non-first span.

    Spans meet as counts and minima, which are summed before they are shuffled, so that a span in every document
    gathers nowhere. Both arrays are bounded by the document's own sentences."""
    every = common.written(spans(docs), "spans")
    counts = common.written(every.groupBy("span").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    again = common.written(met(every, counts), "repeated")
    place = F.struct("doc_id", "mark", "at")
    firsts = common.written(again.groupBy("span").agg(F.min(place).alias("first"), F.count("*").alias("n")), "firsts")
    # A document repeated row by row is one document: its own first place is not a repeat.
    later = met(again.drop("n"), firsts).filter(~F.col("first").eqNullSafe(place))
    return later.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("at")).alias("at"), F.sort_array(F.collect_set("first.doc_id")).alias("sources"))


def covered(at: list[int], units: list[tuple[int, int, str, int]]) -> set[int]:
    if not at:
        return set()
    ends = run_ends(np.cumsum([0, *(u[3] for u in units)]))
    return {k for p in at for k in range(p, int(ends[p]))}


CLEANED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_sentences", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("sources", T.ArrayType(T.LongType())),
        T.StructField("text", T.StringType()),
    ]
)


def dedup_substrings(df: DataFrame, changed_only: bool = False) -> DataFrame:
    """Remove repeated runs of sentences from the texts of (doc_id, text).

    Returns doc_id, n_sentences, n_removed, sources (the doc_ids that keep the removed passages) and the text that
    is left, one row per row, or with ``changed_only`` only the rows that lose something. Null texts stay null
    and texts with fewer than three sentences as they are. Rows that repeat a doc_id and text are one document: each
    gets that document's result. A null doc_id counts as the smallest. An empty df gives an empty result. Other
    columns are not read.
    """
    docs = documents_of(df)
    found = common.written(repeats(docs), "repeats").withColumnsRenamed({"doc_id": "d", "mark": "m"})
    # Only the texts that lose something move.
    ids = common.small_side(found.select("d", "m"))
    same = docs["doc_id"].eqNullSafe(F.col("d")) & (docs["mark"] == F.col("m"))
    columns = ["doc_id", "text", "at", "sources"]
    joined = docs.join(ids, same, "left_semi").join(found, same).select(columns)
    if not changed_only:
        rest = docs.join(ids, same, "left_anti")
        joined = joined.unionByName(rest.select("doc_id", "text", F.lit(None).cast("array<int>").alias("at"), F.lit(None).cast("array<long>").alias("sources")))

    def rebuilt(batches):
        common.claim("substring_dedup")
        for whole in batches:
            for batch in common.slices(whole, 512):
                total, removed, left = [], [], []
                for t, at in zip(batch.column("text"), batch.column("at")):
                    t = t.as_py()
                    units = sentences(t)
                    out = covered(at.as_py() or [], units)
                    total.append(len(units))
                    removed.append(len(out))
                    left.append("".join([t[a:b] for i, (a, b, *_) in enumerate(units) if i not in out]) if out else t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), batch.column("sources"), pa.array(left, pa.string())], names=CLEANED.names
                )

    return joined.mapInArrow(rebuilt, CLEANED)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that loses a repeated passage: what it loses, and which documents keep it."""
    changed = dedup_substrings(common.table(spark, sf_dir, "documents"), changed_only=True)
    return changed.select(
        "doc_id", "n_sentences", "n_removed", F.array_min("sources").alias("first_doc_id"), F.size("sources").cast("long").alias("n_sources"), F.sha2("text", 256).alias("text_sha256")
    )


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLES: dict[str, str] = {}
