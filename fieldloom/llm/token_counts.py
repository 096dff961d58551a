"""Token counts by compiled finite-state transducers.

Two deterministic machines give a byte-level BPE tokenizer's count without building its tokens:

* The splitter reads character classes and annotates each transition with the word boundaries it emits
  (before this character, before the one ahead of it). It has twelve states, so a chunk of text is a map from
  the state it is entered in to the state it is left in. All chunks run in lock-step over their columns, their
  maps compose by a parallel prefix scan, and a second run from the states now known emits the boundaries.
* The counter reads a word's bytes and annotates each transition with the change in the number of tokens. Its
  state is what the next byte can depend on: for every suffix of the word that some token starts with, the
  last token before that suffix and its count relative to the whole. These are finitely many; states are
  compiled when first met and flushed when MAX_STATES are held.

The counter rests on a property of BPE by merge ranks: a sequence of tokens is an encoding exactly if every
two neighbours are the encoding of their own joined bytes. So among the suffixes that are tokens exactly one
fits behind what comes before it.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .bpe import SPACE, RankArrayBPE, byte_symbols, vocabulary_path

#: Characters of a chunk, and of a section of the stream that is held at a time.
CHUNK, SECTION = 256, 1 << 21
#: Compiled states and remembered token pairs before a flush.
MAX_STATES, MAX_PAIRS = 200_000, 300_000
CACHED_WORDS, CACHED_CHARS = 200_000, 64

# Character classes; the letters of 's 't 'm 'd, 're 've and 'll have their own.
LETTER, ONE, R, V, EL, E, NUMBER, BLANK, SPACES, QUOTE, OTHER, END = range(12)
LETTERS = (LETTER, ONE, R, V, EL, E)
# Splitter states: what the open word is.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
#: A transition's output.
HERE, BACK = 1, 2


@functools.cache
def character_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (f"[{SPACE}]", SPACES)):
        found = "".join(regex.findall(f"{pattern}+", every))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    for text, kind in (("stmd", ONE), ("r", R), ("v", V), ("l", EL), ("e", E), (" ", BLANK), ("'", QUOTE)):
        for c in text:
            table[ord(c)] = kind
    return table


@functools.cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output, at state * 12 + class."""
    begins = {NUMBER: IN_NUMBERS, BLANK: ONE_BLANK, SPACES: ONE_SPACE, QUOTE: AT_QUOTE, OTHER: IN_OTHERS} | dict.fromkeys(LETTERS, IN_LETTERS)
    runs = {IN_LETTERS: LETTERS, IN_NUMBERS: (NUMBER,), IN_OTHERS: (OTHER, QUOTE)}
    joined = {NUMBER: IN_NUMBERS, QUOTE: IN_OTHERS, OTHER: IN_OTHERS} | dict.fromkeys(LETTERS, IN_LETTERS)
    pending = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: EL}

    def step(state: int, kind: int) -> tuple[int, int]:
        if kind == END:
            return DONE, HERE | (BACK if state in pending else 0)
        if state == DONE:
            return begins[kind], HERE
        if state in runs:
            return (state, 0) if kind in runs[state] else (begins[kind], HERE)
        if state == AT_QUOTE:
            if kind == ONE:
                return DONE, 0
            if kind in (R, V, EL):
                return {R: QUOTE_R, V: QUOTE_V, EL: QUOTE_L}[kind], 0
            return (IN_OTHERS, 0) if kind in (OTHER, QUOTE) else (begins[kind], HERE)
        if state in pending:
            if kind == pending[state]:
                return DONE, 0
            after, out = step(IN_LETTERS, kind)
            return after, out | BACK
        # White space: one or more; a run gives its last character to what follows.
        if kind in (BLANK, SPACES):
            return (RUN_BLANK if kind == BLANK else RUN_SPACE), 0
        if state == ONE_SPACE:
            return begins[kind], HERE
        if state == RUN_SPACE:
            return begins[kind], HERE | BACK
        return joined[kind], (BACK if state == RUN_BLANK else 0)

    pairs = [step(s, k) for s in range(12) for k in range(12)]
    return np.array([p[0] for p in pairs], np.uint8), np.array([p[1] for p in pairs], np.uint8)


def compose_prefixes(maps: np.ndarray) -> np.ndarray:
    """Row i becomes the map of chunks 0..i in turn; log2(rows) rounds of pairwise composition."""
    out, reach = maps.copy(), 1
    while reach < len(out):
        # First what ended `reach` rows before, then this row's span.
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach], axis=1)
        reach *= 2
    return out


def boundaries(kinds: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Outputs of a stream of classes entered in a state, and the state it is left in."""
    after, out = splitter()
    rows = -(-len(kinds) // CHUNK)
    padded = np.full(rows * CHUNK, END, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    maps = np.repeat(np.arange(12, dtype=np.uint8)[None], rows, axis=0)
    for column in columns:
        maps = after[maps * np.uint8(12) + column[:, None]]
    entered = np.empty(rows, np.uint8)
    entered[0] = state
    entered[1:] = compose_prefixes(maps)[:-1, state]
    emitted = np.empty_like(columns)
    now = entered
    for j, column in enumerate(columns):
        at = now * np.uint8(12) + column
        emitted[j], now = out[at], after[at]
    flat = np.ascontiguousarray(emitted.T).reshape(-1)[: len(kinds)]
    last = int(entered[-1])
    for kind in kinds[(rows - 1) * CHUNK :]:
        last = int(after[last * 12 + int(kind)])
    return flat, last


class CountTransducer:
    """The counter: compiled lazily from a byte-level BPE vocabulary."""

    def __init__(self, path: str) -> None:
        self.bpe = RankArrayBPE(path)
        to_byte = {s: b for b, s in enumerate(byte_symbols())}
        added = set(self.bpe.added.values())
        self.bytes_of = {i: bytes([to_byte[c] for c in t]) for i, t in self.bpe.tokens.items() if i not in added}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.starts = {b[:n] for b in self.id_of for n in range(1, len(b))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.cache = common.TwoGenerationCache(CACHED_WORDS)
        self._flush()
        common.owned("token_counts", self)

    def clear(self) -> None:
        self.fits.clear()
        self.cache.clear()
        self._flush()

    def _flush(self) -> None:
        self.keys: list[tuple] = [(b"", ((0, -1, 0),))]
        self.numbers = {self.keys[0]: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _fit(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= MAX_PAIRS:
                self.fits.clear()
            known = self.bpe.encode_bytes(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.fits[left, right] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        suffix, entries = self.keys[state]
        grown = suffix + bytes([byte])
        token, change = -1, 0
        for length, left, relative in entries:
            found = self.id_of.get(grown[len(grown) - length - 1 :])
            if found is not None and self._fit(left, found):
                token, change = found, relative + 1
                break
        kept = [(n + 1, left, rel - change) for n, left, rel in entries if grown[len(grown) - n - 1 :] in self.starts]
        longest = max([n for n, _, _ in kept], default=0)
        key = (grown[len(grown) - longest :] if longest else b"", (*kept, (0, token, 0)))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
        self.moves[state][byte] = number, change
        return number, change

    def count(self, word: bytes) -> int:
        """Tokens of one word."""
        if len(self.keys) >= MAX_STATES:
            self._flush()
        state = total = 0
        moves = self.moves
        for byte in word:
            move = moves[state].get(byte)
            if move is None:
                if len(self.keys) >= 2 * MAX_STATES:
                    # In the midst of a very long word: start the table anew from the present state.
                    key = self.keys[state]
                    self._flush()
                    moves = self.moves
                    state = self.numbers.setdefault(key, len(self.keys))
                    if state == len(self.keys):
                        self.keys.append(key)
                        moves.append({})
                move = self._compile(state, byte)
            state, change = move
            total += change
        return total

    def count_word(self, word: str) -> int:
        return self.count(word.encode("utf-8", "replace"))

    def count_texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; special strings count as the one token they are to the library."""
        segments, owners, special = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            parts = self.bpe.added_pattern.split(text) if text and self.bpe.added and self.bpe.added_start in text else [text or ""]
            special[i] = len(parts) // 2
            segments += parts[::2]
            owners += [i] * (len(parts) // 2 + 1)
        totals = np.array(special, np.int64)
        at = 0
        while at < len(segments):
            end, chars = at, 0
            while end < len(segments) and (end == at or chars + len(segments[end]) < SECTION):
                chars += len(segments[end]) + 1
                end += 1
            np.add.at(totals, owners[at:end], self._count_segments(segments[at:end]))
            at = end
        return totals.tolist()

    def _count_segments(self, segments: list[str]) -> np.ndarray:
        stream = "\n".join(segments) + "\n"
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        table, state = character_classes(), DONE
        starts = np.zeros(len(stream) + 1, bool)
        for low in range(0, len(stream), SECTION):
            part = stream[low : low + SECTION]
            kinds = table[np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)]
            kinds[ends[(ends >= low) & (ends < low + len(part))] - low] = END
            flat, state = boundaries(kinds, state)
            starts[low : low + len(part)] |= (flat & HERE) > 0
            # A boundary one back; of the first character it may be in the section before.
            starts[np.flatnonzero(flat & BACK) + (low - 1)] = True
        # Each end stands as a word of its own, which counts nothing.
        at = np.flatnonzero(starts)
        find, make = self.cache.find, self.count_word
        places = at.tolist()
        counts = np.fromiter(
            (find(w, make) if len(w := stream[a:b]) <= CACHED_CHARS else make(w) for a, b in zip(places, [*places[1:], len(stream)])),
            np.int64,
            len(places),
        )
        last = np.searchsorted(at, ends)
        counts[last] = 0
        sums = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(sums[last + 1], prepend=0)


_loaded: dict[str, CountTransducer] = {}


def transducer(path: str) -> CountTransducer:
    """One compiled transducer for each file and worker process."""
    if path not in _loaded:
        _loaded[path] = CountTransducer(path)
    return _loaded[path]


COUNTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
)


def count_tokens(df: DataFrame, limit: int = 512, path: str | None = None) -> DataFrame:
    """Tokens of each (doc_id, text), one row per row, without a shuffle.

    Returns doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit). A null or empty text has no
    bytes and no tokens; a null doc_id stays null; repeated rows each give a row. Other columns are not read.
    """
    path = path or vocabulary_path("byte_bpe_50k.json")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("token_counts")
        machine = transducer(path)
        for whole in batches:
            for batch in common.slices(whole):
                text = batch.column("text")
                n_tokens = pa.array(machine.count_texts(text.to_pylist()), pa.int64())
                n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, n_tokens, pc.greater(n_tokens, limit)], names=COUNTED.names)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, COUNTED)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens, and whether it has over 512 tokens."""
    return count_tokens(common.table(spark, sf_dir, "documents"))


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
