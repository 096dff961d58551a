"""BPE encoding and decoding with a contiguous rank array.

A word's parts lie in one array of boundaries beside one array of ranks, where entry i holds the merge rank
of parts i and i + 1. Encoding scans the ranks for the smallest, deletes the boundary between those two parts
and refreshes the ranks of the two neighbours, until no pair can merge. A scan is quadratic in the word's
length, so words over LONG parts keep the same array with a heap over it and links in place of deletions.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

NO_MERGE = 1 << 60
#: Parts from which on the heap takes over.
LONG = 96
#: Distinct words that a worker keeps, at most twice, and the longest word kept.
CACHED_WORDS, CACHED_CHARS = 100_000, 64
#: White space as Unicode defines it; Python's \s also takes \x1c-\x1f.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def vocabulary_path(name: str) -> str:
    """A tokenizer file; FIELDLOOM_TOKENIZERS names another folder than the installed package's."""
    folder = os.environ.get("FIELDLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself if printable Latin-1, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = {}, 256
    for b in range(256):
        if b in shown:
            symbols[b] = chr(b)
        else:
            symbols[b], spare = chr(spare), spare + 1
    return [symbols[b] for b in range(256)]


class RankArrayBPE:
    """The merges of a tokenizer file: pairs of ids to (rank, merged id)."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.added.items()}
        #: What every special string begins with, so that most texts need not be searched for them.
        self.added_start = os.path.commonprefix(list(self.added))
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def encode_bytes(self, word: bytes) -> list[int]:
        """The ids of one word."""
        if not word:
            return []
        parts = [self.inner[b] for b in word]
        parts[-1] = self.last[word[-1]]
        return self._short(parts) if len(parts) <= LONG else self._long(parts)

    def _short(self, parts: list[int]) -> list[int]:
        find, none = self.merges.get, (NO_MERGE, 0)
        ranks = [find(pair, none)[0] for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            i = ranks.index(least)
            parts[i] = self.merges[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find((parts[i - 1], parts[i]), none)[0]
            if i < len(ranks):
                ranks[i] = find((parts[i], parts[i + 1]), none)[0]
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        find, n = self.merges.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(hit[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (hit := find((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of the two has merged since
            parts[i], parts[j] = self.merges[left, right][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if hit := find((parts[i], parts[k])):
                    heapq.heappush(heap, (hit[0], i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (hit := find((parts[h], parts[i]))):
                heapq.heappush(heap, (hit[0], h, parts[h], parts[i]))
        return [p for p in parts if p >= 0]


class WordTokenizer:
    """Lower-cased words with an end-of-word mark: NFC, white space dropped, then the rank array."""

    WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

    def __init__(self, path: str) -> None:
        self.bpe = RankArrayBPE(path)
        self.cache = common.owned("bpe", common.TwoGenerationCache(CACHED_WORDS))
        self.token_of = {str(i): t for i, t in self.bpe.tokens.items()}

    def _word(self, word: str) -> str:
        return " ".join(map(str, self.bpe.encode_bytes(word.encode("utf-8", "replace"))))

    def pieces(self, text: str) -> list[str]:
        """The ids of each word and of each special string, decimal and joined by a space."""
        out = []
        # Special strings are found in the text as it stands, before anything is normalised.
        for at, part in enumerate(self.bpe.added_pattern.split(text) if self.bpe.added and self.bpe.added_start in text else (text,)):
            if at % 2:
                out.append(str(self.bpe.added[part]))
                continue
            if not part.isascii():
                # Each character is lowered by itself, so a final capital sigma is no exception.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            find, make = self.cache.find, self._word
            for word in self.WORDS.findall(part.lower()):
                out.append(find(word, make) if len(word) <= CACHED_CHARS else make(word))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for piece in self.pieces(text) for i in piece.split()]

    def decode(self, ids: list[int] | list[str]) -> str:
        """The tokens of ids, numbers or decimal, joined by spaces, as a tokenizer without a decoder gives them."""
        return " ".join([self.token_of[i] for i in map(str, ids)])


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and worker process."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.StringType()),
        T.StructField("decoded", T.StringType()),
    ]
)

def encode_documents(df: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """Encode df's (doc_id, text) and decode the ids again, one row per row, without a shuffle.

    Returns doc_id, n_tokens, ids (decimal, joined by a space) and decoded, or with ``digests`` the SHA-256 of
    the last two in their place, so that long results need not leave the worker. A null or empty text has no
    ids and an empty decoding. A null doc_id stays null; repeated rows each give a row. Other columns of df
    are not read.
    """
    path = path or vocabulary_path("word_bpe_49k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("bpe")
        tokenizer = word_tokenizer(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for whole in batches:
            for batch in common.slices(whole):
                counts, ids, decoded = [], [], []
                for text in batch.column("text"):
                    i = " ".join(tokenizer.pieces(text.as_py() or ""))
                    coded = i.split(" ") if i else []
                    counts.append(len(coded))
                    d = tokenizer.decode(coded)
                    ids.append(sha(i) if digests else i)
                    decoded.append(sha(d) if digests else d)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    encoded = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, ENCODED)
    return encoded.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"}) if digests else encoded


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; doc_id, n_tokens and the two digests."""
    return encode_documents(common.table(spark, sf_dir, "documents"), digests=True)


QUERIES = {"op9_bpe": op9_bpe}
ORACLES: dict[str, str] = {}
