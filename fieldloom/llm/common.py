"""What the corpus operators share: hashing of words and bounded caches, one operator's at a time in a worker."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fieldloom.session import small_side, table, written  # noqa: F401


def text_key(text: str = "text"):
    """A text's identity within one doc_id, null-safe."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def slices(batch, rows: int = 256):
    """An Arrow batch in short pieces, so that what is made of long texts is never held for the whole batch."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


_caches: dict[str, list] = {}
_owner: str | None = None


def claim(owner: str) -> None:
    """Empty the caches of other operators than this one, which a task of its begins with: workers live on from stage
    to stage, and their memory is bounded by the largest operator's, not by the sum."""
    global _owner
    if _owner != owner:
        _owner = owner
        for name, caches in _caches.items():
            if name != owner:
                for cache in caches:
                    cache.clear()


def owned(owner: str, cache):
    """Register a cache with its operator."""
    _caches.setdefault(owner, []).append(cache)
    return cache


class TwoGenerationCache:
    """A dictionary of bounded size: what was used since the last turn survives the next one."""

    __slots__ = ("limit", "old", "young")

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def find(self, key, make):
        hit = self.young.get(key)
        if hit is None:
            hit = self.old.get(key)
            if hit is None:
                hit = make(key)
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[key] = hit
        return hit


class WordHasher:
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __init__(self, limit: int = 200_000, seed: int = 0) -> None:
        self.limit, self.seed, self.known = limit, seed, {}

    def clear(self) -> None:
        self.known = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > self.limit:
            known.clear()
            new = set(words)
        make, seed = xxhash.xxh3_64_intdigest, self.seed
        for word in new:
            known[word] = make(word, seed)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def ascii_lower_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a whole text with A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower().split() if text else []
