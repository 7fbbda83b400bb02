"""Text helpers for code inside tasks: bounded slices of long texts and cached word hashes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import xxhash

SLICE_CHARS = 1 << 20
CACHE_WORDS = 1 << 18


def of_worker(key: str, make: Callable):
    """What ``make`` returns, made once per Python worker and ``key``; it outlives the tasks (their code doesn't)."""
    kept = sys.modules.setdefault("lakegate_worker_objects", types.ModuleType("lakegate_worker_objects")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def groups_of(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches in slices of at most ``rows`` rows, so that what a task makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Remembered(dict):
    """Results of ``make`` for short keys met of late; two generations of bounded size."""

    def __init__(self, make: Callable, entries: int = CACHE_WORDS, key_chars: int = 64):
        super().__init__()
        self.make, self.entries, self.key_chars, self.old = make, entries, key_chars, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.key_chars:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def slices(text: str, chars: int = SLICE_CHARS) -> Iterator[str]:
    """The text in slices of about ``chars`` characters, each but the last ending before a blank or line end."""
    at = 0
    while len(text) - at > chars:
        ends = [p for p in (text.find(" ", at + chars), text.find("\n", at + chars)) if p >= 0]
        if not ends:
            break
        yield text[at:min(ends)]
        at = min(ends)
    yield text[at:] if at else text


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
        parts = []
        for part in slices(text or ""):
            words = part.encode("utf-8", "surrogatepass").lower().split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
        return np.concatenate(parts)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle, no words none."""
    if not len(words):
        return words
    n = min(n, len(words))
    count = len(words) - n + 1
    mixed = np.full(count, n, np.uint64)
    for j in range(n):
        mixed = (mixed ^ words[j:j + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)
