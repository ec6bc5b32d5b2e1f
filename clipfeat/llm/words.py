"""Words, shingles and hashes of a batch of texts, as flat NumPy arrays."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import xxhash

#: The words of a text are the runs of characters other than these six: bytes.split() cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_lists(texts) -> Iterator[list[bytes]]:
    """The words of each text, A-Z in lower case, one text at a time; a null text has none."""
    return ((t or "").encode().lower().split() for t in texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
        return h ^ (h >> np.uint64(32))


def hashes(items) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items), dtype=np.uint64, count=len(items))


def chain(h: np.ndarray, gaps: tuple[int, ...]) -> np.ndarray:
    """At each place a hash of the items at the given distances from it; shorter by the largest distance."""
    n = max(0, len(h) - gaps[-1])
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for g in gaps[1:]:
            out = mix(out * _MIX + h[g : g + n])
    return out


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of the word shingles in their order, repeats included; a shorter text is one shingle, an empty one has none."""
    h = hashes(words)
    return chain(h, tuple(range(min(size, len(words))))) if len(words) else h


class WordTable:
    """Numbers words as they come and keeps, for each, hashes of some forms of it; so a word that comes often is hashed once.

    It starts afresh when it holds ``limit`` words, so its memory is bounded whatever the texts. ``of`` makes the numbers of
    many forms at once."""

    def __init__(self, *forms, limit: int = 400_000, of=hashes):
        self.forms, self.limit, self.of = forms, limit, of
        self._clear()

    def _clear(self) -> None:
        self.index, self.size = defaultdict(count().__next__), 0
        self.columns = [np.zeros(1024, np.uint64) for _ in self.forms]

    def look_up(self, words: list) -> list[np.ndarray]:
        """For each form the hashes of all words, in order."""
        if self.size > self.limit:
            self._clear()
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if new := len(self.index) - self.size:
            fresh = list(islice(reversed(self.index), new))[::-1]
            for k, form in enumerate(self.forms):
                if len(self.index) > len(self.columns[k]):
                    self.columns[k] = np.concatenate([self.columns[k], np.zeros(max(new, len(self.columns[k])), np.uint64)])
                self.columns[k][self.size : len(self.index)] = self.of([form(w) for w in fresh])
            self.size = len(self.index)
        return [c[ids] for c in self.columns]
