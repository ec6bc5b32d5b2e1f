"""Fuzzy hashing of fingerprint segments with the extended binary Golay code.

A word of 24 bits has one nearest codeword if it lies within three bits of the code, else six of them at four bits.
Two words that differ in at most one bit share a nearest codeword: one of them has odd weight and so a single nearest
codeword, within three bits; the other lies within four bits of that, and has no nearer one. So a word's nearest
codewords, by their twelve message bits, are keys that survive one error.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: The generator polynomial of the cyclic code of length 23.
GENERATOR = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits by message; nearest error patterns by syndrome (-1 where there are fewer than six)."""
    checks = np.zeros(4096, np.int64)
    for m in range(4096):
        rest = m << 11
        for k in range(22, 10, -1):
            if rest >> k & 1:
                rest ^= GENERATOR << (k - 11)
        word = m << 11 | rest
        checks[m] = rest << 1 | word.bit_count() & 1
    leaders = np.full((4096, 6), -1, np.int64)
    found = np.zeros(4096, np.int64)
    weight = np.full(4096, 99)
    for w in range(5):
        for places in combinations(range(24), w):
            e = sum(1 << p for p in places)
            s = int(checks[e >> 12] ^ (e & 0xFFF))
            if weight[s] >= w:
                weight[s] = w
                leaders[s, found[s]] = e
                found[s] += 1
    return checks, leaders


def nearest(words: np.ndarray) -> np.ndarray:
    """Message bits of the codewords nearest to each 24-bit word: n rows of six, -1 where there are fewer."""
    checks, leaders = _tables()
    e = leaders[checks[words >> 12] ^ (words & 0xFFF)]
    return np.where(e < 0, -1, (words[:, None] ^ e) >> 12)


def segments(fingerprints: np.ndarray) -> list[np.ndarray]:
    f = fingerprints.astype(np.int64).view(np.uint64)
    return [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def keys_within_three(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys): keys of each fingerprint, such that any two within three bits share one.

    Of three segments with three errors in all, either one is exact and another has one error at most, or each has one."""
    raw = segments(fingerprints)
    near = [nearest(s) for s in raw]
    places, keys = [], []
    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                at, k = np.nonzero(near[j] >= 0)
                places.append(at)
                keys.append(kind << 36 | raw[i][at] << 12 | near[j][at, k])
                kind += 1
    a, b, c = near
    all_three = (a >= 0)[:, :, None, None] & (b >= 0)[:, None, :, None] & (c >= 0)[:, None, None, :]
    at, x, y, z = np.nonzero(all_three)
    places.append(at)
    keys.append(kind << 36 | a[at, x] << 24 | b[at, y] << 12 | c[at, z])
    return np.concatenate(places), np.concatenate(keys)


def keys_of_pairs(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys): two fingerprints share a key if two of their three segments have a nearest codeword in common."""
    near = [nearest(s) for s in segments(fingerprints)]
    places, keys = [], []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        at, x, y = np.nonzero((near[i] >= 0)[:, :, None] & (near[j] >= 0)[:, None, :])
        places.append(at)
        keys.append(kind << 24 | near[i][at, x] << 12 | near[j][at, y])
    return np.concatenate(places), np.concatenate(keys)
