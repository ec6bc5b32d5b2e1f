"""A wavelet matrix over token ids, as one compressed file.

Bit plane k holds bit (top - k) of every id, the ids being sorted stably by the planes before; with counts of the
ones before every block of 512 bits, a few look-ups give the id at a place, how often an id comes before a place,
and where it comes for the n-th time.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK = 512
#: Ids that are moved at once, so that they and their places stay in a core's cache.
STEP = 1 << 17


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        """``planes``: packed bits, least significant bit of a byte first."""
        self.n, self.planes, self.zeros = n, planes, zeros
        self._ranks: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        bits = bits or max(1, int(ids.max(initial=0)).bit_length())
        a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        up = np.empty_like(a)
        for k in range(bits - 1, -1, -1):
            bit = ((a >> k) & 1).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            zero, one = 0, len(a) - int(np.count_nonzero(bit))
            zeros.append(one)
            for at in range(0, len(a), STEP):
                part, there = a[at : at + STEP], bit[at : at + STEP]
                low, high = np.flatnonzero(~there), np.flatnonzero(there)  # places are found without branches, so this is far faster than masks
                part.take(low, out=up[zero : zero + len(low)])
                part.take(high, out=up[one : one + len(high)])
                zero, one = zero + len(low), one + len(high)
            a, up = up, a
        return cls(len(ids), planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up: each plane says which places get the next zero and which the next one."""
        bits = len(self.planes)
        out = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for k, (plane, z) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            up, zero, one = np.empty_like(out), 0, z
            for at in range(0, self.n, STEP):
                part, there = up[at : at + STEP], bit[at : at + STEP]
                low, high = np.flatnonzero(~there), np.flatnonzero(there)
                part[low] = out[zero : zero + len(low)]
                part[high] = out[one : one + len(high)] | out.dtype.type(1 << k)
                zero, one = zero + len(low), one + len(high)
            out = up
        return out

    @property
    def ranks(self) -> list[np.ndarray]:
        """Ones before each block, by plane."""
        if self._ranks is None:
            self._ranks = []
            for plane in self.planes:
                padded = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
                padded[: len(plane)] = plane
                self._ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64))]))
        return self._ranks

    def _ones(self, k: int, i: int) -> int:
        """Ones in plane k before place i."""
        block = i // BLOCK
        from_, to = block * BLOCK // 8, i // 8
        count = int(self.ranks[k][block]) + int(np.bitwise_count(self.planes[k][from_:to]).sum())
        return count + (int(self.planes[k][to]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else count

    def access(self, i: int) -> int:
        out = 0
        for k, plane in enumerate(self.planes):
            bit = (int(plane[i >> 3]) >> (i & 7)) & 1
            ones = self._ones(k, i)
            out = out << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        low, top = 0, len(self.planes) - 1
        for k in range(len(self.planes)):
            a, b = self._ones(k, low), self._ones(k, end)
            low, end = (self.zeros[k] + a, self.zeros[k] + b) if token >> (top - k) & 1 else (low - a, end - b)
        return low, end

    def rank(self, token: int, end: int) -> int:
        """How often ``token`` comes before place ``end``."""
        if token >> len(self.planes):
            return 0
        low, high = self._range(token, end)
        return high - low

    def select(self, token: int, nth: int) -> int:
        """The place where ``token`` comes for the nth time, from 0; -1 if it comes less often."""
        if not 0 <= nth < self.rank(token, self.n):
            return -1
        low, high = 0, self.n - 1
        while low < high:
            mid = (low + high) // 2
            if self.rank(token, mid + 1) > nth:
                high = mid
            else:
                low = mid + 1
        return low


def pack(ids: np.ndarray, meta: dict, arrays: dict[str, np.ndarray], level: int = 1) -> bytes:
    """A file: magic, length of the header, header, compressed sections (planes, then rank blocks, then ``arrays``)."""
    m = WaveletMatrix.build(ids)
    sections = [*((p.tobytes(), "u1") for p in m.planes), *((r.astype("<i8").tobytes(), "<i8") for r in m.ranks), *((np.asarray(a).tobytes(), np.asarray(a).dtype.str) for a in arrays.values())]
    squeeze = zstandard.ZstdCompressor(level=level)
    packed = [squeeze.compress(raw) for raw, _ in sections]
    head = json.dumps({"n": m.n, "zeros": m.zeros, "sizes": [len(p) for p in packed], "kinds": [k for _, k in sections], "arrays": list(arrays), "meta": meta}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(packed)


def unpack(data: bytes) -> tuple[WaveletMatrix, dict, dict[str, np.ndarray]]:
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    (size,) = struct.unpack_from("<I", data, 4)
    head = json.loads(data[8 : 8 + size])
    at, parts = 8 + size, []
    for n, kind in zip(head["sizes"], head["kinds"], strict=True):
        parts.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + n]), np.dtype(kind)))
        at += n
    bits = len(head["zeros"])
    m = WaveletMatrix(head["n"], parts[:bits], head["zeros"])
    m._ranks = parts[bits : 2 * bits]
    return m, head["meta"], dict(zip(head["arrays"], parts[2 * bits :], strict=True))
