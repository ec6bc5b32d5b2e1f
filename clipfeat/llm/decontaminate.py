"""Benchmark decontamination by SimHash over item-sized windows.

A window of an item's number of words that is similar to it shares word shingles with it, of a weight that follows from the
similarity. So only texts and items that share as much are looked at, and of a text only windows around those shingles; that loses
nothing. Each such window gets a SimHash by
running sums over the shingles' bits. A multi-index over blocks of the items' fingerprints finds every one of those items
within the radius: with eight blocks of eight bits, two fingerprints that differ in at most 23 bits have a block in which
they differ in at most two. The exact similarity of the weighted shingles (a shingle's weight is how often it comes) then
decides.

Cases: a null or empty text has no window; an item without words matches nothing; an item of fewer than five words is one
shingle of all its words; a text shorter than an item is one window; repeated rows and items are all reported; an empty
table gives no rows; extra columns are ignored, or carried along by the filter.
"""

from __future__ import annotations

import itertools
import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import frame_of, map_frames, staged, table
from .words import WordTable, chain, hashes

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
_BLOCK_BITS = 8


_WORDS = re.compile(r"\w+")


def plain_words(texts) -> list[list[str]]:
    """The words of each text in lower case, without marks: a passage stays the same if its case or the marks around it change."""
    return [_WORDS.findall((t or "").lower()) for t in texts]


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller weights over the sum of the larger ones, of the shingles of either side."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    low = np.minimum(ca[ia], cb[ib]).sum()
    return float(low / max(1, len(a) + len(b) - low))


class BlockIndex:
    """Fingerprints by blocks: for each value of a block, the items that differ from it in two bits or fewer."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = np.arange(256, dtype=np.uint8)
        blocks = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
        self.near = [np.bitwise_count(values[:, None] ^ blocks[None, :, k]) <= RADIUS // _BLOCK_BITS for k in range(8)]

    def search(self, windows: np.ndarray, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, differing bits) of all pairs within the radius; only items ``among`` these places, if they are given."""
        among = np.arange(len(self.prints)) if among is None else among
        near, found = [n[:, among] for n in self.near], []
        for at in range(0, len(windows), step := max(1, 2_000_000 // max(1, len(among)))):
            part = windows[at : at + step]
            blocks = part.astype("<u8").view(np.uint8).reshape(-1, 8)
            hit = reduce(np.logical_or, (near[k][blocks[:, k]] for k in range(8)))
            w, i = np.nonzero(hit)
            i = among[i]
            d = np.bitwise_count(part[w] ^ self.prints[i])
            ok = d <= RADIUS
            found.append((w[ok] + at, i[ok], d[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


class BenchmarkIndex:
    """What a task needs to find the items of one block of the benchmark."""

    def __init__(self, items: list[tuple[int, str | None]]):
        rows = [(i, w) for (i, _), w in zip(items, plain_words([t for _, t in items]), strict=True) if w]
        self.ids = [i for i, _ in rows]
        self.words = np.array([len(w) for _, w in rows], np.int64)
        self.sizes = np.minimum(SHINGLE, self.words)
        self.shingles = [chain(hashes(w), tuple(range(min(SHINGLE, len(w))))) for _, w in rows]
        prints = np.array([_pack((_bits(s).sum(axis=0, dtype=np.int64) * 2 > len(s))[None])[0] for s in self.shingles], np.uint64)
        #: By number of words: the items and the index of their fingerprints.
        self.by_words = {n: (k := np.flatnonzero(self.words == n), BlockIndex(prints[k])) for n in sorted(set(self.words.tolist()))}
        #: By size of shingle: sorted hashes, and for each an item that holds it and how often.
        self.known = {}
        #: Of each item its place among those of its number of words.
        self.place = np.zeros(len(rows), np.int64)
        for k, _ in self.by_words.values():
            self.place[k] = np.arange(len(k))
        for size in sorted(set(self.sizes.tolist())):
            of = np.flatnonzero(self.sizes == size)
            held = [np.unique(self.shingles[k], return_counts=True) for k in of]
            item = np.repeat(of, [len(h) for h, _ in held])
            h, weight = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            h, item, weight = h[order], item[order], weight[order]
            bloom = np.zeros(1 << 20, bool)
            bloom[h >> np.uint64(44)] = True
            self.known[size] = (h, item, weight, bloom)

    def _shared(self, text: np.ndarray, s: np.ndarray, size: int, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item): of the places whose texts and shingles are given, which may lie in a window that is similar to an item.

        A text and an item go on only if the weights, in the item, of all the shingles that they share reach what a similar window
        must have in common with it; a phrase that very many items hold is counted once for a text, however often it comes there."""
        keys, items, weights, _ = self.known[size]
        order = np.lexsort((s, text))
        new = np.concatenate([[True], (np.diff(text[order]) != 0) | (np.diff(s[order]) != 0)]) if len(s) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        low, high = np.searchsorted(keys, s[order][first], "left"), np.searchsorted(keys, s[order][first], "right")
        each = high - low
        pair = np.repeat(high - np.cumsum(each), each) + np.arange(each.sum())
        distinct, item = np.repeat(np.arange(len(first)), each), items[pair]
        of = text[order][first][distinct]
        both, back = np.unique(np.stack([of, item]), axis=1, return_inverse=True)
        common = np.bincount(back.reshape(-1), weights[pair], both.shape[1])
        m = np.minimum(self.words[both[1]], lens[both[0]]) - size + 1
        enough = common * (1 + SIMILARITY) >= SIMILARITY * (m + self.words[both[1]] - size + 1) - 1e-6
        kept = enough[back.reshape(-1)]
        distinct, item = distinct[kept], item[kept]
        # every place of those shingles, for those items
        times = np.diff(np.append(first, len(order)))
        n = times[distinct]
        at = np.repeat(first[distinct] + n - np.cumsum(n), n) + np.arange(n.sum())
        return order[at], np.repeat(item, n)

    def leaks(self, texts, table: WordTable) -> list[tuple[int, int, int, int, int, float]]:
        """(place of the text, item_id, first word, words, differing bits, similarity): the best window of each text and item."""
        lists = plain_words(texts)
        lens = np.array([len(w) for w in lists], np.int64)
        (h,) = table.look_up(list(itertools.chain.from_iterable(lists)))
        at = np.repeat(np.arange(len(lists)), lens)
        first = np.cumsum(lens) - lens
        best: dict[tuple[int, int], tuple] = {}
        for size, (keys, _, _, bloom) in self.known.items():
            s = chain(h, tuple(range(size)))
            place = np.flatnonzero(bloom[s >> np.uint64(44)] & (at[: len(s)] == at[size - 1 : size - 1 + len(s)]))
            place = place[keys[np.minimum(np.searchsorted(keys, s[place]), len(keys) - 1)] == s[place]]
            row, item = self._shared(at[place], s[place], size, lens)
            place, n, item = place[row], self.words[item], self.place[item]
            order = np.lexsort((place, n, at[place]))
            place, n, item = place[order], n[order], item[order]
            cuts = np.flatnonzero((np.diff(at[place]) != 0) | (np.diff(n) != 0)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(place)] if len(place) else []):
                text = int(at[place[a]])
                self._windows(text, int(first[text]), int(lens[text]), s, size, int(n[a]), place[a:b], item[a:b], best)
        return [(t, self.ids[k], *v[1:]) for (t, k), v in sorted(best.items())]

    def _windows(self, text: int, first: int, total: int, s: np.ndarray, size: int, count: int, hits: np.ndarray, shared: np.ndarray, best: dict) -> None:
        items, index = self.by_words[count]
        n = min(count, total)
        m = n - size + 1
        # starts of the windows that hold a hit, as runs
        lo, hi = np.maximum(first, hits - m + 1), np.minimum(hits, first + total - n)
        for a, b in _runs(lo, hi):
            among = np.unique(shared[np.searchsorted(hits, a) : np.searchsorted(hits, b + m - 1, "right")])
            for begin in range(a, b + 1, 8192):
                end = min(b, begin + 8191)
                sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(s[begin : end + m]), axis=0, dtype=np.int32)])
                prints = _pack((sums[m:] - sums[:-m]) * 2 > m)
                for w, i, d in zip(*(x.tolist() for x in index.search(prints, among)), strict=True):
                    start, k = begin + w, int(items[i])
                    similarity = weighted_similarity(s[start : start + m], self.shingles[k])
                    if similarity >= SIMILARITY:
                        rank = (-similarity, start - first, n, int(d), similarity)
                        if (text, k) not in best or rank < best[text, k]:
                            best[text, k] = rank


def _runs(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that cover [lo, hi] of each row, overlapping ones joined; ``lo`` ascends."""
    out: list[tuple[int, int]] = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        if b < a:
            continue
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def indexes(benchmark: DataFrame, block_chars: int = 4_000_000):
    """(number of blocks, index) for each block of the benchmark of about ``block_chars`` characters, made one after another: what is
    sent to every task has a bound, and a larger benchmark takes more passes."""
    items = benchmark.select("item_id", "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield n, BenchmarkIndex([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, bits, similarity): one row for each document and item that it holds.

    With several blocks of the benchmark each one's rows are written before the next one's index is made, so tasks hold one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["item_id", "start_word", "n_words", "bits", "similarity"]

    def scan(n: int, index: BenchmarkIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches):
            known = WordTable(lambda w: w)
            for pdf in batches:
                for at in range(0, len(pdf), 1000):
                    part = pdf.iloc[at : at + 1000]
                    rows = shared.value.leaks(part["text"], known)
                    if rows:
                        yield pd.concat([part["doc_id"].iloc[[r[0] for r in rows]].reset_index(drop=True), frame_of([r[1:] for r in rows], names)], axis=1)

        found = map_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, item_id long, start_word long, n_words long, bits int, similarity double")
        if n > 1:
            found = staged(found, "leaks")
            shared.destroy()
        return found

    return reduce(DataFrame.unionByName, (scan(n, i) for n, i in indexes(benchmark, block_chars)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item of the benchmark. With one block of the benchmark a filter on
    the text, and nothing moves; with more, each block gives a small table of the texts that hold some of its items, by MD5."""
    found = []
    for n, index in indexes(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        clean = _clean(shared)(F.col("text"))
        if n == 1:
            return docs.filter(clean)
        found.append(staged(docs.filter(~clean).select(F.md5("text").alias("key")).distinct(), "leaking-texts"))
        shared.destroy()
    keys = reduce(DataFrame.union, found).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.md5("text").alias("name"))
    return rows.join(keys, F.col("name") == F.col("key"), "left_anti").select("row.*")


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        out, known = np.ones(len(texts), bool), WordTable(lambda w: w)
        for at in range(0, len(texts), 1000):
            for r in shared.value.leaks(texts.iloc[at : at + 1000], known):
                out[at + r[0]] = False
        return pd.Series(out)

    return clean


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark in one narrow pass per block of it."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
