import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.llm import decontaminate as d
from clipfeat.llm.words import WordTable

from .edge import documents, empty


def counts(words, size):
    out = {}
    for i in range(len(words) - size + 1):
        k = tuple(words[i : i + size])
        out[k] = out.get(k, 0) + 1
    return out


def brute(texts, items):
    """The best similarity of any item-sized window of each text and item, where it is 0.8 or more."""
    found = {}
    for i, t in texts:
        w = re.findall(r"\w+", (t or "").lower())
        for k, x in items:
            q = re.findall(r"\w+", (x or "").lower())
            size, n = min(5, len(q)), min(len(q), len(w))
            if not q or n < size:
                continue
            want = counts(q, size)
            hits = [s for s in range(len(w) - size + 1) if tuple(w[s : s + size]) in want]
            for s in range(len(w) - n + 1):
                if not any(s <= h <= s + n - size for h in hits):  # nothing in common
                    continue
                have = counts(w[s : s + n], size)
                low = sum(min(c, have.get(g, 0)) for g, c in want.items())
                sim = low / (sum(want.values()) + sum(have.values()) - low)
                if sim >= 0.8:
                    found[i, k] = max(found.get((i, k), 0), sim)
    return found


def test_against_all_windows(spark):
    random.seed(0)
    vocab = [f"w{i}" for i in range(40)]
    text = lambda n: [random.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(n))) for k, n in enumerate([3, 5, 9, 15, 15, 30, 58])] + [(90, None), (91, "")]
    docs = []
    for i in range(100):
        w = text(random.randrange(0, 80))
        if i % 2:
            q = items[random.randrange(7)][1].split()
            if i % 4 == 3:
                q[random.choice([0, -1])] = "changed"
            at = random.randrange(len(w) + 1)
            w[at:at] = [x.upper() if i % 3 == 0 else x + "!!" for x in q]
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, "")]
    got = {(r.doc_id, r.item_id): r.similarity for r in d.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    assert len(want) > 25 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_blocks_guarantee_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    near = prints[:50].copy()
    for k in range(23):
        near ^= np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)
    windows = np.concatenate([near, rng.integers(0, 2**63, 50).astype(np.uint64)])
    w, i, bits = d.BlockIndex(prints).search(windows)
    want = {(a, b): int(c) for a in range(100) for b, c in enumerate(np.bitwise_count(windows[a] ^ prints)) if c <= d.RADIUS}
    assert dict(zip(zip(w.tolist(), i.tolist(), strict=True), bits.tolist(), strict=True)) == want


def test_a_benchmark_in_blocks_gives_the_same(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    pairs = lambda size: sorted((t, x[1]) for _, index in d.indexes(items, size) for x in index.leaks([r.text for r in docs], WordTable(lambda w: w)) for t in [x[0]])
    assert pairs(1500) == pairs(4_000_000) and pairs(1500)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = lambda size: sorted(tuple(r) for r in d.find_leaks(table, items, size).collect())
    assert rows(6000) == rows(4_000_000)
    kept = lambda size: sorted(r.doc_id for r in d.without_leaks(table, items, size).collect())
    assert kept(6000) == kept(4_000_000) and len(kept(6000)) < table.count()


def test_op2_against_all_windows_of_the_table(spark, sf_dir):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = {(r.doc_id, r.item_id): r.similarity for r in d.op2_decontaminate(spark, sf_dir).collect()}
    want = brute(docs, items)
    assert want and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("make", [documents, empty])
def test_filter(spark, make):
    docs = make(spark)
    items = spark.createDataFrame([(1, "sat on the mat and looked at the dog over")], "item_id long, text string")
    kept = d.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in (1, 2))
    nothing = items.filter(F.lit(False))
    assert d.without_leaks(docs, nothing).count() == docs.count() and d.find_leaks(docs, nothing).count() == 0


def test_op2_finds_every_passage_word_for_word(spark, sf_dir):
    docs = {r.doc_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = {(i, k) for i, t in docs.items() for k, x in items.items() if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in d.op2_decontaminate(spark, sf_dir).collect()}
    assert want and want <= got


def test_a_phrase_of_many_items_that_a_text_repeats():
    """40,000 words of one phrase, which 800 items hold: counted once, and whole items in the same text are found."""
    rng = random.Random(1)
    phrase = "alpha beta gamma delta epsilon"
    items = [(k, " ".join(f"{rng.choice('abcdefghij')}{rng.randrange(5000)}" for _ in range(20)) + f" {phrase} " + " ".join(f"z{rng.randrange(5000)}" for _ in range(15 + k % 30))) for k in range(800)]
    items += [(900, " ".join([phrase] * 4))]
    index = d.BenchmarkIndex(items)
    began = time.process_time()
    found = index.leaks([" ".join([phrase] * 4000 + [items[7][1]] + [phrase] * 4000)], WordTable(lambda w: w))
    assert {r[1] for r in found} == {7, 900} and all(r[5] == 1.0 for r in found)
    assert time.process_time() - began < 5


def test_recall_of_the_radius(spark, sf_dir):
    """Of all windows of the tables that are similar to an item none lies beyond the radius of its fingerprint."""
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    radius, d.RADIUS = d.RADIUS, 64
    try:
        every = {(t, r[1]) for t, (_, text) in enumerate(docs) for r in d.BenchmarkIndex(items).leaks([text], WordTable(lambda w: w))}
    finally:
        d.RADIUS = radius
    near = {(t, r[1]) for t, (_, text) in enumerate(docs) for r in d.BenchmarkIndex(items).leaks([text], WordTable(lambda w: w))}
    assert every == near and every
