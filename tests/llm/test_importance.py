import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipfeat.llm import importance as im

from ..oracle import rows_of, sql_rows
from . import edge

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10_000


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9 é你,\n-z "), max_size=60), st.just("x" * 700 + " y " + "ß" * 200 + " z"))), st.integers(1, 9))
def test_features(texts, at_once):
    found = Counter()
    for of, buckets in im.features([None if t is None else t.encode() for t in texts], im.RunCrcs(), at_once):
        found.update(zip(of.tolist(), buckets.tolist(), strict=True))
    assert found == Counter((i, bucket(f)) for i, t in enumerate(texts) for f in runs(t))


def brute(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, runs(text)))
    for text in target:
        t.update(map(bucket, runs(text)))
    a, b = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        f = runs(text)
        weight = sum(math.floor(1000 * math.log((t[k] + 1) * (a + 10_000) / ((s[k] + 1) * (b + 10_000)))) for k in map(bucket, f))
        h = int(sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 57), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[: percent * len(able) // 100]
    out = [(*r, k) for k, r in enumerate(drawn, 1)]
    rest = Counter(rows) - Counter(drawn)
    return sorted([*out, *((*r, None) for r in rest.elements())], key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_edge_cases(spark, percent):
    docs, target = edge.documents(spark), spark.createDataFrame([("the cat sat on the dog", 1), (None, 2)], "text string, doc_id int")
    rows = [(i, t) for i, t, *_ in edge.rows()]
    many = docs.unionByName(docs.filter("doc_id = 8")).unionByName(docs.filter("doc_id = 8"))
    assert got(im.importance_resample(many, target, percent)) == brute([*rows, (8, edge.LONG), (8, edge.LONG)], ["the cat sat on the dog", None], percent)


def test_empty(spark):
    assert im.importance_resample(edge.empty(spark), edge.empty(spark).select("text")).count() == 0
    assert got(im.importance_resample(edge.documents(spark), edge.empty(spark).select("text"), 50)) == brute([(i, t) for i, t, *_ in edge.rows()], [], 50)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.integers(-(2**63), 2**63 - 1), st.integers(-3, 3)), min_size=1, max_size=30), st.data())
def test_kth_value(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    value, place, ties = im.kth_value(spark.createDataFrame([(v,) for v in values], "v long"), F.col("v"), k)
    want = sorted(values)
    assert value == want[k - 1] and ties == values.count(value) and place == k - want.index(value)


def test_copies_at_the_cut(spark):
    rows = spark.createDataFrame([(1, 60, 5, 9)] * 3 + [(2, 60, 5, 7)] * 50 + [(None, 61, 5, 7)] * 4 + [(3, 60, 1, 2)], "doc_id long, n_features long, weight long, score long")
    for k in (0, 2, 3, 20, 53, 55, 58):
        found = im.ranked_draw(rows, k).collect()
        assert len(found) == 58 and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, k + 1))
        keys = [(-r["score"], r["doc_id"] is None) for r in sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])]
        assert keys == sorted(keys)


def test_drawn_documents(spark):
    docs = edge.documents(spark)
    kept = im.resampled_documents(docs, docs.select("text"), 100)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {8, 9}


def test_large_ids_beside_nulls(spark):
    docs = spark.createDataFrame([(2**62 + 1, "a b"), (None, "a b"), (2**62, "c")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in im.importance_resample(docs, docs.select("text")).collect()} == {2**62 + 1, 2**62, None}


def test_op11(spark, sf_dir):
    assert rows_of(im.op11_importance(spark, sf_dir).toPandas()) == sql_rows(im.SQL, sf_dir)


def test_gains_are_whole_numbers():
    g = im.gains(np.zeros(im.BUCKETS, np.int64), np.zeros(im.BUCKETS, np.int64))
    assert g.dtype == np.int64 and (g == 0).all()
