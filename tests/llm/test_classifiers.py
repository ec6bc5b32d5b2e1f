import collections
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clipfeat.llm import quality as q
from clipfeat.llm import toxicity as t
from clipfeat.llm.shared import label_sample
from clipfeat.llm.words import chain, mix

from .edge import documents, empty


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = q.fit(x[:3000], y[:3000], rounds=40)
    assert (0, 1) in [p[:2] for p in m["pairs"]]
    assert ((q.predict(m, x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_prediction_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, len(q.FEATURES))), rng.integers(0, 2, 500).astype(float)
    m = q.fit(x, y, rounds=5)
    f = m["base"]
    for j, (e, tab) in enumerate(zip(m["edges"], m["tables"], strict=True)):
        f += tab[np.searchsorted(e, x[7, j])]
    for a, b, g in m["pairs"]:
        f += g[np.searchsorted(m["coarse"][a], x[7, a]), np.searchsorted(m["coarse"][b], x[7, b])]
    assert abs(q.predict(m, x[7:8])[0] - 1 / (1 + np.exp(-f))) < 1e-12


@pytest.mark.parametrize("n", [0, 1])
def test_models_of_no_or_one_row(n):
    m = q.fit(np.zeros((n, len(q.FEATURES))), np.ones(n))
    assert 0 < q.predict(m, np.zeros((1, len(q.FEATURES))))[0] < 1


def test_features_of_odd_texts():
    assert q.features_of(None) == q.features_of("") == q.features_of(" \n") == (0.0,) * len(q.FEATURES)
    assert all(np.isfinite(q.features_of(x)).all() for x in ("a", "a\n\nb!", "你好 \U0001f600", "x" * 100_000))


def test_batched_scores_are_those_of_single_texts():
    rng = np.random.default_rng(2)
    dense = np.where(rng.random(t.WIDTH) < 0.02, rng.normal(size=t.WIDTH) * 0.05, 0)
    stems = (dense[1 << t.GRAM_BITS :].reshape(t.LEVELS, -1) != 0).any(axis=0)
    texts = [" ".join(f"word{i}" for i in rng.integers(0, 90, n)) for n in rng.integers(0, 200, 80)] + [None, "", "a", "a b"]
    known = t.word_table()
    one = [1 / (1 + np.exp(-(dense[t.coordinates(x, known)].sum() - 0.5))) for x in texts]
    assert np.allclose(t.score_texts(texts, dense, stems, -0.5, words_at_once=700), one)


def naive_ftrl(rows, alpha=0.08, beta=1.0, l1=1.5, l2=1.0):
    """One coordinate at a time, from the update's definition."""
    z, n = {}, {}

    def weight(i, bound):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= bound else -(zi - math.copysign(bound, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for x, y in rows:
        w = {i: weight(i, 0.0 if i == "bias" else l1) for i in [*x, "bias"]}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i, wi in w.items():
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
            z[i] = z.get(i, 0.0) + g - sigma * wi
            n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i, l1) for i in z if i != "bias" and weight(i, l1)}, weight("bias", 0.0)


def test_ftrl_is_that_of_its_definition_and_keeps_few_weights():
    rng = np.random.default_rng(3)
    rows = [(np.unique(np.append(rng.integers(100, 20_000, 60), 7 if y else 8)), y) for y in rng.integers(0, 2, 600)] * 2
    learner = t.Ftrl()
    for x, y in rows:
        learner.learn(x, y)
    kept, w, bias = learner.result()
    by = dict(zip(kept.tolist(), w.tolist(), strict=True))
    want, want_bias = naive_ftrl([(x.tolist(), y) for x, y in rows])
    assert by.keys() == want.keys() and all(abs(by[i] - want[i]) < 1e-9 for i in by) and abs(bias - want_bias) < 1e-9
    assert by[7] > 0 > by[8] and len(kept) < 12_000 and max(by.values()) == by[7]


def naive_coordinates(text):
    """Words, neighbours, pairs with one word between, and levels of stems, by sets and counts."""
    words = re.findall(r"\w+", (text or "").lower())
    h = lambda w: np.array([xxhash.xxh64_intdigest(w)], np.uint64)
    pair = lambda a, b: chain(np.concatenate([h(a), h(b)]), (0, 1))
    top = lambda x, bits: int(x[0] >> np.uint64(64 - bits))
    out = {top(mix(h(w)), t.GRAM_BITS) for w in words}
    out |= {top(pair(a, b), t.GRAM_BITS) for a, b in zip(words, words[1:], strict=False)}
    out |= {top(mix(pair(a, b) ^ t.SKIP), t.GRAM_BITS) for a, b in zip(words, words[2:], strict=False)}
    stems = collections.Counter(top(mix(h(w[:7])), t.STEM_BITS) for w in words) + collections.Counter(top(mix(h(w[:5]) ^ np.uint64(0x27D4EB2F)), t.STEM_BITS) for w in words)
    for k, c in stems.items():
        for level, there in enumerate((c >= 1, c >= 2, c >= 4, c >= 2 and c * 40 >= len(words))):
            if there:
                out.add((1 << t.GRAM_BITS) + (level << t.STEM_BITS) + k)
    return out


def test_coordinates_of_whole_texts(spark, sf_dir):
    known = t.word_table()
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [None, "", "a", "a a a", "b a b"]
    for text in texts:
        x = t.coordinates(text, known)
        assert len(set(x.tolist())) == len(x) and set(x.tolist()) == naive_coordinates(text)


def naive_features(text):
    """The features from their meaning, over characters' bytes, words and lines."""
    raw = (text or "").encode()
    words = re.findall(rb"[^ \t\n\r\x0b\x0c]+", raw)
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(q.FEATURES)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
    lens, pairs = [len(w) for w in words], list(zip(words, words[1:], strict=False))
    mean = sum(lens) / n
    share = lambda test: sum(map(test, raw)) / size
    return [
        math.log(1 + size), math.log(1 + n), mean, math.sqrt(sum((x - mean) ** 2 for x in lens) / n), upper / max(1, upper + lower), share(lambda b: 48 <= b <= 57),
        share(lambda b: 32 < b < 127 and not chr(b).isalnum()), share(lambda b: chr(b) in "#$%&*|~^<>{}=_\\"), share(lambda b: chr(b) in "!?"), len(set(words)) / n,
        max(words.count(w) for w in set(words)) / n, sum(a == b for a, b in pairs) / n, math.log(1 + len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)), sum(x.rstrip()[-1:] in (b".", b"?", b"!") for x in lines) / max(1, len(lines)), sum(x <= 3 for x in lens) / n,
        sum(x >= 16 for x in lens) / n, 1 - len(set(pairs)) / max(1, n - 1), share(lambda b: b > 127),
    ]


def test_features_of_whole_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: [r[f] for f in q.FEATURES] for r in q.text_features(docs).collect()}
    for r in docs.collect():
        if len(r.text or "") < 20_000:
            assert np.allclose(got[r.doc_id], naive_features(r.text), atol=1e-9)


def test_label_sample_is_that_of_the_smallest_hashes(spark):
    rows = [(i, i % 2, 0) for i in range(3000)] + [(5, 1, 0), (None, 1, 0), (9000, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    everything = label_sample(labels, "quality", 10_000)
    assert everything.count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(3000)) and everything.filter("doc_id = 5 and y <> 1").isEmpty()
    want = everything.orderBy(F.xxhash64("doc_id"), "doc_id").limit(100).collect()
    assert sorted(label_sample(labels, "quality", 100).collect()) == sorted(want)


@pytest.mark.parametrize("make", [documents, empty])
def test_edge_cases(spark, make):
    docs = make(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in (1, 2, 4, 6, 8, 10, 11)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    feats = q.text_features(docs)
    scored = q.score_quality(feats, q.train_quality(feats, labels))
    assert scored.count() == docs.count() and all(0 <= r.score <= 1 for r in scored.collect())
    for lab in (labels, labels.limit(0)):
        m = t.train_toxicity(docs, lab)
        rows = t.score_toxicity(docs, m).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        kept = t.not_toxic(docs, m)
        assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.3 for r in rows) if m["bias"] is not None else kept.count() == docs.count()


@pytest.mark.parametrize(("op", "label", "sf"), [(q.op1_quality, "quality", "sf0.01"), (t.op7_toxicity, "toxic", "sf0.1")])
def test_held_out_accuracy(spark, op, label, sf):
    """Toxic words are many and rare, so that classifier needs the larger table to learn from."""
    d = f"/root/testdata/{sf}"
    rows = {r.doc_id: r for r in op(spark, d).collect()}
    known = [(r[label], rows[r.doc_id]) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    held = [(y, r) for y, r in known if r.held_out]
    pos, neg = ([r.score for y, r in held if y == k] for k in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])
    assert len(held) > 50 and auc > 0.85
    assert np.mean([r.predicted == y for y, r in held]) > 0.9
