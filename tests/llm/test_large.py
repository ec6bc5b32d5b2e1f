"""Ids beyond 2 to the 53 beside nulls, and very long texts, in every operator."""

import numpy as np
import pytest

from clipfeat.llm import chat, decontaminate, importance, mixing, neardup, pii, quality, tiff, tokens, toxicity, warc, wrapper
from clipfeat.llm.shared import new_dir

A, B = 2**62 + 1, 2**62
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards watch from the old stone bridge"
TEXTS = [(A, f"a text that says {PASSAGE} and goes on"), (None, f"another one says {PASSAGE} too"), (B, "short")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", t, i, f"http://x/{t[:3]}", "user", 0) for i, t in TEXTS], "doc_id long, text string, source string, html string, page_id long, url string, role string, turn long").coalesce(1)


def tox(docs):
    return toxicity.score_toxicity(docs, {"k": np.array([0]), "w": np.array([1.0]), "bias": 0.0})


def qual(docs):
    x = quality.text_features(docs)
    return quality.score_quality(x, quality.fit(np.random.default_rng(1).random((40, len(quality.FEATURES))), np.arange(40.0) % 2))


def images(docs):
    return tiff.image_features(tiff.tiff_pages(tiff.texts_as_tiff(docs), "media", ("doc_id",)), ("doc_id",))


def archives(docs):
    return warc.reassembled(warc.read_archives(warc.write_archives(docs, new_dir(docs.sparkSession, "warc")))).withColumnRenamed("page_id", "doc_id")


def talks(docs):
    return chat.read_back(chat.format_conversations(docs.withColumnRenamed("doc_id", "conv_id"))).withColumnRenamed("conv_id", "doc_id")


def sites(docs):
    return wrapper.extracted(docs, wrapper.induced(docs)).withColumnRenamed("page_id", "doc_id")


ALL = {
    "op1": qual, "op3": images, "op4": lambda d: neardup.fingerprint_classes(neardup.fingerprints(d)), "op5": archives, "op6": lambda d: mixing.mix(mixing.sized(d), mixing.targets(mixing.sized(d))), "op7": tox,
    "op8": pii.find_personal_data, "op9": tokens.token_output, "op10": talks, "op11": lambda d: importance.importance_resample(d, d.select("text")), "op13": sites,
}


@pytest.mark.parametrize("name", sorted(ALL))
def test_ids(docs, name):
    got = [r["doc_id"] for r in ALL[name](docs).select("doc_id").collect()]
    assert sorted(got, key=repr) == sorted([A, B, None], key=repr)


def test_ids_of_leaks(spark, docs):
    items = spark.createDataFrame([(2**61 + 1, PASSAGE)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()} == {(A, 2**61 + 1), (None, 2**61 + 1)}


LONG = {
    "labels": "x@" + "a." * 500_000 + "b c",
    "one_word": "w" * 5_000_000,
    "digits": "1 2-3" * 400_000,
    "addresses": " ".join(f"name{i}@host{i % 50}.example.org" for i in range(3_000)),
}


@pytest.mark.parametrize("text", sorted(LONG))
def test_personal_data_in_long_texts(spark, text):
    rows = spark.createDataFrame([(1, LONG[text]), (2, "mail a@b.co")], "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s)[:3] for s in r["base"]] for r in pii.find_personal_data(rows).collect()}
    assert found[2] == [(5, 0, 11)]
    assert len(found[1]) == {"labels": 1, "one_word": 0, "digits": 0, "addresses": 3_000}[text]
    if text == "labels":
        assert found[1] == [(0, 0, 2 + 1_000_000 + 1)]


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op7", "op9", "op11", "op13"])
def test_texts_of_megabytes(spark, name):
    rows = spark.createDataFrame([(1, "w" * 3_000_000, "s"), (2, "a b c " * 400_000, "s")], "doc_id long, text string, source string").selectExpr("*", "text as html", "doc_id as page_id", "'http://x/' as url")
    assert {r["doc_id"] for r in ALL[name](rows).select("doc_id").collect()} == {1, 2}


def test_toxicity_sample_has_a_row_for_each_doc_id(spark):
    docs = spark.createDataFrame([(k % 3, f"text {k}") for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (5, 1)], "doc_id long, toxic int")
    a = toxicity.train_toxicity(docs, labels)
    firsts = docs.filter("text in ('text 0', 'text 1', 'text 2')")
    assert a["bias"] is not None and len(a["k"]) <= 3 * 3 * 8 and firsts.count() == 3


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).collect()
    assert all(r["score"] < 0.3 and r["predicted"] == 0 for r in rows)
