"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a whole text are the presence of hashed words, word pairs and pairs that skip a word, and how
often and how densely word stems (the first seven and the first five characters) occur. Per-coordinate
rates and an L1 term leave few weights other than zero; those are small enough to send to every task, and
their number is bounded by the width of the hash space.

Cases: a null or empty text gets the score of the bias alone; ties and repeated rows get equal scores; with no
labelled rows every score is 0 and predicted is 0, and the filter keeps all rows; of labelled rows that share a doc_id one
is learned, that of the smallest hash of its text; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import held_out, label_sample, map_frames, staged, table
from .words import WordTable, chain, mix

#: Width of the space of word and pair features, and of each of the levels of stem features.
GRAM_BITS, STEM_BITS, LEVELS = 20, 18, 4
WIDTH = (1 << GRAM_BITS) + LEVELS * (1 << STEM_BITS)

_WORDS = re.compile(r"\w+")
SKIP = np.uint64(0x5BD1E995)


def word_table() -> WordTable:
    return WordTable(lambda w: w, lambda w: w[:7], lambda w: w[:5])


def gram_ids(h: np.ndarray) -> np.ndarray:
    """Buckets of words, neighbouring pairs, and pairs with one word between, in order of place."""
    grams = np.concatenate([mix(h), chain(h, (0, 1)), mix(chain(h, (0, 2)) ^ SKIP)])
    return (grams >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def stem_ids(seven: np.ndarray, five: np.ndarray) -> np.ndarray:
    stems = np.concatenate([mix(seven), mix(five ^ np.uint64(0x27D4EB2F))])
    return (stems >> np.uint64(64 - STEM_BITS)).astype(np.int64)


def reached(counts: np.ndarray, n_words) -> list[np.ndarray]:
    """Levels that counts of stems reach: seen; twice or more; four times or more; one word in forty or more (and twice)."""
    return [counts >= 1, counts >= 2, counts >= 4, (counts >= 2) & (counts * 40 >= n_words)]


def levels_of(ids: np.ndarray, counts: np.ndarray, n_words: int) -> np.ndarray:
    """The coordinates of stems that occur so often among so many words."""
    return np.concatenate([(1 << GRAM_BITS) + (k << STEM_BITS) + ids[there] for k, there in enumerate(reached(counts, n_words))])


def coordinates(text: str | None, known: WordTable) -> np.ndarray:
    """All coordinates of a whole text, each once."""
    words = _WORDS.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.int64)
    h, seven, five = known.look_up(words)
    return np.concatenate([np.unique(gram_ids(h)), levels_of(*np.unique(stem_ids(seven, five), return_counts=True), len(words))])


class Ftrl:
    """The learner: sums of gradients and of their squares by coordinate, and the weights that follow from them."""

    def __init__(self, alpha: float = 0.08, beta: float = 1.0, l1: float = 1.5, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)

    def weights(self, x: np.ndarray) -> np.ndarray:
        """Zero until a coordinate's sum passes the L1 bound; the bias, which is the last one, is not thinned out."""
        z, bound = self.z[x], np.where(x == WIDTH, 0.0, self.l1)
        return np.where(np.abs(z) <= bound, 0.0, -(z - np.sign(z) * bound) / ((self.beta + np.sqrt(self.n[x])) / self.alpha + self.l2))

    def learn(self, x: np.ndarray, y: float) -> None:
        """One row of distinct coordinates, and its label."""
        x = np.append(x, WIDTH)
        w = self.weights(x)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        root = np.sqrt(self.n[x])
        self.z[x] += g - (np.sqrt(self.n[x] + g * g) - root) / self.alpha * w
        self.n[x] += g * g

    def result(self) -> tuple[np.ndarray, np.ndarray, float]:
        """(coordinates, weights, bias), weights of zero left out."""
        w = self.weights(np.arange(WIDTH + 1))
        kept = np.flatnonzero(w[:WIDTH])
        return kept, w[kept], float(w[WIDTH])


def train_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, epochs: int = 3) -> dict:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold. The sample's whole texts are turned into
    coordinates on the executors; one task then learns from them, row by row, ``epochs`` times. The rows are sorted on disk and
    stream through that task, which holds a batch of them and two numbers for each coordinate; only weights other than zero
    come back."""
    known = label_sample(labels, "toxic", max_rows)

    def hashed(batches):
        words, seen = word_table(), set()
        for pdf in batches:
            fresh = [i not in seen and not seen.add(i) for i in pdf["doc_id"].tolist()]
            pdf = pdf[fresh]
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                yield pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "x": [coordinates(t, words).astype(np.int32) for t in part["text"]]})

    def learn(batches):
        learner = Ftrl()
        seen = False
        for batch in batches:
            rows, y = batch.column("x"), batch.column("y").to_numpy()
            seen |= len(y) > 0
            values, ends = rows.values.to_numpy(), rows.offsets.to_numpy()
            for k in range(len(y)):
                learner.learn(values[ends[k] : ends[k + 1]], float(y[k]))
        if seen:
            kept, w, bias = learner.result()
            yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, WIDTH)), pa.array(np.append(w, bias))], ["k", "w"])

    # at most max_rows small rows (some 16 bytes each) go to every task, so the texts stay where they are
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(known), "doc_id")
    # one row for each doc_id, so the task that learns gets no more rows than were asked for: of different texts that of the smallest
    # hash, of equal ones one a task and then that of the first task; only ids and hashes move for it, no more than max_rows
    first = staged(rows.groupBy("doc_id").agg(F.min("h").alias("h")), "toxicity-texts")
    rows = rows.join(F.broadcast(first), ["doc_id", "h"]).select("doc_id", "y", "text")
    sample = staged(rows.mapInPandas(hashed, "doc_id long, y int, x array<int>").withColumn("task", F.spark_partition_id()), "toxicity-sample")
    sample = sample.join(F.broadcast(sample.groupBy("doc_id").agg(F.min("task").alias("task"))), ["doc_id", "task"]).drop("task")
    sample = sample.withColumn("order", F.xxhash64("doc_id", F.lit(7)))
    rows = sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).repartition(1)
    found = rows.sortWithinPartitions("epoch", "order", "doc_id", F.size("x")).select("x", "y").mapInArrow(learn, "k long, w double").toPandas()
    if not len(found):
        return {"k": np.zeros(0, np.int64), "w": np.zeros(0), "bias": None}
    bias = found["k"] == WIDTH
    return {"k": found["k"][~bias].to_numpy(), "w": found["w"][~bias].to_numpy(), "bias": float(found["w"][bias].iloc[0])}


def score_texts(texts, dense: np.ndarray, stems: np.ndarray, bias: float, words_at_once: int = 200_000) -> np.ndarray:
    """Scores of whole texts; ``stems`` marks the stem buckets that have a weight on any level.

    The words of many texts are looked up in one array; the few that reach a weight are then counted by text."""
    known, done, held, n = word_table(), [], [], 0

    def flush():
        lens = np.array([len(w) for w in held], np.int64)
        at = np.repeat(np.arange(len(held)), lens)
        h, seven, five = known.look_up(list(itertools.chain.from_iterable(held)))
        total = np.full(len(held), bias)
        for ids, gap in ((mix(h), 0), (chain(h, (0, 1)), 1), (mix(chain(h, (0, 2)) ^ SKIP), 2)):
            k = (ids >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
            kept = np.flatnonzero((dense[k] != 0) & (at[: len(k)] == at[gap : gap + len(k)]))
            grams.append((at[kept] << GRAM_BITS) | k[kept])
        seen = np.unique(np.concatenate(grams))
        grams.clear()
        total += np.bincount(seen >> GRAM_BITS, dense[seen & ((1 << GRAM_BITS) - 1)], len(held))
        k = stem_ids(seven, five)
        two = np.concatenate([at, at])
        kept = np.flatnonzero(stems[k])
        seen, counts = np.unique((two[kept] << STEM_BITS) | k[kept], return_counts=True)
        doc, k = seen >> STEM_BITS, seen & ((1 << STEM_BITS) - 1)
        for level, there in enumerate(reached(counts, lens[doc])):
            total += np.bincount(doc[there], dense[(1 << GRAM_BITS) + (level << STEM_BITS) + k[there]], len(held))
        done.append(total)
        held.clear()

    grams: list[np.ndarray] = []
    for t in texts:
        held.append(_WORDS.findall((t or "").lower()))
        n += len(held[-1])
        if n >= words_at_once:
            flush()
            n = 0
    if held:
        flush()
    return 1 / (1 + np.exp(-np.clip(np.concatenate(done or [np.zeros(0)]), -30, 30)))


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with a score column, in one narrow pass; null where the model was not trained."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        dense = np.zeros(WIDTH)
        dense[m["k"]] = m["w"]
        stems = (dense[1 << GRAM_BITS :].reshape(LEVELS, -1) != 0).any(axis=0)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": score_texts(pdf["text"].tolist(), dense, stems, m["bias"])})

    kind = docs.schema["doc_id"].dataType.simpleString()
    if model["bias"] is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return map_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double").withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def not_toxic(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score lies under ``threshold``. Rows without a text stay.

    The score is a column of its own over the text, so no join with the documents is needed."""
    if model["bias"] is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: pd.Series) -> pd.Series:
        m = shared.value
        if "dense" not in _HELD or _HELD["of"] is not m:
            dense = np.zeros(WIDTH)
            dense[m["k"]] = m["w"]
            _HELD.update(of=m, dense=dense, stems=(dense[1 << GRAM_BITS :].reshape(LEVELS, -1) != 0).any(axis=0))
        return pd.Series(score_texts(batches.tolist(), _HELD["dense"], _HELD["stems"], m["bias"]))

    return docs.filter(score(F.col("text")) < threshold)


_HELD: dict = {}


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows of the training folds, then score every whole text."""
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
