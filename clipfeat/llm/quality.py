"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature at a time and adds a shallow tree over that feature's bins to the
feature's lookup table; then the strongest pairs of features get two-dimensional tables in the same
way. A score is the sum of table entries, so scoring is a bin search and a few vectorised additions.

Cases: a null or empty text has all features 0 and gets a score like any other; ties and repeated rows
get equal scores; with no labelled rows the score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import held_out, label_sample, map_frames, staged, table

FEATURES = (
    "log_chars", "log_words", "word_len", "word_len_std", "upper", "digits", "symbols", "marks", "shouts", "distinct",
    "top_word", "repeats", "log_lines", "line_dups", "line_words", "line_stops", "short_words", "long_words", "pair_dups", "non_ascii",
)

_LOWER, _UPPER = bytes(range(97, 123)), bytes(range(65, 91))
_DIGIT, _SPACE = b"0123456789", b" \t\n\r\x0b\x0c"
_ALL, _WIDE = bytes(range(256)), bytes(range(128, 256))
_SYMBOL = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _count(raw: bytes, kind: bytes) -> int:
    return len(raw) - len(raw.translate(None, kind))


def features_of(text: str | None) -> tuple[float, ...]:
    """The features of one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return (0.0,) * len(FEATURES)
    lens = np.fromiter(map(len, words), dtype=np.float64, count=n)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = _count(raw, _UPPER), _count(raw, _LOWER)
    pairs = set(zip(words, words[1:], strict=False))
    return (
        np.log1p(size), np.log1p(n), lens.mean(), lens.std(), upper / max(1, upper + lower), _count(raw, _DIGIT) / size,
        _count(raw, _SYMBOL) / size, _count(raw, b"#$%&*|~^<>{}=_\\") / size, _count(raw, b"!?") / size, len(counts) / n,
        max(counts.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)), sum(x.rstrip()[-1:] in b".?!" for x in lines) / max(1, len(lines)), float((lens <= 3).mean()),
        float((lens >= 16).mean()), 1 - len(pairs) / max(1, n - 1), _count(raw, _WIDE) / size,
    )


def text_features(docs: DataFrame) -> DataFrame:
    """(doc_id, <features>) for every row; one narrow pass over the whole texts."""

    def run(batches):
        for pdf in batches:
            x = np.array([features_of(t) for t in pdf["text"]], dtype=np.float64).reshape(len(pdf), len(FEATURES))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], **{f: x[:, j] for j, f in enumerate(FEATURES)}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int, lam: float) -> np.ndarray:
    """Values of a shallow tree over ordered bins: the best cut, then the best cut of each part."""
    total = np.full(len(g), g.sum() / (h.sum() + lam))
    if depth == 0 or len(g) < 2:
        return total
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + lam) + (g.sum() - gl) ** 2 / (h.sum() - hl + lam)
    k = int(np.argmax(gain)) + 1
    if gain[k - 1] <= g.sum() ** 2 / (h.sum() + lam) + 1e-9:
        return total
    return np.concatenate([_leaves(g[:k], h[:k], depth - 1, lam), _leaves(g[k:], h[k:], depth - 1, lam)])


def _quadrants(g: np.ndarray, h: np.ndarray, lam: float) -> np.ndarray:
    """Values of the best cut of a grid into four parts, one cut along each side."""
    gc, hc = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    best, out = -1.0, np.zeros_like(g)
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            parts = [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)), (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]
            gs = [gc[a, b], gc[a, -1] - gc[a, b], gc[-1, b] - gc[a, b], gc[-1, -1] - gc[a, -1] - gc[-1, b] + gc[a, b]]
            hs = [hc[a, b], hc[a, -1] - hc[a, b], hc[-1, b] - hc[a, b], hc[-1, -1] - hc[a, -1] - hc[-1, b] + hc[a, b]]
            gain = sum(x * x / (y + lam) for x, y in zip(gs, hs, strict=True))
            if gain > best:
                best = gain
                for part, x, y in zip(parts, gs, hs, strict=True):
                    out[part] = x / (y + lam)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, rate: float = 0.15, pairs: int = 6, grid: int = 8, lam: float = 4.0) -> dict:
    """Lookup tables from feature rows and 0/1 labels; deterministic for given rows."""
    pos = float(y.sum())
    base = float(np.log((pos + 0.5) / (len(y) - pos + 0.5)))
    cuts = lambda col, n: np.unique(np.quantile(col, np.linspace(0, 1, n + 1)[1:-1])) if len(col) else np.zeros(0)
    edges = [cuts(x[:, j], bins) for j in range(x.shape[1])]
    coarse = [cuts(x[:, j], grid) for j in range(x.shape[1])]
    code = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
    wide = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = {"base": base, "edges": edges, "coarse": coarse, "tables": tables, "pairs": []}
    if not len(y):
        return model
    f = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, c in enumerate(code):
            g, h = slopes()
            step = rate * _leaves(np.bincount(c, g, len(tables[j])), np.bincount(c, h, len(tables[j])), 2, lam)
            tables[j] += step
            f += step[c]
    g, h = slopes()
    gains = []
    for a in range(len(code)):
        for b in range(a + 1, len(code)):
            na, nb = len(coarse[a]) + 1, len(coarse[b]) + 1
            cell = wide[a] * nb + wide[b]
            gg, hh = np.bincount(cell, g, na * nb), np.bincount(cell, h, na * nb)
            gains.append((float((gg**2 / (hh + lam)).sum()), a, b))
    chosen = [(a, b) for _, a, b in sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:pairs]]
    grids = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in chosen]
    for _ in range(rounds // 4):
        for k, (a, b) in enumerate(chosen):
            g, h = slopes()
            shape = grids[k].shape
            cell = wide[a] * shape[1] + wide[b]
            n = shape[0] * shape[1]
            step = rate * _quadrants(np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape), lam)
            grids[k] += step
            f += step.ravel()[cell]
    model["pairs"] = [(a, b, t) for (a, b), t in zip(chosen, grids, strict=True)]
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probabilities by table lookups."""
    f = np.full(len(x), model["base"])
    for j, (e, t) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        f += t[np.searchsorted(e, x[:, j], side="left")]
    for a, b, t in model["pairs"]:
        f += t[np.searchsorted(model["coarse"][a], x[:, a], side="left"), np.searchsorted(model["coarse"][b], x[:, b], side="left")]
    return 1 / (1 + np.exp(-f))


def score_quality(features: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) from a feature table."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": predict(shared.value, pdf[list(FEATURES)].to_numpy(np.float64))})

    kind = features.schema["doc_id"].dataType.simpleString()
    return map_frames(features, run, f"doc_id {kind}, score double")


def train_quality(features: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> dict:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold (a documented bound: about 3 MB of numbers).

    The chosen labels, of that bound, go to the feature table, so features don't move; of rows that share a doc_id the one of
    the least features counts."""
    known = label_sample(labels, "quality", max_rows)
    rows = features.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(*FEATURES)).alias("x")).select("doc_id", "y", "x.*")
    rows = rows.toPandas().sort_values("doc_id")
    return fit(rows[list(FEATURES)].to_numpy(np.float64), rows["y"].to_numpy(np.float64))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features once into a table; the model from its labelled part; scores from table lookups."""
    features = staged(text_features(table(spark, sf_dir, "documents")), "quality-features")
    model = train_quality(features, table(spark, sf_dir, "labels"))
    return score_quality(features, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
