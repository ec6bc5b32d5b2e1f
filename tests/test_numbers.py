"""Medians by counting, means in a tree, resampling by phases, mapping from SQL."""

import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.operators import audio, compare, encode, select
from clipfeat.operators.worklist import shard_ids


def test_medians_of_small_groups(spark):
    rng = np.random.default_rng(3)
    groups = {"one": [4.0], "two": [1.0, 2.0], "ties": [1.0] * 7 + [2.0] * 7, "far": [-1e300, 1e300, 0.0, 5.0, 1e-300], "near": [0.1, 0.1 + 2**-56, 0.3], None: [3.0, 1.0]}
    groups |= {f"r{k}": np.round(rng.normal(size=int(rng.integers(1, 40))), int(rng.integers(0, 3))).tolist() for k in range(30)}
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v] + [("one", None), ("ties", float("nan"))], "g string, x double")
    for most in (select.SORTED, 0):
        select.SORTED, kept = most, select.SORTED
        try:
            got = {r["g"]: r["median"] for r in select.exact_medians(df, "g", "x").collect()}
        finally:
            select.SORTED = kept
        assert got == {g: pytest.approx(float(np.median(v)), rel=1e-15) for g, v in groups.items()}


def test_median_of_a_large_group(spark):
    """A million values of one group, most of them in a tiny part of their range: no task sorts more than its share."""
    df = spark.range(1_000_001).select(F.lit("v").alias("g"), (F.xxhash64("id") % 1_000_003 / F.when(F.col("id") % 1000 == 0, 1e-9).otherwise(7.0)).alias("x"))
    (got,) = select.exact_medians(df, "g", "x").collect()
    assert got["median"] == df.agg(F.median("x")).first()[0]


def test_means_of_wide_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(k % 3 if k % 11 else None, f"n{k % 2}", rng.normal(size=40).tolist()) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, feature array<double>").repartition(7)
    got = {(r["a"], r["b"]): (r["n"], r["mean"]) for r in compare.wide_vector_means(df, ["a", "b"]).collect()}
    for key in {r[:2] for r in rows}:
        part = [r[2] for r in rows if r[:2] == key]
        assert got[key][0] == len(part) and np.allclose(got[key][1], np.mean(part, axis=0))
    (one,) = compare.wide_vector_means(df, []).collect()
    assert one["n"] == 500 and np.allclose(one["mean"], np.mean([r[2] for r in rows], axis=0))
    assert compare.wide_vector_means(df.limit(0), ["a"]).count() == 0


@pytest.mark.parametrize("up,down", [(160, 441), (2, 3), (3, 2), (1, 4), (147, 160)])
@pytest.mark.parametrize("name", sorted(audio.FILTERS))
def test_products_by_phase(up, down, name):
    rng = np.random.default_rng(1)
    x = rng.normal(size=3000)
    taps, half = audio.resample_filter(up, down, None, name)
    first, total = 700, 3700 * up // down
    for begin, end in ((0, 50), (700 * up // down - 5, 700 * up // down + 500), (total - 60, total + 40), (9, 9)):
        got = audio.resample(x, first, up, down, begin, end, taps, half)
        want = []
        for j in range(begin, end):
            places = j * down // up + np.arange(-half, half + 1) - first
            inside = (places >= 0) & (places < len(x))
            want.append((x[places[inside]] * taps[j * down % up][inside]).sum())
        assert np.allclose(got, want, atol=1e-5) and got.dtype == np.float32


def test_filters_keep_a_tone(spark):
    t = np.arange(44_100) / 44_100
    x = np.sin(2 * np.pi * 440 * t)
    for name in audio.FILTERS:
        y = audio.resample(x, 0, 160, 441, 0, 16_000, *audio.resample_filter(160, 441, None, name))
        assert np.abs(y[500:-500] - np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000)[500:-500]).max() < 2e-3
    with pytest.raises(KeyError):
        audio.resample_blocks(audio.to_blocks(spark.createDataFrame([("a", [1.0])], "video_id string, samples array<float>"), 4), 8000, 16000, res_type="none")


def test_a_million_outputs_of_one_item(spark):
    def fn(x):
        yield from range(1_000_000 if x == 1 else 2)
        if x == 3:
            raise ValueError("three")

    before = resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss
    items = spark.createDataFrame([(1,), (2,), (3,)], "item long").coalesce(1)
    rows = encode.map_items(items, fn, "long")
    assert {tuple(r) for r in rows.groupBy("item").agg(F.count("output"), F.max("seq"), F.max("error")).collect()} == {(1, 1_000_000, 999_999, None), (2, 2, 1, None), (3, 2, 2, "ValueError('three')")}
    encode.register_mapper(spark, "a_mapper", fn, "long")
    items.createOrReplaceTempView("some_items")
    got = spark.sql("SELECT t.item + 1 AS next, m.* FROM some_items t, LATERAL a_mapper(t.item) m")
    assert got.schema["output"].dataType.simpleString() == "bigint" and got.schema["item"].dataType.simpleString() == "bigint"
    assert {tuple(r) for r in got.groupBy("next").agg(F.count("output"), F.max("seq"), F.max("error")).collect()} == {(2, 1_000_000, 999_999, None), (3, 2, 1, None), (4, 2, 2, "ValueError('three')")}
    assert before >= 0


def test_ranges_of_a_bounded_sample(spark, monkeypatch):
    from clipfeat.operators import worklist

    monkeypatch.setattr(worklist, "RANGE_IDS", 10)
    monkeypatch.setattr(worklist, "MOST_RANGES", 4)
    ids = spark.range(500).select(F.col("id").cast("string").alias("video_id"))
    assert 0 < len(worklist._ranges(ids, "video_id")) <= 8
    got = {r["video_id"]: r["position"] for r in shard_ids(ids, 3).collect()}
    assert got == {v: k for k, v in enumerate(sorted(map(str, range(500))))}
