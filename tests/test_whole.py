"""Videos with holes, and what belongs to judging them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.jobs import extract
from clipfeat.operators import annotate, compare, qa
from clipfeat.operators.encode import projection_encoder
from clipfeat.sources import store


def frames(spark, indexes):
    rows = [(v, i, 2, 2, bytearray([(i or 0) % 251] * 12)) for v, these in indexes.items() for i in these]
    return spark.createDataFrame(rows, "video_id string, frame_idx long, height int, width int, pixels binary")


@pytest.mark.parametrize("stride", [4, 16, 20])
def test_lost_frames_fail_a_video(spark, tmp_path, stride):
    whole = list(range(200))
    videos = {
        "whole": whole, "short": whole[:5], "chunk": whole[:64] + whole[128:], "first": whole[64:], "one": whole[:50] + whole[51:], "between": [i for i in whole if i not in (18, 19)],
        "twice": whole + [40], "swapped": whole[:40] + [41] + whole[41:], "null": [*whole, None], "negative": [-1, *whole],
    }
    f = frames(spark, videos)
    extract.extract_visual(f.select("video_id").distinct(), f, projection_encoder(4), str(tmp_path / "s"), str(tmp_path / "l"), size=2, stride=stride, clips_per_chunk=2)
    lines = {r["video_id"]: r for r in store.read_ledger(spark, str(tmp_path / "l")).collect()}
    assert {v for v, r in lines.items() if r["status"] == "ok"} == {"whole", "short"}
    assert lines["whole"]["windows"] == (200 - 16) // stride + 1 and lines["short"]["windows"] == 1
    assert all(r["error"] for r in lines.values() if r["status"] == "failed")
    kept = store.read_features(spark, str(tmp_path / "s/store"), store.read_ledger(spark, str(tmp_path / "l")))
    assert {r["video_id"] for r in kept.select("video_id").distinct().collect()} == {"whole", "short"}


def test_limit_needs_only_its_frames(spark, tmp_path):
    f = frames(spark, {"a": [i for i in range(100) if i != 70], "b": [i for i in range(100) if i != 20]})
    extract.extract_visual(f.select("video_id").distinct(), f, projection_encoder(4), str(tmp_path / "s"), str(tmp_path / "l"), size=2, stride=8, clips_per_chunk=2, limit=3)
    got = {r["video_id"]: (r["status"], r["windows"]) for r in store.read_ledger(spark, str(tmp_path / "l")).collect()}
    assert got == {"a": ("ok", 3), "b": ("failed", 0)}


def test_spans(spark):
    rng = np.random.default_rng(2)
    videos = {f"v{k}": rng.integers(-1, 30, int(rng.integers(1, 60))).tolist() for k in range(40)}
    got = {r["video_id"]: r for r in qa.frame_spans(frames(spark, videos), 4, 2).collect()}
    for v, these in videos.items():
        there = {i for i in these if i >= 0}
        length = max(these) + 1
        assert got[v]["missing"] == max(0, length) - len(there) and got[v]["repeated"] == len(these) - len(set(these))
        assert got[v]["unnumbered"] == sum(i < 0 for i in these)
        assert got[v]["steps"] == (max(0, (length - 4) // 2) + 1 if length > 0 else 0)


def test_contiguous_steps(spark):
    rows = [("a", s) for s in (0, 1, 2)] + [("b", s) for s in (0, 2, 2)] + [("c", s) for s in (1, 2, 3)] + [("d", s) for s in (0, 0)]
    f = spark.createDataFrame([(v, "visual", s, [1.0, 2.0]) for v, s in rows], "video_id string, modality string, step long, feature array<double>")
    for df in (qa.summarize(f, 2), qa.assembled(f)):
        assert {r["video_id"] for r in df.filter("contiguous").collect()} == {"a"}


def test_segments_without_a_category(spark):
    rows = spark.createDataFrame([("s1", "7"), ("s2", None), ("s3", "9"), ("s4", None)], "seg_id string, recipe_type string")
    names = spark.createDataFrame([("7", "soup")], "id string, name string")
    for cats, first in ((names, "soup"), (None, "recipe 7")):
        got = {r["seg_id"]: (r["label"], r["label_id"]) for r in annotate.label_ids(annotate.label_segments(rows, cats)).collect()}
        order = sorted({first, "recipe 9", "recipe None"})
        assert got == {"s1": (first, order.index(first)), "s2": ("recipe None", order.index("recipe None")), "s3": ("recipe 9", order.index("recipe 9")), "s4": ("recipe None", order.index("recipe None"))}
    none = spark.createDataFrame([("a",), (None,), ("b",)], "label string")
    assert {r["label"]: r["label_id"] for r in annotate.label_ids(none).collect()} == {"a": 0, "b": 1, None: 2}


def test_similarity_in_blocks_of_groups(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(k % 9, rng.normal(size=5).tolist()) for k in range(60)], "g int, feature array<double>")
    round_ = lambda df: sorted(df.select("left", "right", F.round("mean_vector_cosine", 9), F.round("mean_pairwise_cosine", 9)).collect())
    want = round_(compare.space_similarity(rows, "g"))
    monkeypatch.setattr(compare, "BLOCK_GROUPS", 2)
    assert round_(compare.space_similarity(rows, "g")) == want and len(want) == 45
