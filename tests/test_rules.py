"""Rules on names, lines, segments, vectors and stores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.functions import names, vectors
from clipfeat.jobs import annotate, extract
from clipfeat.operators import annotate as op
from clipfeat.operators import clips, encode, qa, worklist
from clipfeat.sources import media, store, text


def test_done_lines(spark):
    lines = ["﻿a", "b.mp4", "dir\\c.wav", '"/x/d_one_peace_audio.npy"', "e\tok", "  ", "", "'f'", "g.mp4.wav", "_h_30.000"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = [r[0] for r in rows.orderBy("i").select(names.done_line_to_id("value", names.SUFFIXES["audio"])).collect()]
    assert got == ["a", "b", "c", "d", "e", None, None, "f", "g.mp4", "_h_30.000"]


def test_probe(spark):
    log = "  Duration: 00:04:01.65, start: 0\n  Stream #0:0(und): Video: h264, yuv420p, 640x360 [SAR 1:1], 25 fps\n  Stream #0:1: Audio: aac, 44100 Hz, stereo\n"
    rows = spark.createDataFrame([(log,), (log.split("\n")[0],), ("",), (None,)], "l string").select(names.parse_probe("l").alias("p")).select("p.*")
    assert [tuple(r) for r in rows.collect()] == [(241.65, 640, 360, 44100), (241.65, None, None, None), (None,) * 4, (None,) * 4]


def test_media_listing(spark, tmp_path):
    for n in ("_gQFB_Utuf0_30.000_40.000.mp4", "-x.mp4", ".hidden.mp4", "Yabc.wav", "note.txt"):
        (tmp_path / n).write_text("x")
    files = media.list_files(spark, str(tmp_path))
    ids = lambda *a: sorted(r.video_id for r in media.media_ids(files, *a).collect())
    assert ids() == ["-x", ".hidden", "_gQFB_Utuf0_30.000_40.000"] and ids(".wav", "Y") == ["abc"] and ids(".wav", "Z") == []


def test_categories(spark):
    rows = spark.createDataFrame(list(enumerate(["1,soup", "2,fish, fried", "x,bad", "1,stew", "", "3"])), "line_no int, value string")
    assert {r.id: r.name for r in text.read_category_names(rows).collect()} == {"1": "stew", "2": "fish, fried"}


def test_shards(spark):
    ids = spark.createDataFrame([(f"v{i:02}",) for i in range(12)] * 2, "video_id string")
    a, b = ({r.video_id for r in worklist.shard_ids(ids, 2, k).collect()} for k in (0, 1))
    assert len(a) == len(b) == 6 and not a & b and a == {f"v{i:02}" for i in range(0, 12, 2)}
    with pytest.raises(ValueError):
        worklist.shard_ids(ids, 2, 2)


def _segments(spark):
    rows = [
        ("a_2", "a", "training", 100.0, [5.0, 20.0], "1", None), ("a_10", "a", "training", 90.0, [50.0, 120.0], "9", "late"), ("a_1", "a", "training", 80.0, [7.0, 7.0], "1", "none"),
        ("b_c_1", "b_c", "validation", 50.0, [-3.0, 10.0], "2", "x"), ("d_1", "d", "training", 50.0, [60.0, 70.0], "1", "x"), ("e_1", "e", "training", 50.0, [0.0, 1.0], "1", "x"),
        ("f_1", "f", "training", 50.0, [0.0, 1.0], "1", "x"),
    ]
    return spark.createDataFrame(rows, "seg_id string, video_id string, subset string, duration double, segment array<double>, recipe_type string, sentence string")


def test_annotate(spark):
    have = spark.createDataFrame([(v,) for v in ("a", "b_c", "d", "f")], "video_id string")
    feats = spark.createDataFrame([(v, m) for v in ("a", "b_c", "d") for m in ("visual", "audio")] + [("f", "audio"), ("e", "audio")], "video_id string, modality string")
    cats = spark.createDataFrame([("1", "stew"), ("2", "fish")], "id string, name string")
    out = annotate.annotate(_segments(spark), have, feats, cats)
    got = {r.video_id: r for r in out["annotations"].collect()}
    assert set(got) == {"a", "b_c"} and got["a"].duration == 100.0
    assert [(list(x.segment), x.label, x.label_id, x.sentence) for x in got["a"].annotations] == [([5.0, 20.0], "stew", 2, ""), ([50.0, 90.0], "recipe 9", 1, "late")]
    assert [list(x.segment) for x in got["b_c"].annotations] == [[-3.0, 10.0]]
    assert {(r.subset, r.outcome): r.n for r in out["reasons"].collect()} == {("training", "kept"): 2, ("training", "empty"): 2, ("validation", "kept"): 1, ("training", "no_video"): 1, ("training", "no_feature"): 1}
    annotate.check_leaks(out["leaks"])
    both = _segments(spark).withColumn("subset", F.when(F.col("seg_id") == "a_10", "validation").otherwise(F.col("subset")))
    with pytest.raises(ValueError):
        annotate.check_leaks(op.leaking_videos(both))


def test_segments_with_features(spark):
    """the segments themselves are kept, and only the named modalities count, not any two."""
    segs = spark.createDataFrame([(f"{v}_{k}", v) for v in "abcd" for k in range(3)], "seg_id string, video_id string")
    rows = [("a", "visual"), ("a", "audio"), ("a", "audio"), ("b", "audio"), ("b", "text"), ("c", "visual"), ("c", "audio"), ("c", "text"), ("d", None), ("e", "visual"), ("e", "audio")]
    features = spark.createDataFrame(rows, "video_id string, modality string")
    assert sorted(r.seg_id for r in op.segments_with_features(segs, features).collect()) == ["a_0", "a_1", "a_2", "c_0", "c_1", "c_2"]
    assert sorted(r.video_id for r in op.with_both_features(features).collect()) == ["a", "c", "e"]
    assert [r.video_id for r in op.with_both_features(features, ("audio", "text")).orderBy("video_id").collect()] == ["b", "c"]


def test_annotation_document_round_trip(spark):
    out = annotate.annotate(_segments(spark), None, None, None)["annotations"]
    back = text.read_annotations(text.annotation_document(out, "1", "recipe"))
    assert sorted(map(str, back.select(*out.columns).collect())) == sorted(map(str, out.collect()))


def test_vectors(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), ([float("nan"), 1.0], [1.0, 1.0]), ([float("inf"), 1.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = rows.select(vectors.cosine("a", "b"), vectors.is_finite("a"), vectors.arrow_cosine("a", "b")).collect()
    assert abs(got[0][0] - 0.96) < 1e-9 and abs(got[0][2] - 0.96) < 1e-9 and got[1][0] is None
    assert [r[1] for r in got] == [True, True, False, False]
    half = rows.limit(1).select(vectors.round_trip("bf16")("a").alias("h")).first()["h"]
    assert half == [3.0, 4.0]


def test_bad_features(spark):
    ok = [("ok", m, s, [1.0] * 4) for m in ("visual", "audio") for s in range(3)]
    nan = [("nan", m, s, [1.0, float("nan"), 1.0, 1.0] if s == 1 else [1.0] * 4) for m in ("visual", "audio") for s in range(3)]
    dim = [("dim", m, 0, [1.0] * 3) for m in ("visual", "audio")]
    f = spark.createDataFrame([*ok, *nan, *dim, ("one", "audio", 0, [1.0] * 4)], "video_id string, modality string, step long, feature array<float>")
    annos = spark.createDataFrame([(v, 2.0) for v in ("ok", "dim", "one", "none")], "video_id string, duration double")
    assert {r.video_id: r.status for r in qa.qa_join(annos, f, 4).collect()} == {"ok": "valid", "dim": "bad", "one": "missing", "none": "missing"}
    assert {r.video_id: r.status for r in qa.finite_check(f).collect()} == {"ok": "ok", "nan": "failed", "dim": "ok", "one": "ok"}


def test_probe_logs_of_other_kinds(spark):
    logs = [
        "Input #0\r\n  Duration: N/A, bitrate: N/A\r\n    Stream #0:0: Audio: pcm_s16le ([1][0][0][0] / 0x0001), 8000 Hz, mono, s16, 128 kb/s\r\n",
        "  Duration: 01:00:00.00, start: 0.04, bitrate: 9 kb/s\n  Stream #0:0[0x1](eng): Video: h264 (High) (avc1 / 0x31637661), yuv420p(tv, bt709), 1280x720, 30 fps\n  Stream #0:1: Subtitle: mov_text\n",
        "  title: Video: 12x34, at 5 Hz\n  Stream #0:0: Video: mjpeg, 90x90 [SAR 1:1 DAR 1:1]\n  Stream #0:1: Video: h264, 640x360\n",
    ]
    rows = spark.createDataFrame([(x,) for x in logs], "l string").select(names.parse_probe("l").alias("p")).select("p.*")
    assert [tuple(r) for r in rows.collect()] == [(None, None, None, 8000), (3600.0, 1280, 720, None), (None, 90, 90, None)]


def test_shards_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(worklist, "RANGE_IDS", 60)
    ids = spark.createDataFrame([(f"v{i * 7919 % 5000:05}",) for i in range(5000)] + [(None,)], "video_id string")
    got = {r.video_id: (r.position, r.shard) for r in worklist.shard_ids(ids, 7).collect()}
    assert got == {f"v{i:05}": (i, i % 7) for i in range(5000)}


def test_space_similarity_of_wide_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(g, rng.normal(size=300).tolist()) for g in ("a", "b", "c") for _ in range(5)]
    f = spark.createDataFrame(rows, "modality string, feature array<double>")
    from clipfeat.operators import compare

    flat = {(r.left, r.right): (r.mean_vector_cosine, r.mean_pairwise_cosine) for r in compare.space_similarity(f).collect()}
    wide = {(r.left, r.right): (r.mean_vector_cosine, r.mean_pairwise_cosine) for r in compare.space_similarity(f, wide=True).collect()}
    assert len(flat) == 6 and all(np.allclose(flat[k], wide[k]) for k in flat)
    a, b = (np.array([v for g, v in rows if g == x]) for x in "ab")
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    assert np.allclose(flat["a", "b"], (unit(a.mean(0)) @ unit(b.mean(0)), (unit(a) @ unit(b).T).mean()))


def _frames(spark, videos):
    rng = np.random.default_rng(5)
    rows = [(v, i, 0.0, 6, 8, rng.integers(0, 256, 144, dtype=np.uint8).tobytes()) for v, n in videos.items() for i in range(n)]
    return spark.createDataFrame(rows, "video_id string, frame_idx long, pts double, height int, width int, pixels binary")


def test_extract_visual(spark, tmp_path):
    frames = _frames(spark, {"_a": 20, "b": 3, "x": 20})
    frames = frames.withColumn("pixels", F.when((F.col("video_id") == "x") & (F.col("frame_idx") == 2), F.unhex(F.lit("00"))).otherwise(F.col("pixels")))
    ids = spark.createDataFrame([("_a",), ("b",), ("c",), ("done",), ("x",)], "video_id string")
    work = extract.work_list(ids, ids, spark.createDataFrame([("done",)], "video_id string"))
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    lines = extract.extract_visual(work, frames, encode.projection_encoder(8), out, ledger, size=4)
    got = {r.video_id: (r.status, r.error, r.windows, r.modality) for r in lines.collect()}
    assert got.pop("x")[:1] == ("failed",)
    assert got == {"_a": ("ok", None, 1, "visual"), "b": ("ok", None, 1, "visual"), "c": ("failed", "no windows", 0, "visual")}
    assert {r.video_id: r.n for r in extract.stored(work, out, ledger).groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {"_a": 1, "b": 1}
    assert {(r.status, r.value.split("(")[0]) for r in store.ledger_lines(store.read_ledger(spark, ledger)).collect()} == {("ok", "_a"), ("ok", "b"), ("failed", "c\tno windows"), ("failed", "x\tValueError")}
    s = extract.summary(lines, 2.0).first()
    assert (s.n_ok, s.n_failed, s.windows, s.windows_per_sec) == (2, 2, 2, 1.0)


def test_shards_side_by_side_and_again(spark, tmp_path):
    """Two shards at once keep their own files; a run over the same videos replaces what readers see; a cut-off run is not read."""
    from concurrent.futures import ThreadPoolExecutor

    frames = _frames(spark, {f"v{i}": 24 for i in range(6)})
    ids = frames.select("video_id").distinct()
    none = spark.createDataFrame([], "video_id string")
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")

    def shard(k):
        return extract.extract_visual(extract.work_list(ids, ids, none, 2, k), frames, encode.projection_encoder(8), out, ledger, size=4, shard_id=k).count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(shard, range(2))) == [3, 3]
    count = lambda: {r.video_id: r.n for r in extract.stored(ids, out, ledger).groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert count() == {f"v{i}": 2 for i in range(6)}
    again = ids.filter("video_id = 'v1'")
    extract.extract_visual(again, frames.filter("frame_idx < 16"), encode.projection_encoder(8, seed=1), out, ledger, size=4)
    assert count() == {f"v{i}": 2 if i != 1 else 1 for i in range(6)}
    store.write_features(extract.stored(ids, out, ledger).drop("run"), f"{out}/store/run=99-0-x")
    assert count() == {f"v{i}": 2 if i != 1 else 1 for i in range(6)}


def _wav(path, samples, rate=16_000, width=2, channels=1):
    import wave

    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(samples)


def test_extract_audio(spark, tmp_path):
    """Sound at two rates, silence, an empty file, and broken ones: the good are stored, each of the others fails alone."""
    tone = (np.sin(np.arange(40_000) / 5) * 9000).astype("<i2")
    _wav(tmp_path / "a.wav", tone.tobytes())
    _wav(tmp_path / "b.wav", tone.tobytes(), rate=8_000, channels=2)
    _wav(tmp_path / "empty.wav", b"")
    _wav(tmp_path / "wide.wav", tone.tobytes(), width=4)
    (tmp_path / "broken.wav").write_bytes(b"no sound")
    _wav(tmp_path / "cut.wav", tone.tobytes())
    whole = (tmp_path / "cut.wav").read_bytes()
    (tmp_path / "cut.wav").write_bytes(whole[: len(whole) // 2])
    rows = [(v, str(tmp_path / f"{v}.wav"), 2.5) for v in ("a", "b", "empty", "wide", "broken", "cut", "gone")] + [("mute", None, 1.5), ("unknown", None, None)]
    files = spark.createDataFrame(rows, "video_id string, path string, duration double")
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    lines = extract.extract_audio(files.select("video_id"), files, encode.projection_encoder(8), out, ledger, 16_000, 8_000, shard_id=3, block=7_000)
    got = {}
    for r in lines.collect():
        got.setdefault(r.video_id, {})[r.status] = (r.error, r.windows, r.modality, r.shard_id)
    assert got["a"] == {"ok": (None, 4, "audio", 3)} and got["b"] == {"ok": (None, 4, "audio", 3)}
    assert got["empty"] == {"ok": (None, 4, "audio", 3), "silent": (None, 0, "audio", 3)} and got["mute"]["ok"][1] == 2
    assert set(got["unknown"]) == {"failed", "silent"} and got["unknown"]["failed"][0] == "no windows"
    assert all(set(got[v]) == {"failed"} and got[v]["failed"][0] for v in ("wide", "broken", "cut", "gone"))
    assert {r.video_id for r in extract.stored(files, out, ledger).select("video_id").distinct().collect()} == {"a", "b", "empty", "mute"}
    assert sorted(r.video_id for r in store.read_ledger(spark, ledger).filter("status = 'silent'").collect()) == ["empty", "mute", "unknown"]


def test_damaged_features_and_done_sets(spark, tmp_path):
    suffix, here, there = names.SUFFIXES["audio"], tmp_path / "here", tmp_path / "there"
    here.mkdir()
    there.mkdir()
    np.save(here / f"_a{suffix}", np.ones((3, 2), np.float64))
    (here / f"bad{suffix}").write_bytes(b"none")
    np.save(here / f"flat{suffix}", np.ones(3))
    (here / f"t{suffix}.tmp.npy").write_bytes(b"")
    (here / "done_audio_shard0.txt").write_text("b\nc.wav\n\n", encoding="utf-8-sig")
    (here / "failed_audio_shard0.txt").write_text("z\terror\n")
    np.save(there / f"d{suffix}", np.ones((1, 2)))
    (tmp_path / "more.txt").write_text(f"x/y/e{suffix}\n")
    back = store.read_features_npy(media.list_files(spark, str(here)).select("name", "path"), 4).collect()
    assert {r.video_id: r.error is None for r in back} == {"_a": True, "bad": False, "flat": False} and sum(r.error is None for r in back) == 3
    with pytest.warns(UserWarning, match="nowhere"):
        done = store.done_set(spark, [str(here)], "audio", "done_audio", [str(there), str(tmp_path / "more.txt"), str(tmp_path / "nowhere")])
    assert {r.video_id for r in done.collect()} == {"_a", "bad", "flat", "b", "c", "d", "e"}


def test_resample_fps_repeats_and_drops(spark):
    rows = spark.createDataFrame([(1, 0, 0.0, "a"), (1, 1, 0.1, "b"), (1, 2, 0.9, "c"), (1, 3, 3.0, "d")], "video_id long, frame_idx long, pts double, v string")
    got = [(r.tick, r.v) for r in clips.resample_fps(rows, 1.0).orderBy("tick").collect()]
    assert got == [(0, "b"), (1, "c"), (2, "c"), (3, "d")]
