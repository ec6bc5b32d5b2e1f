"""Index arithmetic and windows against enumeration."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.functions import windows as fw
from clipfeat.operators import audio, clips, encode, frames


def enumerate_clips(n, nf, stride):
    if n == 0:
        return {}
    if n < nf:
        return {0: [min(i, n - 1) for i in range(nf)]}
    return {k: list(range(k * stride, k * stride + nf)) for k in range((n - nf) // stride + 1)}


def test_num_windows(spark):
    cases = [(0, 16, 8, 1), (1, 16, 8, 1), (15, 16, 8, 1), (16, 16, 8, 1), (17, 16, 8, 1), (23, 16, 8, 1), (24, 16, 8, 2), (160, 16, 4, 37), (3866, 16, 8, 482)]
    for total, w, hop, want in cases:
        assert spark.range(1).select(fw.num_windows(F.lit(total), w, hop)).first()[0] == want


def test_expected(spark):
    rows = spark.createDataFrame([(241.65,), (None,), (0.5,), (10.0,)], "d double")
    got = [tuple(r) for r in rows.select(fw.expected_clips("d"), fw.expected_steps("d"), fw.expected_clips("d", stride=4, max_clips=30)).collect()]
    assert got == [(482, 482, 30), (1, 1, 1), (1, 1, 1), (19, 19, 30)]


@pytest.mark.parametrize("case", [(640, 360, "round", 455, 256, 99, 0), (360, 640, "round", 256, 455, 0, 99), (256, 256, "round", 256, 256, 0, 0), (320, 240, "round", 341, 256, 42, 0), (640, 360, "even", 456, 256, 100, 0)])
def test_geometry(spark, case):
    w, h, mode, *want = case
    assert list(spark.range(1).select(fw.resize_geometry(F.lit(w), F.lit(h), mode=mode).alias("g")).first()["g"]) == want
    assert list(frames.geometry(w, h, 256, mode)) == want


@pytest.mark.parametrize(("nf", "stride"), [(16, 8), (16, 4), (16, 20), (3, 1), (5, 7)])
def test_clip_windows(spark, nf, stride):
    sizes = {k: n for k, n in enumerate([0, 1, nf - 1, nf, nf + 1, 40, 41])}
    rows = spark.createDataFrame([(v, i) for v, n in sizes.items() for i in range(n)], "video_id long, frame_idx long")
    got = {}
    for v, c, p, f in clips.clip_windows(rows.repartition(5), nf, stride).collect():
        got.setdefault((v, c), {})[p] = f
    want = {(v, c): dict(enumerate(x)) for v, n in sizes.items() for c, x in enumerate_clips(n, nf, stride).items()}
    assert got == want


@pytest.mark.parametrize("limit", [None, 2, 4])
def test_chunks(spark, limit):
    rows = spark.createDataFrame([(0, 40), (1, 0), (2, 7), (3, 16)], "video_id long, total long")
    got = {(r.video_id, r.chunk_id): (r.first_frame, r.first_frame + r.n_frames, r.n_clips) for r in clips.chunk_plan(rows, 16, 8, 3, limit).collect()}
    long = {(0, 0): (0, 24, 2)} if limit == 2 else {(0, 0): (0, 32, 3), (0, 1): (24, 40, 1)}
    assert got == long | {(2, 0): (0, 7, 1), (3, 0): (0, 16, 1)}


def test_chunks_give_the_clips_of_windows(spark):
    random.seed(3)
    totals = [(v, random.randrange(0, 90)) for v in range(30)]
    for nf, stride, per in ((16, 8, 3), (4, 6, 2), (5, 1, 4)):
        plan = clips.chunk_plan(spark.createDataFrame(totals, "video_id long, total long"), nf, stride, per).collect()
        got = {}
        for r in plan:
            block = np.arange(r.first_frame, r.first_frame + r.n_frames)[:, None]
            for k, c in enumerate(encode.unfold(block, r.n_clips, nf, stride)):
                got[r.video_id, r.first_clip + k] = c.ravel().tolist()
        assert got == {(v, c): x for v, n in totals for c, x in enumerate_clips(n, nf, stride).items()}


def naive_audio(x, window, hop):
    if len(x) < window:
        return [np.tile(x, -(-window // len(x)))[:window]]
    return [x[k * hop : k * hop + window] for k in range((len(x) - window) // hop + 1)]


@pytest.mark.parametrize(("window", "hop"), [(8, 4), (8, 8), (8, 11), (5, 2)])
def test_audio_windows(spark, window, hop):
    rng = np.random.default_rng(1)
    waves = {v: rng.normal(size=n).astype(np.float32) for v, n in enumerate([1, 3, 7, 8, 9, 50, 101])}
    rows = spark.createDataFrame([(v, x.tolist()) for v, x in waves.items()], "video_id long, samples array<float>")
    got = {(r.video_id, r.step): np.array(r.samples) for r in audio.audio_windows(audio.to_blocks(rows, 6), window, hop, per_group=3).collect()}
    want = {(v, k): w for v, x in waves.items() for k, w in enumerate(naive_audio(x, window, hop))}
    assert set(got) == set(want)
    for k, w in want.items():
        assert np.allclose(got[k], (w - w.mean()) / np.sqrt(w.var() + 1e-5), atol=1e-4)


def test_resampling_in_blocks_is_that_of_the_whole(spark):
    x = np.sin(np.arange(3000) / 9).astype(np.float32)
    rows = spark.createDataFrame([("a", x.tolist())], "video_id string, samples array<float>")
    out = audio.resample_blocks(audio.to_blocks(rows, 250), 44_100, 16_000, block=128, zeros=8).orderBy("block_id").collect()
    got = np.concatenate([r.samples for r in out])
    taps, half = audio.resample_filter(160, 441, 8)
    whole = audio.resample(x.astype(np.float64), 0, 160, 441, 0, len(got), taps, half)
    assert len(got) == -(-3000 * 160 // 441)
    assert np.allclose(got, whole, atol=1e-6)
    middle = np.arange(200, len(got) - 200)
    assert np.abs(got[middle] - np.sin(middle * 441 / 160 / 9)).max() < 0.02


def test_silence(spark):
    rows = spark.createDataFrame([("a", 2.5, False), ("b", None, False), ("c", 1.0, True)], "video_id string, duration double, has_audio boolean")
    got = audio.silence_fallback(rows, block=15_000).collect()
    assert {r.video_id for r in got} == {"a"} and sum(len(r.samples) for r in got) == 40_000
    w = audio.audio_windows(audio.silence_fallback(rows, block=15_000), 16_000, 8_000).collect()
    assert len(w) == 4 and all(not any(r.samples) for r in w)


def test_silence_of_a_decimal_duration_is_whole(spark):
    """F2: 16.15 seconds gave 258,399 samples of silence instead of 258,400, and so a window less than the SQL of extract_audio_job."""
    rows = spark.createDataFrame([(16.15,), (32.3,), (2.5,), (0.0001,), (None,), (float("nan"),)], "duration double")
    got = [r.n for r in rows.select(audio.silence_length("duration").alias("n")).collect()]
    assert got == [258_400, 516_800, 40_000, 1, 0, 0]


def test_audio_job_against_its_sql_where_durations_are_no_binary_fractions(spark, tmp_path):
    """documents without a track whose characters fill their last window exactly."""
    from clipfeat.queries import registered

    from .oracle import rows_of, sql_rows

    rows = [(10 * k + 3, "text", n) for k, n in enumerate((16_150, 32_050, 16_149, 100, 99, 0))] + [(1, "x" * 4000, 4000), (7, "y", 1), (5, "z", 50)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    queries, oracles = registered()
    got, want = rows_of(queries["extract_audio_job"](spark, f"file://{tmp_path}").toPandas()), sql_rows(oracles["extract_audio_job"], str(tmp_path))
    assert got == want and len(want[1]) == 16


def test_resize_keeps_a_flat_picture_and_a_gradient():
    flat = np.full((90, 160, 3), 77, np.uint8)
    assert (frames.resize_crop(flat, 32) == 77).all()
    ramp = np.broadcast_to(np.arange(160, dtype=np.uint8)[None, :, None], (160, 160, 3))
    out = frames.resize_crop(np.ascontiguousarray(ramp), 80).astype(int)
    assert abs(out[0, :, 0] - (np.arange(80) * 2 + 0.5)).max() <= 1


def test_encode_is_the_same_for_any_partitioning(spark):
    rng = np.random.default_rng(2)
    rows = [(v, i, 0.0, 4, 4, rng.integers(0, 256, 48, dtype=np.uint8).tobytes()) for v, n in ((1, 5), (2, 40), (3, 16)) for i in range(n)]
    f = spark.createDataFrame(rows, "video_id long, frame_idx long, pts double, height int, width int, pixels binary")
    got = []
    for parts, per in ((1, 2), (8, 3)):
        out = encode.encode_clips(encode.gather_chunks(f.repartition(parts), 16, 8, per), encode.projection_encoder(8), 16, 8, per)
        got.append(sorted((r.video_id, r.step, tuple(np.round(r.feature, 3))) for r in out.collect()))
    assert got[0] == got[1] and [x[:2] for x in got[0]] == [(1, 0), (2, 0), (2, 1), (2, 2), (2, 3), (3, 0)]


@pytest.mark.parametrize(("nf", "stride", "per", "limit"), [(16, 8, 3, None), (4, 6, 2, None), (5, 1, 4, 7), (16, 8, 3, 4), (4, 9, 2, 3)])
def test_chunks_of_frames_hold_every_clip(spark, nf, stride, per, limit):
    """Clips that are cut from chunks are those of brute force, for any number of frames."""
    random.seed(5)
    totals = {v: random.randrange(1, 90) for v in range(25)}
    rows = [(v, i, 0.0, 1, 1, bytes([i, v, 0])) for v, n in totals.items() for i in range(n)]
    f = spark.createDataFrame(rows, "video_id long, frame_idx long, pts double, height int, width int, pixels binary")
    whole = lambda: lambda x: x[:, :, 0, 0, 0]
    out = encode.encode_clips(encode.gather_chunks(f, nf, stride, per, limit), whole, nf, stride, per).collect()
    level = lambda x: [round(float(y) * 68.5 + 122.771) for y in x]
    assert not [r for r in out if r.error]
    assert {(r.video_id, r.step): level(r.feature) for r in out} == {(v, c): x for v, n in totals.items() for c, x in enumerate_clips(n, nf, stride).items() if limit is None or c < limit}


def test_pixels_are_shuffled_once(spark):
    f = spark.createDataFrame([], "video_id long, frame_idx long, pts double, height int, width int, pixels binary")
    out = encode.encode_clips(encode.gather_chunks(f, 16, 8, 4), encode.projection_encoder(8), 16, 8, 4)
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Aggregate" not in plan
    ticks = clips.resample_fps(f, 2.0)._jdf.queryExecution().optimizedPlan().toString()
    for line in ticks.split("\n"):
        assert not ("Window" in line or "Aggregate" in line) or "pixels" not in line


def test_what_fails_stays_with_its_video(spark):
    """Damaged frames, gaps and an encoder that raises give an error for their video; the others are encoded."""
    rows = [(v, i, 0.0, 2, 2, bytes([v * 20] * 12)) for v in range(6) for i in range(20)]
    rows = [r for r in rows if (r[0], r[1]) != (1, 4)]  # a gap
    rows = [(*r[:5], r[5][:7]) if (r[0], r[1]) == (2, 18) else r for r in rows]  # cut short
    rows = [(*r[:5], None) if (r[0], r[1]) == (3, 0) else r for r in rows]
    f = spark.createDataFrame(rows, "video_id long, frame_idx long, pts double, height int, width int, pixels binary")

    def factory():
        def encode_(batch):
            if np.isclose(batch[..., 0], (80 - 122.771) / 68.5, atol=1e-4).all():
                raise RuntimeError("no")
            return batch.reshape(len(batch), -1)[:, :3]

        return encode_

    out = encode.encode_clips(encode.gather_chunks(frames.resize_frames(f, 2), 16, 4, 2), factory, 16, 4, 2).collect()
    assert {r.video_id for r in out if r.error} == {1, 2, 3, 4}
    assert {(r.video_id, r.step) for r in out if r.video_id in (0, 5)} == {(0, 0), (0, 1), (5, 0), (5, 1)}
    w = spark.createDataFrame([(1, 0, [1.0, 2.0], None), (1, 1, None, "cut"), (2, 0, [3.0, 4.0], None), (3, 0, None, None)], "video_id long, step long, samples array<float>, error string")

    def picky():
        def encode_(batch):
            if (batch == 3).any():
                raise RuntimeError("three")
            return batch

        return encode_

    got = {(r.video_id, r.step): r.error for r in encode.encode_audio(w, picky).collect()}
    assert got == {(1, 0): None, (1, 1): "cut", (2, 0): "RuntimeError('three')", (3, 0): "ValueError('samples are missing')"}


def test_blocks_that_are_missing(spark):
    rows = [("a", k, k * 10, [float(x) for x in range(k * 10, k * 10 + 10)]) for k in range(6) if k != 3] + [("b", 0, 0, [1.0] * 9)]
    blocks = spark.createDataFrame(rows, "video_id string, block_id int, sample_offset long, samples array<float>")
    out = audio.audio_windows(blocks, 8, 4, normalize=False, per_group=2).collect()
    assert {r.video_id for r in out if r.error} == {"a"} and [r.step for r in out if r.video_id == "b"] == [0]
    assert all(list(r.samples) == [float(x) for x in range(r.step * 4, r.step * 4 + 8)] for r in out if r.video_id == "a" and not r.error)
    assert {r.error for r in audio.resample_blocks(blocks, 3, 2, block=8, zeros=2).filter("error is not null").collect()} == {"blocks are missing or repeated"}


def test_rates_by_column(spark):
    x = np.sin(np.arange(900) / 9).astype(np.float32)
    rows = spark.createDataFrame([("a", x.tolist(), 8000), ("b", x.tolist(), 16000), ("c", x.tolist(), 24000)], "video_id string, samples array<float>, r int")
    blocks = audio.to_blocks(rows, 250).join(rows.select("video_id", "r"), "video_id")
    got = {}
    for r in audio.resample_blocks(blocks, "r", 16_000, block=128).orderBy("sample_offset").collect():
        got.setdefault(r.video_id, []).extend(r.samples)
    assert {v: len(y) for v, y in got.items()} == {"a": 1800, "b": 900, "c": 600} and np.array_equal(np.array(got["b"], np.float32), x)
    one = [y for r in audio.resample_blocks(audio.to_blocks(rows.filter("r = 24000"), 900), 24_000, 16_000).collect() for y in r.samples]
    assert np.allclose(one, got["c"], atol=1e-6)


def test_map_items_keeps_what_came_before_an_error(spark):
    def fn(x):
        yield x
        if x == 2:
            raise ValueError("no")
        yield x * 10

    got = sorted(tuple(r) for r in encode.map_items(spark.createDataFrame([(1,), (2,)], "item long"), fn, "long").collect())
    assert got == [(1, 0, 1, None), (1, 1, 10, None), (2, 0, 2, None), (2, 1, None, "ValueError('no')")]


def test_whole_queries_drop_nothing(spark, sf_dir):
    """The registered queries without a limit keep all clips and rows of the tables."""
    import duckdb

    from clipfeat.queries import registered

    q = registered()[0]
    count = lambda sql: duckdb.sql(sql).fetchall()[0][0]
    clips = f"SELECT CAST(sum(greatest(0, floor((n_chars - 16) / 8.0)) + 1) AS BIGINT), max(n_chars) FROM '{sf_dir}/documents.parquet' WHERE n_chars > 0"
    want, longest = duckdb.sql(clips).fetchall()[0]
    assert longest > 8100 and q["clip_chunks"](spark, sf_dir).agg({"n_clips": "sum"}).first()[0] == want
    assert q["batches"](spark, sf_dir).agg({"n": "sum"}).first()[0] == count(f"SELECT count(*) FROM '{sf_dir}/events.parquet'")
    assert q["expected_clips"](spark, sf_dir).agg({"n_clips": "max"}).first()[0] > 400
