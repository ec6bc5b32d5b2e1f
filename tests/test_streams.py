"""Streams over many batches against their batch forms."""

import time
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipfeat.operators import clips
from clipfeat.streaming import assemble, windows

STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(spark, tmp_path, batches, schema, build, timers=False):
    """Rows of a stream whose batches are ``batches``, one file each. With timers on the clock a stream has no end of its own."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)  # files are taken in the order of their times
    stream = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src))
    sink = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state"))
    if timers:
        q = sink.trigger(processingTime="200 milliseconds").start()
        late = time.time() + 60
        while time.time() < late and sum(p["numInputRows"] for p in q.recentProgress) < sum(map(len, batches)):
            time.sleep(0.2)
        seen = len(q.recentProgress)
        while time.time() < late and len(q.recentProgress) < seen + 3:
            time.sleep(0.2)
        q.stop()
        return spark.read.schema(stream.schema).parquet(out)
    q = sink.trigger(availableNow=True).start()
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == len(batches)
    return spark.read.schema(stream.schema).parquet(out)


FRAME = "video_id string, frame_idx long, pixels binary, note string, last boolean"


def frame(v, i, n):
    return (v, i, bytes([i]), f"{v}{i}", i == n - 1)


def test_clips_over_six_batches_are_those_of_one(spark, tmp_path):
    videos = {"a": 50, "b": 3, "c": 16, "d": 23}
    batches = [[frame(v, i, n) for v, n in videos.items() for i in range(k * 9, min(n, k * 9 + 9))] for k in range(6)]
    got = run(spark, tmp_path, batches, FRAME, lambda s: windows.stream_clips(s, 16, 8))
    rows = spark.createDataFrame([frame(v, i, n) for v, n in videos.items() for i in range(n)], FRAME)
    want = clips.clip_windows(rows, 16, 8).join(rows.drop("last"), ["video_id", "frame_idx"])
    columns = ["video_id", "clip_idx", "pos", "frame_idx", "pixels", "note"]
    plain = lambda df: sorted((r.video_id, r.clip_idx, r.pos, r.frame_idx, bytes(r.pixels), r.note) for r in df.select(*columns).collect())
    assert plain(got.filter("error is null")) == plain(want) and got.filter("error is not null").isEmpty()


def test_a_missing_frame_spoils_its_clips_alone(spark, tmp_path):
    rows = [frame("a", i, 40) for i in range(40) if i != 10]
    got = run(spark, tmp_path, [rows[:20], rows[20:]], FRAME, lambda s: windows.stream_clips(s, 8, 8)).collect()
    assert {r.clip_idx for r in got if r.error} == {1} and {r.clip_idx for r in got if not r.error} == {0, 2, 3, 4}


def test_frames_in_any_order_within_a_batch(spark, tmp_path):
    rows = [frame("a", i, 40) for i in range(40)]
    batches = [[*reversed(rows[:21]), ("a", None, None, "lost", False), ("b", None, None, "end", True)], [*rows[15:30:2], *rows[21:30], rows[22]], [*rows[30:39], ("a", 39, bytes([39]), "a39", None), ("a", None, None, None, True)]]
    got = run(spark, tmp_path, batches, FRAME, lambda s: windows.stream_clips(s, 16, 8)).collect()
    clips_of = {(r.clip_idx, r.pos): (r.frame_idx, r.note) for r in got if not r.error}
    assert clips_of == {(c, p): (8 * c + p, f"a{8 * c + p}") for c in range(4) for p in range(16)}
    assert [r.error for r in got if r.error] == ["a frame without an index"] and len(got) == 65


class _Value:
    """What the state of one key does, in memory."""

    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


@pytest.mark.parametrize("num_frames,stride", [(16, 8), (16, 20), (5, 1)])
def test_time_grows_with_the_frames(num_frames, stride):
    """60,000 frames of one video in one batch: all clips, with few frames held, in time in proportion."""
    took = {}
    for n in (15_000, 60_000):
        buffer = windows.ClipBuffer(num_frames, stride, ["value"], "value double")
        buffer.state = _Value()
        parts = [pd.DataFrame({"frame_idx": range(a, min(n, a + 5000)), "value": 0.5, "last": False}) for a in range(0, n, 5000)]
        began, rows = time.process_time(), 0
        for pdf in buffer.handleInputRows(("v",), iter(parts), None):
            rows += len(pdf)
        took[n] = time.process_time() - began
        assert rows == ((n - num_frames) // stride + 1) * num_frames
        assert len(buffer.state.value[1]) < num_frames + stride
    assert took[60_000] < 8 * took[15_000] + 0.2


@pytest.mark.parametrize("idle", [None, 1])
def test_videos_that_never_end(spark, tmp_path, idle):
    """With a time limit their state goes in a later batch: a short video gives its clip, an open one its failure."""
    batches = [[frame("short", i, 99) for i in range(3)], [frame("other", i, 20) for i in range(10)], [frame("other", i, 20) for i in range(10, 20)]]
    got = run(spark, tmp_path, batches, FRAME, lambda s: windows.stream_clips(s, 16, 8, idle), idle is not None).collect()
    assert [r.frame_idx for r in sorted(got, key=lambda r: r.pos) if r.video_id == "short"] == ([] if idle is None else [0, 1] + [2] * 14)


@pytest.mark.parametrize("idle", [None, 1])
def test_messages_over_batches(spark, tmp_path, idle):
    schema = "video_id string, seq long, kind string, n long, error string"
    batches = [
        [("a", 0, "start", 0, None), ("b", 0, "start", 0, None), ("c", 0, "start", 0, None)],
        [("a", 1, "chunk", 4, None), ("b", 1, "chunk", 4, "broken"), ("d", 5, "end", 0, None)],
        [("a", 2, "chunk", 3, None), ("a", 3, "end", 0, None), ("b", 2, "end", 0, None)],
    ]
    if idle is not None:  # only one video says something in every batch
        batches = [[r for r in b if r[0] == "c"] or [("z", 0, "end", 0, None)] for b in batches]
    got = {(r.video_id, r.status, r.windows, r.error) for r in run(spark, tmp_path, batches, schema, lambda s: assemble.stream_assemble(s, idle), idle is not None).collect()}
    if idle is None:
        assert got == {("a", "ok", 7, None), ("b", "failed", 0, "broken"), ("d", "failed", 0, "end without start")}
        flat = spark.createDataFrame([r for b in batches for r in b], schema)
        assert got == {(r.video_id, r.status, r.windows, r.error) for r in assemble.assemble(flat).select("video_id", "status", F.col("windows"), "error").collect()}
    else:
        assert ("c", "failed", 0, "no end") in got


class _Group:
    """What a group's state does, in memory, at a given time."""

    def __init__(self, now=0):
        self.value, self.now, self.hasTimedOut, self.timeout = None, now, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.timeout = self.now + ms


def test_videos_of_a_bucket_share_calls_and_frames():
    """each short video's batch was a call, messages to the state store and a frame of its own, which was nearly all of the time."""
    buckets, group = windows.ClipBuckets(16, 8, ["value"], "value double"), _Group()
    rows = pd.DataFrame({"video_id": [v for _ in range(24) for v in range(1000)], "frame_idx": [i for i in range(24) for _ in range(1000)], "value": 0.5, "last": False})
    out = list(buckets((0,), iter([rows[:13_000], rows[13_000:]]), group))
    assert len(out) <= 32_000 // 4096 + 1
    got = pd.concat(out)
    assert len(got) == 32_000 and set(got.groupby(["video_id", "clip_idx"]).size()) == {16} and got["error"].isna().all()
    out = list(buckets((0,), iter([pd.DataFrame({"video_id": range(999), "frame_idx": 24, "value": 0.5, "last": True})]), group))
    assert not out and len(windows.pickle.loads(group.value[0])) == 1


def test_buckets_give_what_single_videos_give(spark, tmp_path):
    rows = [frame("a", i, 40) for i in range(40)]
    batches = [
        [*reversed(rows[:21]), ("a", None, None, "lost", False), ("b", None, None, "end", True), frame("c", 0, 2), (None, 3, b"x", "x", False)],
        [*rows[15:30:2], *rows[21:30], rows[22], *[frame("d", i, 40) for i in range(30) if i != 10], frame("c", 1, 2), (None, 0, None, None, None)],
        [*rows[30:39], ("a", 39, bytes([39]), "a39", None), ("a", None, None, None, True), *[frame("d", i, 40) for i in range(30, 40)], (None, 1, b"y", "y", True)],
    ]
    got = {}
    for n in (None, 1, 3):
        where = tmp_path / str(n)
        where.mkdir()
        out = run(spark, where, batches, FRAME, lambda s: windows.stream_clips(s, 16, 8, buckets=n))  # noqa: B023
        got[n] = sorted(map(repr, out.collect()))
    assert got[None] == got[1] == got[3]
    assert sum("video_id='c'" in r for r in got[3]) == sum("video_id=None" in r for r in got[3]) == 16 and sum("15 of 16" in r for r in got[3]) == 2


def test_payloads_of_any_type_are_kept(spark, tmp_path):
    """Timestamps, decimals, arrays and whole numbers go from batch to batch as they are."""
    schema = "video_id long, frame_idx long, at timestamp, price decimal(10,2), vector array<float>, big long, last boolean"
    batches = [[(v, i, pd.Timestamp(1_700_000_000 + i, unit="s").to_pydatetime(), Decimal(f"{i}.25"), [float(i), 0.5], 2**60 + i, i == 19) for v in (1, 2) for i in range(k, k + 10)] for k in (0, 10)]
    for n in (None, 2):
        where = tmp_path / str(n)
        where.mkdir()
        got = run(spark, where, batches, schema, lambda s: windows.stream_clips(s, 16, 8, buckets=n))  # noqa: B023
        want = {(r[0], r[1], r[2], r[3], r[5]) for b in batches for r in b if r[1] < 16}
        assert {(r.video_id, r.frame_idx, r.at, r.price, r.big) for r in got.collect()} == want
        assert [list(r.vector) for r in got.filter("video_id = 1").orderBy("pos").collect()] == [[float(i), 0.5] for i in range(16)]


def test_videos_of_a_bucket_end_in_their_own_time(spark, tmp_path):
    buckets, group = windows.ClipBuckets(4, 4, ["value"], "value double", idle_ms=100), _Group()
    send = lambda now, *rows: setattr(group, "now", now) or [tuple(r) for f in buckets((0,), iter([pd.DataFrame(rows, columns=["video_id", "frame_idx", "value", "last"])]), group) for r in f.values]
    assert not send(0, (1, 0, 0.5, False), (2, 0, 0.5, False)) and group.timeout == 100
    assert not send(60, (2, 1, 0.5, False)) and group.timeout == 100
    group.hasTimedOut, group.now = True, 101
    assert [r[3] for f in buckets((0,), iter([]), group) for r in f.values] == [0, 0, 0, 0] and group.timeout == 160
    group.now = 160
    assert [r[3] for f in buckets((0,), iter([]), group) for r in f.values] == [0, 1, 1, 1] and group.value is None
    batches = [[frame("short", i, 99) for i in range(3)], [frame("other", i, 20) for i in range(10)], [frame("other", i, 20) for i in range(10, 20)]]
    got = run(spark, tmp_path, batches, FRAME, lambda s: windows.stream_clips(s, 16, 8, 1, 1), True).collect()
    assert [r.frame_idx for r in sorted(got, key=lambda r: r.pos) if r.video_id == "short"] == [0, 1] + [2] * 14


def test_messages_of_a_bucket_share_a_call():
    """as for clips, a call and messages to the state store for each video; idle videos of a bucket still fail on their own."""
    assembly, group = assemble.Assembly(100), _Group()
    rows = lambda *r: iter([pd.DataFrame(r, columns=["video_id", "seq", "kind", "n", "error"])])
    (out,) = assembly((0,), rows(*[(v, s, k, 2, None) for v in range(1000) for s, k in enumerate(("start", "chunk"))]), group)
    assert not len(out) and group.timeout == 100
    group.now = 50
    (out,) = assembly((0,), rows(*[(v, 2, "end", 0, None) for v in range(998)], (998, 2, "chunk", 1, None)), group)
    assert len(out) == 998 and set(out["windows"]) == {2} and group.timeout == 100
    group.now, group.hasTimedOut = 100, True
    assert next(assembly((0,), iter([]), group)).values.tolist() == [[999, "failed", 0, "no end"]] and group.timeout == 150
    group.now = 150
    assert next(assembly((0,), iter([]), group)).values.tolist() == [[998, "failed", 0, "no end"]] and group.value is None
