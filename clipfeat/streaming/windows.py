"""Clips from frames that arrive one after another."""

from __future__ import annotations

import pickle
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: Rows that are sent on at once.
_ROWS = 4096


class _Value:
    """The state of a video as one value, (next clip, frames); frames are bytes, whatever their payload."""

    def __init__(self, group: GroupState):
        self.group = group

    def get(self):
        got = self.group.getOption
        return (got[0], pickle.loads(got[1])) if got else None

    def update(self, value) -> None:
        self.group.update((value[0], pickle.dumps(value[1])))

    def clear(self) -> None:
        self.group.remove()


class ClipBuffer:
    """Keeps a video's frames from the start of its next clip on, by their indexes, and sends a clip when all its frames are there.

    A row with ``last = true`` ends the video, with or without a frame of its own: a video too short for a clip then gives one,
    its last frame repeated. Frames of a video come in order from batch to batch, in any order within one; a frame that comes
    twice counts once, and frames of clips that were sent already are left out. A clip of which frames have not come when a batch
    has brought later ones gives one row with an error, and the clips after it go on; so does a row without an index, which
    belongs to no clip. With ``idle_ms`` a video from which nothing has come for that long ends as if its last frame were there.

    Frames are looked up by index and dropped by range, once each, so a batch takes time in proportion to its frames, and clips
    are sent while the batch is read: what is held is what no complete clip could use yet. Between batches that is at most a clip
    and a stride, and it is one value of the state, read and written once a batch: a state entry for each frame would
    be a message to the state store for each frame.

    Values come and go with the rows, in frames that many videos share. With a stateful processor each video's batch would be some
    messages to the state store and a frame of its own."""

    def __init__(self, num_frames: int, stride: int, names: list[str], payload: str, idle_ms: int | None = None):
        self.num_frames, self.stride, self.names, self.payload, self.idle_ms = num_frames, stride, names, payload, idle_ms
        self.state = None

    def __call__(self, key, rows, group: GroupState):
        """The function of ``applyInPandasWithState``."""
        one = ClipBuffer(self.num_frames, self.stride, self.names, self.payload, self.idle_ms)
        one.state = _Value(group)
        return one.handleInputRows(key, rows, group)

    def _held(self) -> tuple[int, dict]:
        got = self.state.get()
        return (got[0], {f[0]: tuple(f)[1:] for f in got[1]}) if got else (0, {})

    def _send(self, video, clip: int, frames: dict, until: int | None = None):
        """Rows of the clips that are complete, one after another; with ``until`` also an error for each one that ends before that
        frame and isn't. Returns the next clip."""
        none = (None,) * len(self.names)
        while True:
            first = clip * self.stride
            indexes = range(first, first + self.num_frames)
            if all(i in frames for i in indexes):
                for p, i in enumerate(indexes):
                    yield (video, clip, p, i, *frames[i], None)
            elif until is not None and first + self.num_frames <= until:
                yield (video, clip, None, None, *none, f"{sum(i in frames for i in indexes)} of {self.num_frames} frames")
            else:
                return clip
            for i in range(first, first + self.stride):
                frames.pop(i, None)
            clip += 1

    def _end(self, video, clip: int, frames: dict):
        """The clip of a video that ends before it has one."""
        if not clip and frames:
            there = sorted(frames)
            for p, i in enumerate(there + [there[-1]] * (self.num_frames - len(there))):
                yield (video, 0, p, i, *frames[i], None)

    def _feed(self, video, one: list, columns: list[list]):
        """Rows of the clips that are complete with more frames of a video; ``one`` is its (next clip, frames, end, whether it ended)."""
        clip, frames, until, last = one
        for i, end, *payload in zip(*columns, strict=True):
            last |= end is not None and bool(end)
            if i is None or i != i:
                if not end:
                    yield (video, None, None, None, *(None,) * len(self.names), "a frame without an index")
                continue
            i = int(i)
            until = max(until, i + 1)
            if i >= clip * self.stride:
                frames.setdefault(i, tuple(payload))
        one[:] = (yield from self._send(video, clip, frames)), frames, until, last

    def _settle(self, video, one: list):
        """What is left to say of a video when a batch has been read."""
        one[0] = yield from self._send(video, one[0], one[1], one[2])
        if one[3]:
            yield from self._end(video, one[0], one[1])

    def _opened(self, clip: int, frames: dict) -> list:
        return [clip, frames, max(frames, default=-1) + 1, False]

    def _all(self, video, rows):
        one = self._opened(*self._held())
        for pdf in rows:
            yield from self._feed(video, one, [pdf[c].tolist() for c in ("frame_idx", "last", *self.names)])
        yield from self._settle(video, one)
        clip, frames, _, last = one
        if last:
            self.state.clear()
        else:
            self.state.update((clip, [(i, *frames[i]) for i in sorted(frames)]))
        return last

    def _frames(self, rows):
        """Rows as frames of some thousand; returns what the rows return."""
        names, out, done = ["video_id", "clip_idx", "pos", "frame_idx", *self.names, "error"], [], None
        while True:
            try:
                out.append(next(rows))
            except StopIteration as e:
                done = e.value
                break
            if len(out) >= _ROWS:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)
        return done

    def handleInputRows(self, key, rows, group: GroupState | None):
        if group is not None and group.hasTimedOut:
            yield from self._frames(self._end(key[0], *self._held()))
            self.state.clear()
            return
        last = yield from self._frames(self._all(key[0], rows))
        if self.idle_ms is not None and not last:
            group.setTimeoutDuration(self.idle_ms)


class ClipBuckets(ClipBuffer):
    """``ClipBuffer`` for many videos in one value of the state: the videos of a bucket share calls, frames and state, which for short
    videos are most of the time. A batch reads and writes the state of all open videos of the buckets that it has frames for."""

    def __call__(self, key, rows, group: GroupState):
        return self._frames(self._bucket(rows, group))

    def _bucket(self, rows, group: GroupState):
        now, idle = group.getCurrentProcessingTimeMs(), self.idle_ms
        held = pickle.loads(group.get[0]) if group.exists else {}  # by video: next clip, frames, when it last sent something
        there: dict = {}
        for pdf in () if group.hasTimedOut else rows:
            codes, videos = pd.factorize(pdf["video_id"], use_na_sentinel=False)
            order = np.argsort(codes, kind="stable")
            columns = [pdf[c].take(order).tolist() for c in ("frame_idx", "last", *self.names)]
            cuts = [0, *np.cumsum(np.bincount(codes)).tolist()]
            for video, (a, b) in zip(videos.tolist(), pairwise(cuts), strict=True):
                video = None if video != video else video
                if video not in there:
                    there[video] = self._opened(*held.get(video, (0, {}, now))[:2])
                yield from self._feed(video, there[video], [c[a:b] for c in columns])
        for video, one in there.items():
            yield from self._settle(video, one)
            held[video] = (one[0], one[1], now)
            if one[3]:
                del held[video]
        if idle is not None:
            for video in [v for v, (_, _, seen) in held.items() if seen + idle <= now]:
                clip, frames, _ = held.pop(video)
                yield from self._end(video, clip, frames)
        if not held:
            group.remove()
            return
        group.update((pickle.dumps(held),))
        if idle is not None:
            group.setTimeoutDuration(max(1, min(seen for _, _, seen in held.values()) + idle - now))


def stream_clips(frames: DataFrame, num_frames: int, stride: int, idle_ms: int | None = None, buckets: int | None = None) -> DataFrame:
    """(video_id, clip_idx, pos, frame_idx, <the other columns>, error) from a stream of (video_id, frame_idx, last, ...); pixels or
    whatever else a frame holds go along.

    With ``buckets`` the state of videos is kept in so many buckets: for many short videos whose frames hold little. A bucket's open
    videos must fit in a task, a clip and a stride of each. Without, each video has its own."""
    kinds = {f.name: f.dataType.simpleString() for f in frames.schema if f.name not in ("video_id", "frame_idx", "last")}
    payload = ", ".join(f"`{c}` {k}" for c, k in kinds.items())
    kind, state, keys, rows = ClipBuffer, "next_clip long, frames binary", ["video_id"], frames
    if buckets is not None:
        kind, state, keys = ClipBuckets, "videos binary", ["_bucket"]
        rows = frames.withColumn("_bucket", F.when(F.col("video_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("video_id"), F.lit(buckets))))
    return rows.groupBy(*keys).applyInPandasWithState(
        kind(num_frames, stride, list(kinds), payload, idle_ms),
        outputStructType=f"video_id {frames.schema['video_id'].dataType.simpleString()}, clip_idx long, pos long, frame_idx long, {payload}, error string",
        stateStructType=state, outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def event_time_clips(frames: DataFrame, window: str, slide: str, num_frames: int, delay: str) -> DataFrame:
    """(video_id, start, n, mean) of complete sliding windows by event time (ts, value); frames later than ``delay`` are dropped.
    Windows at the edges that hold fewer frames are left out."""
    rows = frames.withWatermark("ts", delay).groupBy("video_id", F.window("ts", window, slide).alias("w"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")).filter(F.col("n") == num_frames).select("video_id", F.col("w.start").alias("start"), "n", "mean")
