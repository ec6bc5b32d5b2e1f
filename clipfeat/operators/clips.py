"""Windows over ordered items: clips, chunks of clips, batches, constant frame rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.windows import num_windows


def clip_counts(frames: DataFrame, num_frames: int, stride: int, id_col: str = "video_id") -> DataFrame:
    """(id, total, n_clips) of the frames that are there; ids without frames have no row."""
    return frames.groupBy(id_col).agg(F.count(F.lit(1)).alias("total")).withColumn("n_clips", num_windows("total", num_frames, stride))


def clip_windows(frames: DataFrame, num_frames: int, stride: int, id_col: str = "video_id") -> DataFrame:
    """(id, clip_idx, pos, frame_idx): the frames of each clip.

    Frame indexes must be 0, 1, 2, ... Each frame is sent to the complete windows that hold it; a video shorter than a window
    gives one clip in which its last frame is repeated. Nothing is compared pairwise."""
    totals = clip_counts(frames, num_frames, stride, id_col)
    rows = frames.select(id_col, "frame_idx").join(totals, id_col)
    f = F.col("frame_idx")
    low = F.greatest(F.lit(0), F.ceil((f - (num_frames - 1)) / stride)).cast("long")
    high = F.least(F.col("n_clips") - 1, F.floor(f / stride)).cast("long")
    rows = rows.filter(low <= high).withColumn("clip_idx", F.explode(F.sequence(low, high)))
    rows = rows.withColumn("first", f - F.col("clip_idx") * stride)
    last = (F.col("total") < num_frames) & (f == F.col("total") - 1)
    until = F.when(last, F.lit(num_frames - 1).cast("long")).otherwise(F.col("first"))
    return rows.select(id_col, "clip_idx", F.explode(F.sequence(F.col("first"), until)).alias("pos"), "frame_idx")


def chunk_plan(videos: DataFrame, num_frames: int, stride: int, clips_per_chunk: int, limit: int | None = None, id_col: str = "video_id") -> DataFrame:
    """(id, chunk_id, first_clip, n_clips, first_frame, n_frames) from (id, total): blocks of frames that hold several clips,
    so that the frames two clips share are moved once. Videos without frames give no chunk."""
    n = num_windows("total", num_frames, stride)
    n = n if limit is None else F.least(n, F.lit(limit).cast("long"))
    rows = videos.filter("total > 0").withColumn("_n", n).filter("_n > 0")
    rows = rows.withColumn("first_clip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(clips_per_chunk).cast("long"))))
    rows = rows.withColumn("n_clips", F.least(F.lit(clips_per_chunk).cast("long"), F.col("_n") - F.col("first_clip")))
    first = F.col("first_clip") * stride
    return rows.select(
        id_col, (F.col("first_clip") / clips_per_chunk).cast("long").alias("chunk_id"), "first_clip", "n_clips", first.alias("first_frame"),
        F.least((F.col("n_clips") - 1) * stride + num_frames, F.col("total") - first).alias("n_frames"),
    )


def batches(items: DataFrame, size: int, order: list[Column | str], id_col: str = "video_id", limit: int | None = None) -> DataFrame:
    """``items`` with batch_id and pos, in the given order within each id; at most ``limit`` items of an id."""
    rows = items.withColumn("_n", F.row_number().over(W.partitionBy(id_col).orderBy(*order)) - 1)
    if limit is not None:
        rows = rows.filter(F.col("_n") < limit)
    return rows.withColumn("batch_id", F.floor(F.col("_n") / size).cast("long")).withColumn("pos", (F.col("_n") % size).cast("long")).drop("_n")


def first_clips(clips: DataFrame, max_clips: int) -> DataFrame:
    return clips.filter(F.col("clip_idx") < max_clips)


def trim_frames(frames: DataFrame, start_sec: float, fps: int) -> DataFrame:
    """Frames from ``start_sec`` on, numbered anew."""
    skip = int(start_sec * fps)
    return frames.filter(F.col("frame_idx") >= skip).withColumn("frame_idx", F.col("frame_idx") - skip)


def cut_range(frames: DataFrame, start_sec: float, length_sec: float, fps: int) -> DataFrame:
    """Frames of [start, start + length), exact to the frame, numbered anew."""
    return trim_frames(frames.filter(F.col("frame_idx") < int((start_sec + length_sec) * fps)), start_sec, fps)


def cut_seconds(frames: DataFrame, start_sec: float, length_sec: float, pts: str = "pts", id_col: str = "video_id") -> DataFrame:
    """Frames shown in [start, start + length) seconds after the first one by their time stamps, whatever the rate, numbered anew from
    the first of them; stamps need not be even. Frames without a stamp are left out."""
    begin = frames.groupBy(id_col).agg(F.min(pts).alias("_t0"))
    rows = frames.join(begin, id_col).filter((F.col(pts) >= F.col("_t0") + start_sec) & (F.col(pts) < F.col("_t0") + start_sec + length_sec)).drop("_t0")
    first = rows.groupBy(id_col).agg(F.min("frame_idx").alias("_first"))
    return rows.join(first, id_col).withColumn("frame_idx", F.col("frame_idx") - F.col("_first")).drop("_first")


def resample_fps(frames: DataFrame, fps: float, pts: str = "pts", id_col: str = "video_id", index: str = "frame_idx") -> DataFrame:
    """Frames at a constant rate: (id, tick, <the other columns>).

    A source frame's tick is its time since the first one times the rate, rounded; an output tick shows the latest source
    frame at or before it, so frames are dropped or repeated. Which frame each tick shows is settled on (id, index, time) alone;
    pixels then meet the ticks by (id, index), in one shuffle, so a long video is many tasks' work. Frames are known by
    their id and index, which must be unique."""
    per = W.partitionBy(id_col)
    rows = frames.select(id_col, index, pts).withColumn("tick", F.floor((F.col(pts) - F.min(pts).over(per)) * fps + 0.5).cast("long"))
    rows = rows.groupBy(id_col, "tick").agg(F.max_by(index, F.struct(pts, index)).alias(index))
    following = F.lead("tick").over(per.orderBy("tick"))
    shown = rows.withColumn("_to", F.coalesce(following - 1, F.col("tick")))
    kept = [c for c in frames.columns if c != id_col]
    return frames.join(shown, [id_col, index]).select(id_col, F.explode(F.sequence("tick", "_to")).alias("tick"), *kept)
