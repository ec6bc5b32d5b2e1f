"""The extraction jobs: plan, window, encode, verify, store, record.

A run of a shard writes below names of its own, so shards at work side by side, or a run that is started again, never touch
each other's files. What can't be read or encoded fails its video, with a ledger line, and nothing else."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import is_finite
from ..functions.windows import CLIP_FRAMES, CLIP_STRIDE, SAMPLE_RATE
from ..operators.audio import silence_length
from ..operators.encode import Factory, encode_clips, encode_sound, gather_chunks
from ..operators.frames import resize_frames
from ..operators.qa import frame_spans
from ..operators.worklist import existing_ids, first_pending, pending_ids, shard_ids
from ..sources.store import append_ledger, probe_wav, read_features, read_ledger, read_wav, write_features

#: A work list of up to so many ids is sent to every task; a larger one meets the frames or files by a shuffle.
SMALL_LIST = 1_000_000


def work_list(ids: DataFrame, media: DataFrame, done: DataFrame, num_shards: int = 1, shard_id: int = 0, limit: int | None = None, overwrite: bool = False) -> DataFrame:
    """(video_id): those that exist, of this shard, not done, the first few. Sharding comes before the done filter, so a shard stays
    the same when it is started again."""
    mine = shard_ids(existing_ids(ids, media), num_shards, shard_id).select("video_id")
    left = pending_ids(mine, done, overwrite)
    return left if limit is None else first_pending(left, limit)


def _of(rows: DataFrame, work: DataFrame) -> DataFrame:
    ids = work.select("video_id")
    return rows.join(F.broadcast(ids) if ids.count() <= SMALL_LIST else ids, "video_id", "left_semi")


def _store(features: DataFrame, planned: DataFrame, path: str, ledger: str, modality: str, shard_id: int) -> DataFrame:
    """Write what the encoder gave once, below a name of this run; then judge each video by it and record all. The ledger comes last and
    says which of a run's videos readers see: a run that ends before is not read by anyone, and its videos are still pending.

    A video is good if each of its vectors is finite, if its steps count from 0 without a gap or a repeat, and if they are as
    many as planned. ``planned``: (video_id, silent, steps, problem); steps is null where the number isn't known beforehand, and a
    problem is what already speaks against a video."""
    name = f"{time.time_ns():020d}-{shard_id}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/store/run={name}"
    write_features(features, target)
    found = features.sparkSession.read.schema(features.schema).parquet(target)
    good = F.col("error").isNull() & is_finite("feature")
    error = F.min(F.when(F.col("error").isNotNull(), F.struct("step", "error")))["error"]
    count = F.count(F.lit(1))
    per = found.groupBy("video_id").agg(
        count.alias("windows"), F.bool_and(good).alias("good"), error.alias("error"), F.countDistinct("step").alias("steps_there"), F.coalesce(F.max("step") + 1, F.lit(0)).alias("until"),
    )
    plan = planned.groupBy("video_id").agg(F.bool_or("silent").alias("silent"), F.max("steps").alias("steps"), F.min("problem").alias("problem"))
    whole = (F.col("steps_there") == F.col("windows")) & (F.col("until") == F.col("windows")) & (F.col("windows") == F.coalesce("steps", "windows"))
    said = F.concat_ws(" ", "windows", F.lit("windows,"), "steps_there", F.lit("of"), F.greatest("until", "steps"), F.lit("steps"))
    rows = plan.join(per, "video_id", "left").withColumn("error", F.coalesce(
        F.when(F.col("error").isNotNull(), F.col("error")), "problem", F.when(F.col("windows").isNull(), "no windows").when(~F.col("good"), "not finite").when(~whole, said),
    ))
    rows = rows.select(
        "video_id", F.lit(modality).alias("modality"), F.lit(shard_id).alias("shard_id"), F.lit(name).alias("run"),
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "error",
        F.when(F.col("error").isNull(), F.col("windows")).otherwise(F.lit(0)).alias("windows"), "silent",
    )
    status = f"{path}/staging/{name}-status"
    rows.write.parquet(status)
    rows = features.sparkSession.read.schema(rows.schema).parquet(status)
    silent = rows.filter("silent").withColumn("status", F.lit("silent")).withColumn("error", F.lit(None).cast("string")).withColumn("windows", F.lit(0).cast("long"))
    lines = rows.unionByName(silent).drop("silent")
    append_ledger(lines.drop("run"), f"{ledger}/run={name}")
    return lines


def extract_visual(work: DataFrame, frames: DataFrame, factory: Factory, path: str, ledger: str, size: int = 256, num_frames: int = CLIP_FRAMES, stride: int = CLIP_STRIDE, clips_per_chunk: int = 16, shard_id: int = 0, limit: int | None = None) -> DataFrame:
    """Frames of the videos in ``work`` to features; returns the ledger rows of this run.

    The indexes of a video's frames, which are read without their pixels, say how many clips it must give and whether frames are
    missing or repeated, also where no clip would show it: chunks that were lost as a whole, and frames between clips where the
    stride is longer than a clip."""
    mine = _of(frames, work)
    spans = frame_spans(mine, num_frames, stride, limit)
    problem = F.when((F.col("missing") > 0) | (F.col("repeated") > 0) | (F.col("unnumbered") > 0), F.concat_ws(" ", "missing", F.lit("frames missing,"), "repeated", F.lit("repeated,"), "unnumbered", F.lit("without a number")))
    planned = work.select("video_id").join(spans.select("video_id", "steps", problem.alias("problem")), "video_id", "left").withColumn("silent", F.lit(False))
    chunks = gather_chunks(resize_frames(mine, size), num_frames, stride, clips_per_chunk, limit)
    features = encode_clips(chunks, factory, num_frames, stride, clips_per_chunk)
    return _store(features, planned, path, ledger, "visual", shard_id)


def extract_audio(work: DataFrame, files: DataFrame, factory: Factory, path: str, ledger: str, window: int, hop: int, shard_id: int = 0, rate: int = SAMPLE_RATE, block: int = 1 << 16, res_type: str = "kaiser_best") -> DataFrame:
    """WAV files of the videos in ``work`` to features; returns the ledger rows of this run.

    ``files``: (video_id, path, duration), with a null path where a video has no audio track. Headers are read first: videos
    without a track or without samples get silence of their duration, so that their steps match the visual side, and a line
    of status silent besides ok or failed. The other files are read in blocks, and sent once, to the tasks that resample, cut and
    encode them."""
    mine = _of(files.select(F.col("video_id").cast("string").alias("video_id"), "path", "duration"), work.select(F.col("video_id").cast("string")))
    probed = probe_wav(mine.filter("path is not null").select("video_id", "path"))
    staged = f"{path}/staging/{uuid.uuid4().hex}-headers"
    mine.select("video_id", "duration").join(probed, "video_id", "left").write.parquet(staged)
    headers = files.sparkSession.read.parquet(staged)
    empty = F.col("error").isNull() & (F.coalesce("frames", F.lit(0)) == 0)
    sound = read_wav(headers.filter(~empty & F.col("error").isNull()).select("video_id", "path"), block)
    silent = headers.filter(empty).select("video_id", silence_length("duration", rate).alias("total"))
    unread = headers.filter("error is not null").select("video_id", F.lit("audio").alias("modality"), F.lit(0).cast("long").alias("step"), F.lit(None).cast("array<float>").alias("feature"), "error")
    features = encode_sound(sound, factory, window, hop, "sample_rate", rate, silent, res_type).unionByName(unread)
    planned = work.select(F.col("video_id").cast("string")).join(headers.filter(empty).select("video_id", F.lit(True).alias("silent")), "video_id", "left")
    nothing = [F.lit(None).cast("long").alias("steps"), F.lit(None).cast("string").alias("problem")]
    return _store(features, planned.select("video_id", F.coalesce("silent", F.lit(False)).alias("silent"), *nothing), path, ledger, "audio", shard_id)


def summary(lines: DataFrame, seconds: float) -> DataFrame:
    """By shard, from the ledger rows of a run: videos ok, failed and silent, windows, and windows per second of its ``seconds``."""
    of = lambda s: F.count_if(F.col("status") == s)
    per = lines.groupBy("modality", "shard_id").agg(of("ok").alias("n_ok"), of("failed").alias("n_failed"), of("silent").alias("n_silent"), F.sum("windows").alias("windows"))
    return per.withColumn("windows_per_sec", F.try_divide("windows", F.lit(float(seconds))))


def stored(work: DataFrame, path: str, ledger: str) -> DataFrame:
    """The vectors of each video's last good run."""
    return read_features(work.sparkSession, f"{path}/store", read_ledger(work.sparkSession, ledger))
