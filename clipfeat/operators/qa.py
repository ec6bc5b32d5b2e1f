"""Checks of a feature store against annotations.

Features are long rows (video_id, modality, step, feature); they are summed up to a few numbers per video and modality
before anything is joined, so vectors never move."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.vectors import is_finite, l2_norm
from ..functions.windows import expected_steps, num_windows

NORM_STEPS = 50


def feature_norms(features: DataFrame, steps: int = NORM_STEPS) -> DataFrame:
    """(video_id, modality, norm): mean norm of the first steps."""
    return features.filter(F.col("step") < steps).groupBy("video_id", "modality").agg(F.avg(l2_norm("feature")).alias("norm"))


def _contiguous():
    """Steps count from 0 without a gap or a repeat."""
    n = F.count(F.lit(1))
    return F.coalesce((F.min("step") == 0) & (F.max("step") + 1 == n) & (F.countDistinct("step") == n), F.lit(False))


def summarize(features: DataFrame, dim: int, steps: int = NORM_STEPS) -> DataFrame:
    """(video_id, modality, t, bad_shape, finite, contiguous, norm) in one pass over the vectors."""
    return features.groupBy("video_id", "modality").agg(
        F.count(F.lit(1)).alias("t"), F.bool_or(F.coalesce(F.size("feature") != dim, F.lit(True))).alias("bad_shape"), F.bool_and(is_finite("feature")).alias("finite"),
        _contiguous().alias("contiguous"), F.avg(F.when(F.col("step") < steps, l2_norm("feature"))).alias("norm"),
    )


def shape_check(features: DataFrame, dim: int) -> DataFrame:
    """(video_id, bad): true if any vector of any modality has another dimension."""
    return features.groupBy("video_id").agg(F.bool_or(F.coalesce(F.size("feature") != dim, F.lit(True))).alias("bad"))


def finite_check(features: DataFrame) -> DataFrame:
    """(video_id, status): a video with any NaN, infinity or null is failed as a whole."""
    return features.groupBy("video_id").agg(F.when(F.bool_and(is_finite("feature")), "ok").otherwise("failed").alias("status"))


def assembled(features: DataFrame) -> DataFrame:
    """(video_id, modality, t, contiguous): steps count from 0 without a gap or a repeat."""
    return features.groupBy("video_id", "modality").agg(F.count(F.lit(1)).alias("t"), _contiguous().alias("contiguous"))


def frame_spans(frames: DataFrame, num_frames: int, stride: int, limit: int | None = None) -> DataFrame:
    """(video_id, frames, missing, repeated, unnumbered, steps): what there is of each video, from the indexes of its frames alone,
    and the clips that a whole video of that length gives. Frames beyond the last clip of a ``limit`` don't count.

    Indexes are counted one by one, so that a repeated frame can't stand in for a missing one; no pixel is read."""
    index = F.col("frame_idx")
    rows = frames.select("video_id", "frame_idx").filter("video_id is not null")
    if limit is not None:
        rows = rows.filter(index.isNull() | (index < (limit - 1) * stride + num_frames))
    rows = rows.groupBy("video_id", "frame_idx").agg(F.count(F.lit(1)).alias("n"))
    known = index.isNotNull()
    per = rows.groupBy("video_id").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("frames"), F.count_if(known & (index >= 0)).alias("_there"), F.coalesce(F.max("frame_idx") + 1, F.lit(0)).alias("_length"),
        F.coalesce(F.sum(F.when(~known | (index < 0), F.col("n"))), F.lit(0)).alias("unnumbered"), F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("repeated"),
    )
    n = num_windows("_length", num_frames, stride)
    n = n if limit is None else F.least(n, F.lit(limit).cast("long"))
    return per.select("video_id", "frames", (F.greatest(F.lit(0), F.col("_length")) - F.col("_there")).alias("missing"), "repeated", "unnumbered", F.when(F.col("_length") > 0, n).otherwise(F.lit(0)).alias("steps"))


def count_features(features: DataFrame) -> DataFrame:
    return features.groupBy("modality").agg(F.countDistinct("video_id").alias("videos"))


def qa_join(annotations: DataFrame, features: DataFrame, dim: int, fps: int = 16, num_frames: int = 16, stride: int = 8) -> DataFrame:
    """(video_id, status, t_visual, t_audio, expected, norm_visual, norm_audio, deviation), one row per annotated video;
    status: missing if a modality is absent, bad if a shape is wrong, else valid. deviation is in seconds."""
    s = summarize(features, dim)
    side = lambda m: s.filter(F.col("modality") == m).select("video_id", *[F.col(c).alias(f"{c}_{m}") for c in ("t", "bad_shape", "norm")])
    rows = annotations.select("video_id", "duration").join(side("visual"), "video_id", "left").join(side("audio"), "video_id", "left")
    rows = rows.withColumn("expected", expected_steps("duration", fps, num_frames, stride))
    status = F.when(F.col("t_visual").isNull() | F.col("t_audio").isNull(), "missing").when(F.col("bad_shape_visual") | F.col("bad_shape_audio"), "bad").otherwise("valid")
    deviation = F.abs(F.least("t_visual", "t_audio") - F.col("expected")) * (stride / fps)
    rows = rows.withColumn("status", status).withColumn("deviation", F.when(F.col("status") == "valid", deviation))
    return rows.select("video_id", "status", "t_visual", "t_audio", "expected", "norm_visual", "norm_audio", "deviation")


def qa_summary(joined: DataFrame) -> DataFrame:
    valid = F.col("status") == "valid"
    apart = F.when(valid, F.abs(F.col("t_visual") - F.col("t_audio")))
    return joined.agg(
        F.count(F.lit(1)).alias("annotated"), F.count_if(valid).alias("valid"), F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status") == "bad").alias("bad"),
        F.avg(apart).alias("mean_apart"), F.max(apart).alias("max_apart"), F.avg("deviation").alias("mean_deviation"), F.max("deviation").alias("max_deviation"),
        F.avg(F.when(valid, F.col("norm_visual"))).alias("norm_visual"), F.avg(F.when(valid, F.col("norm_audio"))).alias("norm_audio"),
    )


def worst_videos(joined: DataFrame, n: int = 5) -> DataFrame:
    return joined.filter("status = 'valid'").select("video_id", "deviation").orderBy(F.desc("deviation"), "video_id").limit(n)


def qa_examples(joined: DataFrame, most: dict[str, int] | None = None) -> DataFrame:
    """(status, pos, video_id): the first ids of each status that is not valid. For each status every task sends its first few."""
    parts = []
    for status, n in (most or {"missing": 10, "bad": 5}).items():
        first = joined.filter(F.col("status") == status).select("status", "video_id").orderBy("video_id").limit(n)
        parts.append(first.select("status", F.row_number().over(W.partitionBy("status").orderBy("video_id")).alias("pos"), "video_id"))
    return reduce(DataFrame.unionByName, parts)


def storage_budget(videos: DataFrame, strides: tuple[int, ...] = (4, 8), num_frames: int = 16, dim: int = 1536) -> DataFrame:
    """(stride, clips, bytes) over a corpus of (video_id, total frames): one row of each video per stride, summed in place."""
    rows = videos.select("total", F.explode(F.array(*[F.lit(s) for s in strides])).alias("stride"))
    n = F.greatest(F.lit(0), F.floor((F.col("total") - num_frames) / F.col("stride"))) + 1
    return rows.groupBy("stride").agg(F.sum(n).cast("long").alias("clips")).withColumn("bytes", F.col("clips") * dim * 4)
