"""The annotation job: segments to annotations, with what was dropped and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.annotate import build_annotations, drop_reasons, label_ids, label_segments, leaking_videos, ordered_segments, subset_summary, with_both_features, with_outcome


def annotate(segments: DataFrame, media: DataFrame | None, features: DataFrame | None, categories: DataFrame | None, mode: str = "recipe") -> dict[str, DataFrame]:
    """annotations, reasons, summary and leaks (which should be empty: ``check_leaks`` raises if not)."""
    rows = with_outcome(ordered_segments(segments), media, None if features is None else with_both_features(features))
    kept = rows.filter("outcome = 'kept'")
    labelled = label_ids(label_segments(kept, categories, mode))
    return {"annotations": build_annotations(labelled), "reasons": drop_reasons(rows), "summary": subset_summary(labelled), "leaks": leaking_videos(kept)}


def check_leaks(leaks: DataFrame) -> None:
    first = leaks.orderBy("video_id").limit(5).select(F.col("video_id").cast("string")).collect()
    if first:
        raise ValueError(f"videos in more than one subset, such as {[r[0] for r in first]}")
