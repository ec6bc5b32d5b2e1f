"""The check job: a feature store against annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.qa import qa_examples, qa_join, qa_summary, worst_videos


def check(annotations: DataFrame, features: DataFrame, dim: int, fps: int = 16, num_frames: int = 16, stride: int = 8) -> dict[str, DataFrame]:
    """videos (one row each), summary, worst and examples."""
    joined = qa_join(annotations, features, dim, fps, num_frames, stride)
    return {"videos": joined, "summary": qa_summary(joined), "worst": worst_videos(joined), "examples": qa_examples(joined)}
