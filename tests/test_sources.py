"""Sinks and listings with a protocol of their own."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipfeat.sources import media, npy, store


def features(spark, videos=12, steps=5):
    rows = spark.range(videos * steps).select((F.col("id") % videos).cast("string").alias("video_id"), F.lit("audio").alias("modality"), F.floor(F.col("id") / videos).alias("step"))
    return rows.withColumn("feature", F.array(F.col("step") / 2, F.col("video_id").cast("double"), F.lit(0.25)))


def seen(path):
    return sorted(f for f in os.listdir(path)) if os.path.isdir(path) else []


def test_npy_files(spark, tmp_path):
    npy.write_npy(features(spark), f"file://{tmp_path}")
    assert seen(tmp_path) == sorted(f"{v}_one_peace_audio.npy" for v in range(12))
    m = np.load(tmp_path / "7_one_peace_audio.npy")
    assert m.dtype == np.float32 and m.tolist() == [[s / 2, 7.0, 0.25] for s in range(5)]
    npy.write_npy(features(spark, 3, 2), str(tmp_path))
    assert len(seen(tmp_path)) == 12 and len(np.load(tmp_path / "2_one_peace_audio.npy")) == 2 and len(np.load(tmp_path / "3_one_peace_audio.npy")) == 5
    (tmp_path / "notes.txt").write_text("mine")
    npy.write_npy(features(spark, 4, 1), str(tmp_path), overwrite=True)
    assert seen(tmp_path) == [*(f"{v}_one_peace_audio.npy" for v in range(4)), "notes.txt"]
    npy.write_npy(features(spark).limit(0), str(tmp_path))
    assert len(seen(tmp_path)) == 5


@pytest.mark.parametrize("what", ["task", "gap", "suffix"])
def test_a_failed_export_shows_nothing(spark, tmp_path, what):
    f = features(spark)
    bad = {
        "task": f.withColumn("feature", F.when((F.col("video_id") == "9") & (F.col("step") == 3), F.raise_error(F.lit("no")).cast("array<double>")).otherwise(F.col("feature"))),
        "gap": f.filter("not (video_id = '5' and step = 2)"),
        "suffix": f.withColumn("modality", F.when(F.col("video_id") == "5", "smell").otherwise("audio")),
    }[what]
    npy.write_npy(features(spark, 2, 1), str(tmp_path))
    with pytest.raises(Exception, match="no|step|file name"):
        npy.write_npy(bad, str(tmp_path))
    assert seen(tmp_path) == ["0_one_peace_audio.npy", "1_one_peace_audio.npy"]


def test_attempts_that_ran_twice(spark, tmp_path):
    """Of two attempts of a task the message that is committed counts; what the other left goes."""
    writer = npy.NpyWriter({"path": str(tmp_path)}, False)
    rows = features(spark, 3, 2).orderBy("video_id", "step").withColumn("feature", F.col("feature").cast("array<float>")).toArrow().to_batches()
    first, second = writer.write(iter(rows)), writer.write(iter(rows))
    assert seen(tmp_path) == [os.path.basename(writer.staging)]
    writer.commit([second, None])
    assert len(first.files) == 3 and seen(tmp_path) == [f"{v}_one_peace_audio.npy" for v in range(3)]
    other = npy.NpyWriter({"path": str(tmp_path)}, False)
    a, b = other.write(iter(rows)), other.write(iter(rows))
    with pytest.raises(ValueError, match="two tasks"):
        other.commit([a, b])
    assert len(seen(tmp_path)) == 3


def test_read_back_what_was_written(spark, tmp_path):
    npy.write_npy(features(spark), str(tmp_path))
    back = store.read_features_npy(media.list_files(spark, str(tmp_path)).select("name", "path"), tasks=3).drop("error")
    assert back.exceptAll(features(spark).withColumn("feature", F.col("feature").cast("array<float>"))).isEmpty() and back.count() == 60


def test_filters_go_to_the_listing(spark, tmp_path):
    for n in ("_a.mp4", "_b.wav", "c.mp4"):
        (tmp_path / n).write_text(n)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = media.list_files(spark, str(tmp_path)).filter(F.col("name").startswith("_") & F.col("name").endswith(".mp4") & (F.col("length") > 1))
        assert [r["name"] for r in df.collect()] == ["_a.mp4"]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "StartsWith" not in plan.split("PythonScan")[0].split("BatchScan")[0] or "PushedFilters" in plan
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert [r["name"] for r in media.list_files(spark, str(tmp_path), prefix="_", ext=".wav").collect()] == ["_b.wav"]


def test_files_that_come_later_come_once(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()

    def run(settle=0):
        media.stream_files(spark, str(src), ext=".mp4", settle=settle).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["name"] for r in spark.read.parquet(out).collect()) if seen(out) else []

    for n in ("_a.mp4", "b.mp4", "no.txt"):
        (src / n).write_text(n)
    assert run() == ["_a.mp4", "b.mp4"]
    assert run() == ["_a.mp4", "b.mp4"]
    same = os.stat(src / "b.mp4").st_mtime_ns
    (src / "c.mp4").write_text("c")
    os.utime(src / "c.mp4", ns=(same, same))
    (src / "-d.mp4").write_text("d")
    assert run() == ["-d.mp4", "_a.mp4", "b.mp4", "c.mp4"]
    (src / "young.mp4").write_text("y")
    assert "young.mp4" not in run(settle=30)
    time.sleep(0.05)
    assert "young.mp4" in run()
