"""What work costs as inputs grow: frames that tasks send, and tasks that share the work."""

import wave

import numpy as np
import pandas as pd


def test_short_sound_files_share_frames(tmp_path):
    """one frame of rows for each block made the time of reading that of building frames."""
    from clipfeat.sources.store import _wav_blocks

    paths = []
    for k in range(200):
        with wave.open(str(tmp_path / f"{k}.wav"), "wb") as w:
            w.setnchannels(2)
            w.setsampwidth(2)
            w.setframerate(8000)
            w.writeframes(np.full(2 * (k % 30), k, "<i2").tobytes())
        paths.append(str(tmp_path / f"{k}.wav"))
    (tmp_path / "broken.wav").write_bytes(b"no sound")
    files = pd.DataFrame({"video_id": [str(k) for k in range(200)] + ["broken"], "path": [*paths, str(tmp_path / "broken.wav")]})
    frames = list(_wav_blocks([files], 10))
    rows = pd.concat(frames)
    assert len(frames) == 1
    assert len(rows) == sum(-(-(k % 30) // 10) for k in range(200)) + 1
    assert rows.groupby("video_id")["samples"].apply(lambda x: sum(len(v) for v in x if v is not None)).to_dict() == {str(k): k % 30 for k in range(200) if k % 30} | {"broken": 0}
    assert rows["error"].notna().sum() == 1
    assert max(len(f) for f in _wav_blocks([pd.concat([files] * 30)], 10)) <= 2048


def test_small_files_are_listed_by_many_tasks(spark, tmp_path):
    """all files in one folder were listed by one task."""
    from pyspark.sql import functions as F

    from clipfeat.queries.sources import FOLDERS, _touch
    from clipfeat.sources import media

    rows = spark.range(300).select(F.concat((F.col("id") % FOLDERS).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("name"), F.lit(b"x").alias("data"))
    assert _touch(rows, f"file://{tmp_path}/f") == 300
    files = media.list_files(spark, *[f"file://{tmp_path}/f/{k}" for k in range(FOLDERS)])
    assert files.count() == 300 and files.rdd.getNumPartitions() == FOLDERS


def test_small_groups_share_frames():
    """one frame for each chunk of frames made the time of encoding that of building frames; resizing sent 16 frames at a time."""
    from clipfeat.operators.frames import _resized
    from clipfeat.operators.groups import gathered, sorted_groups

    pdf = pd.DataFrame({"k": np.repeat(np.arange(400), 3), "v": np.arange(1200)})
    groups = list(sorted_groups([pdf[:500], pdf[500:]], ["k"]))
    assert [g[0][0] for g in groups] == list(range(400)) and all(g["v"].tolist() == [3 * k, 3 * k + 1, 3 * k + 2] for (k,), g in groups)
    frames = list(gathered((([k[0]] * 3, g["v"]) for k, g in groups), ["k", "v"]))
    assert len(frames) == 3 and pd.concat(frames, ignore_index=True).equals(pdf)
    pixels = [bytes([k % 256] * 12) for k in range(999)] + [b"short"]
    rows = pd.DataFrame({"frame_idx": np.arange(1000), "height": 2, "width": 2, "pixels": pixels})
    (out,) = _resized([rows], 2, "round")
    assert out["pixels"].tolist() == [*pixels[:-1], None]
    assert len(list(_resized([rows.assign(height=4, width=1)], 1024, "round"))) == 1000


def test_ranges_of_a_document_are_shared(spark, tmp_path):
    """rows that name ranges are so short that Spark joined their partitions, and one task read the whole document."""
    from pyspark.sql import functions as F

    from clipfeat.sources import documents

    (tmp_path / "d.json").write_text('{"database":{' + ",".join(f'"k{k}":{{"a":{k}}}' for k in range(500)) + "}}")
    ranges, tasks = documents._ranges(spark, (str(tmp_path / "d.json"),), 64)
    assert tasks == spark.sparkContext.defaultParallelism
    assert ranges.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert documents._tasks(spark, 100 * documents.TASK_BYTES, 10_000) == 100
    assert documents.document_entries(spark, str(tmp_path / "d.json"), range_bytes=64).count() == 500


def test_tasks_grow_with_the_rows(spark, sf_dir):
    """the session's number of shuffle partitions, whatever the input, settled how much a task sorts; all of a label met in one task."""
    from clipfeat.operators import annotate
    from clipfeat.queries import standins

    assert standins.by_key(spark.range(10), 40 * standins.TASK_ROWS, "id").rdd.getNumPartitions() == 40
    s = annotate.ordered_segments(standins.segments(spark, sf_dir)).withColumn("label", standins.F.col("recipe_type"))
    plan = annotate.build_annotations(annotate.label_ids(annotate.clamp_segments(s)))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(video_id" not in plan and "SortMergeJoin [coalesce(label" not in plan


def _tone(n, k):
    return [float(np.float32(np.sin(i * (k + 1) / 50))) for i in range(n)]


def test_windows_are_made_where_they_are_encoded(spark):
    """samples were shuffled twice, and windows, of many times the bytes, went from task to task's Python and back twice. The same vectors,
    with one shuffle and one Python step, at any rate, however blocks are cut, with silence that sends no zeros."""
    from pyspark.sql import functions as F

    from clipfeat.operators import audio, encode

    rows, silent = [], [("z", 1234), ("y", 57), ("x", 0)]
    for k, (rate, n, block) in enumerate([(8000, 3000, 700), (22050, 2500, 4096), (16000, 1500, 100), (48000, 40, 64), (None, 300, 1 << 16)]):
        x = _tone(n, k)
        rows += [(str(k), b, b * block, rate, x[b * block : (b + 1) * block], None) for b in range(-(-n // block))]
    rows += [("bad", 0, 0, 8000, _tone(500, 9), None), ("bad", 1, 500, 8000, None, "broken"), ("gap", 0, 0, 8000, _tone(500, 9), None), ("gap", 2, 1000, 8000, _tone(500, 9), None)]
    rows += [("late", 1, 900, 8000, _tone(500, 9), None), ("lost", 0, 0, None, None, "no file")]
    blocks = spark.createDataFrame(rows, "video_id string, block_id int, sample_offset long, sample_rate int, samples array<float>, error string")
    still = spark.createDataFrame(silent, "video_id string, total long")
    encoder = encode.projection_encoder(8)
    got = encode.encode_sound(blocks, encoder, 160, 80, "sample_rate", silent=still)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInPandas") == 1
    zeros = audio.silence_fallback(still.select("video_id", (F.col("total") / 16000.0).alias("duration"), F.lit(False).alias("has_audio")), block=100)
    waves = audio.resample_blocks(blocks, "sample_rate").unionByName(zeros.drop("silent").withColumn("error", F.lit(None).cast("string")))
    want = encode.encode_audio(audio.audio_windows(waves, 160, 80), encoder)
    got, want = ({(r.video_id, r.step): r for r in df.collect()} for df in (got, want))
    whole = {k for k in want if k[0] not in ("bad", "gap", "late", "lost")}
    assert whole == {k for k in got if k[0] not in ("bad", "gap", "late", "lost")} and len(whole) == 130
    assert all(np.allclose(got[k].feature, want[k].feature, atol=1e-5) and got[k].error is None for k in whole)
    failed = {v: {r.error for (x, _), r in got.items() if x == v and r.error} for v in ("bad", "gap", "late", "lost")}
    assert failed == {"bad": {"broken"}, "gap": {"blocks are missing or repeated"}, "late": {"blocks are missing or repeated"}, "lost": {"no file"}}
