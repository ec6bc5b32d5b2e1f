"""The feature store, its ledgers, and readers of feature and sound files.

A file that can't be read is a row with its error, and all other files are read."""

from __future__ import annotations

import io
import uuid
import warnings
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import SUFFIXES, parse_feature_name, stem

#: Samples and rows of sound that a reading task holds before it sends them on.
_HELD_SAMPLES, _HELD_ROWS = 1 << 18, 2048
FEATURES = "video_id string, modality string, step long, feature array<float>"


def _filesystem(path: str):
    from pyarrow import fs as pafs

    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write_features(features: DataFrame, path: str, mode: str = "append") -> None:
    """Long rows as Parquet, a folder per modality; a failed write leaves nothing that a reader sees. Writers at work at the same
    time need a folder each, such as ``<path>/run=<name>``; the run is then a column for who reads ``path``."""
    features.write.mode(mode).partitionBy("modality").parquet(path)


def read_features(spark: SparkSession, path: str, ledger: DataFrame | None = None) -> DataFrame:
    """All vectors below ``path``; with a ledger (of ``read_ledger``) those of each video's last ok run alone.

    A run that the ledger does not name was cut off before its end and is left out; so is what a run holds of videos that failed in
    it. Only these and what was replaced, which is little, and the names of runs are joined to the vectors."""
    rows = spark.read.parquet(path)
    if "error" in rows.columns:
        rows = rows.filter("error is null").drop("error")
    if ledger is None:
        return rows
    ok = ledger.filter("status = 'ok'").select("video_id", "modality", "run").distinct()
    last = ok.groupBy("video_id", "modality").agg(F.max("run").alias("last"))
    replaced = ok.join(last, ["video_id", "modality"]).filter("run < last").drop("last")
    failed = ledger.filter("status = 'failed'").select("video_id", "modality", "run").distinct()
    rows = rows.withColumn("run", F.col("run").cast("string"))
    named = ledger.select("run").distinct()
    return rows.join(named, "run", "left_semi").join(replaced.unionByName(failed), ["video_id", "modality", "run"], "left_anti")


def read_features_npy(files: DataFrame, tasks: int = 64) -> DataFrame:
    """Long rows of the matrices in ``files`` (name, path), float32 or float64, and error; names without a known suffix are left
    out. A file that holds no two-dimensional matrix of numbers gives one row with its error."""

    def run(batches):
        for pdf in batches:
            for video, modality, path in pdf.itertuples(index=False, name=None):
                try:
                    fs, p = _filesystem(path)
                    with fs.open_input_file(p) as f:
                        m = np.load(io.BytesIO(f.read()), allow_pickle=False)
                    if m.ndim != 2 or m.dtype.kind != "f":
                        raise ValueError(f"{m.ndim} dimensions of {m.dtype}")
                    m = m.astype(np.float32)
                    yield pd.DataFrame({"video_id": video, "modality": modality, "step": np.arange(len(m)), "feature": list(m), "error": None})
                except (OSError, ValueError, EOFError) as e:
                    yield pd.DataFrame({"video_id": [video], "modality": [modality], "step": [None], "feature": [None], "error": [repr(e)]}).astype({"step": "Int64"})

    named = files.withColumn("p", parse_feature_name("name")).filter("p.video_id is not null").select("p.video_id", "p.modality", "path")
    return named.repartition(tasks, "path").mapInPandas(run, FEATURES + ", error string")


def export_npy(features: DataFrame, directory: str) -> DataFrame:
    """Write a .npy file per video and modality, under a temporary name first; returns (video_id, modality, path, steps).
    A task holds one matrix, which is what the file format needs."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step")
        video, modality = pdf["video_id"].iloc[0], pdf["modality"].iloc[0]
        fs, base = _filesystem(directory)
        fs.create_dir(base, recursive=True)
        out = io.BytesIO()
        np.save(out, np.stack([np.asarray(v, np.float32) for v in pdf["feature"]]))
        path = f"{base}/{video}{SUFFIXES[modality]}"
        with fs.open_output_stream(part := f"{path}.{uuid.uuid4().hex}.tmp.npy", compression=None) as f:
            f.write(out.getvalue())
        fs.move(part, path)
        return pd.DataFrame({"video_id": [video], "modality": [modality], "path": [path], "steps": [len(pdf)]})

    return features.groupBy("video_id", "modality").applyInPandas(run, "video_id string, modality string, path string, steps long")


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append (video_id, modality, shard_id, status, error, ...) rows, a folder per status; status: ok, failed or silent. As for
    ``write_features``, runs at work at the same time write to ``<path>/run=<name>``."""
    rows.write.mode("append").partitionBy("status").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The lines, one for each video, modality, status and run."""
    rows = spark.read.parquet(path)
    if "run" in rows.columns:
        rows = rows.withColumn("run", F.col("run").cast("string"))
    return rows.dropDuplicates([c for c in ("video_id", "modality", "status", "run") if c in rows.columns])


def done_set(spark: SparkSession, folders: list[str], modality: str, done_prefix: str, extra: list[str] | None = None) -> DataFrame:
    """(video_id) of all that is done: the feature files in ``folders`` and the lines of the text ledgers there whose names begin with
    ``done_prefix``; ``extra`` names more folders, and text files of one id, name or path a line. Of ``extra``, what does not exist
    gives a warning and nothing else. Folders are listed once and ledgers read by Spark."""
    from pyarrow import fs as pafs

    from ..operators.worklist import done_ids, ids_of_feature_files
    from .media import list_files

    folders, texts = list(folders), []
    for x in extra or []:
        fs, p = _filesystem(x)
        kind = fs.get_file_info(p).type
        if kind == pafs.FileType.NotFound:
            warnings.warn(f"{x} is not there, so nothing in it counts as done", stacklevel=2)
        (folders if kind == pafs.FileType.Directory else texts if kind == pafs.FileType.File else []).append(x)
    files = list_files(spark, *folders)
    ledgers = files.filter(F.col("name").startswith(done_prefix) & F.col("name").endswith(".txt"))
    # one row per ledger file, of which a run of a shard leaves one
    texts += [f"{r['directory'].rstrip('/')}/{r['name']}" for r in ledgers.select("directory", "name").collect()]
    lines = spark.read.text(texts) if texts else spark.createDataFrame([], "value string")
    return done_ids(ids_of_feature_files(files, modality), lines, modality)


def ledger_lines(rows: DataFrame) -> DataFrame:
    """(status, value): lines of text ledgers; a failed one has its error after a tab."""
    return rows.select("status", F.concat_ws("\t", "video_id", F.when(F.col("status") == "failed", F.col("error"))).alias("value"))


def _wav_files(files: DataFrame, prefix: str, tasks: int) -> DataFrame:
    if "video_id" not in files.columns:
        files = files.filter(F.col("name").endswith(".wav") & F.col("name").startswith(prefix)).withColumn("video_id", stem("name", prefix))
    return files.select("video_id", "path").repartition(tasks, "path")


def probe_wav(files: DataFrame, prefix: str = "", tasks: int = 64) -> DataFrame:
    """(video_id, path, sample_rate, frames, error) of WAV files (name, path) or (video_id, path), from their headers alone."""

    def run(batches):
        for pdf in batches:
            out = []
            for video, path in pdf.itertuples(index=False, name=None):
                try:
                    fs, p = _filesystem(path)
                    with fs.open_input_file(p) as f, wave.open(f) as w:
                        if w.getsampwidth() != 2:
                            raise ValueError(f"{8 * w.getsampwidth()} bits a sample instead of 16")
                        out.append((video, path, w.getframerate(), w.getnframes(), None))
                except (OSError, ValueError, EOFError, wave.Error) as e:
                    out.append((video, path, None, None, repr(e)))
            yield pd.DataFrame(out, columns=["video_id", "path", "sample_rate", "frames", "error"]).astype({"sample_rate": "Int32", "frames": "Int64"})

    return _wav_files(files, prefix, tasks).mapInPandas(run, "video_id string, path string, sample_rate int, frames long, error string")


def _wav_blocks(batches, block: int):
    """Blocks of the files in frames of (video_id, path), many short ones in a frame: building a frame costs more than reading a short
    file. What a frame holds is bounded by its samples."""
    names = ["video_id", "block_id", "sample_offset", "sample_rate", "samples", "error"]

    def rows(video, path):
        k, rate = 0, None
        try:
            fs, p = _filesystem(path)
            with fs.open_input_file(p) as f, wave.open(f) as w:
                if w.getsampwidth() != 2:
                    raise ValueError(f"{8 * w.getsampwidth()} bits a sample instead of 16")
                rate, frames = w.getframerate(), w.getnframes()
                while raw := w.readframes(block):
                    x = np.frombuffer(raw[: len(raw) // (2 * w.getnchannels()) * 2 * w.getnchannels()], "<i2").astype(np.float32) / np.float32(32768)
                    x = x.reshape(-1, w.getnchannels()).mean(axis=1, dtype=np.float32)
                    frames -= len(x)
                    yield video, k, k * block, rate, x, None
                    k += 1
                if frames > 0:
                    raise EOFError(f"{frames} frames are missing at the end")
        except (OSError, ValueError, EOFError, wave.Error) as e:
            yield video, k, k * block, rate, None, repr(e)

    for pdf in batches:
        held, n = [], 0
        for video, path in pdf.itertuples(index=False, name=None):
            for row in rows(video, path):
                held.append(row)
                n += 0 if row[4] is None else len(row[4])
                if n >= _HELD_SAMPLES or len(held) >= _HELD_ROWS:
                    yield pd.DataFrame(held, columns=names).astype({"sample_rate": "Int32"})
                    held, n = [], 0
        if held:
            yield pd.DataFrame(held, columns=names).astype({"sample_rate": "Int32"})


def read_wav(files: DataFrame, block: int = 1 << 16, prefix: str = "", tasks: int = 64) -> DataFrame:
    """(video_id, block_id, sample_offset, sample_rate, samples, error) of 16-bit PCM files (name, path) or (video_id, path), channels
    averaged; a file is read a block at a time. An empty file gives no row; where a file can't be read on, a last row has the
    error and no samples."""
    schema = "video_id string, block_id int, sample_offset long, sample_rate int, samples array<float>, error string"
    return _wav_files(files, prefix, tasks).mapInPandas(lambda batches: _wav_blocks(batches, block), schema)
