"""Feature matrices as .npy files, written by a data source of its own.

A task writes the matrices that are complete in it below a folder of the job that readers don't look into; its message tells their
names. Only when all tasks are done they move to where they belong, and a job that fails takes its folder away. So an export that is
cut off shows nothing, and of a task that ran twice only the files of the attempt that counts are moved.

``spark.dataSource.register(NpyFeatures)`` and ``df.write.format("npy_features").option("path", folder).mode("append").save()``, from
(video_id, modality, step, feature) with the rows of a matrix together and in order, as ``write_npy`` sends them."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.names import SUFFIXES
from .store import FEATURES, _filesystem

#: Moves that are under way at a time when a job commits.
MOVES = 32


@dataclass
class Written(WriterCommitMessage):
    """The (staged, final) names of a task."""

    files: list


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if "path" not in options:
            raise ValueError("npy_features needs a path")
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.suffixes = SUFFIXES | {k.removeprefix("suffix."): v for k, v in options.items() if k.startswith("suffix.")}
        self.staging = f"{self.path}/.npy-{uuid.uuid4().hex}"

    def _matrices(self, batches: Iterator[pa.RecordBatch]):
        """(video_id, modality, matrix), one matrix at a time."""
        held, rows, at = None, [], 0
        for batch in batches:
            names = {n.lower(): batch.column(k) for k, n in enumerate(batch.schema.names)}
            keys = list(zip(names["video_id"].to_pylist(), names["modality"].to_pylist(), names["step"].to_pylist(), strict=True))
            for k, (video, modality, step) in enumerate(keys):
                if (video, modality) != held:
                    if held:
                        yield (*held, np.stack(rows))
                    held, rows, at = (video, modality), [], 0
                if video is None or modality not in self.suffixes or "/" in video:
                    raise ValueError(f"no file name for {video!r} of {modality!r}")
                if step != at:
                    raise ValueError(f"{video}, {modality}: step {step} where {at} belongs")
                vector = names["feature"][k].values
                rows.append(np.asarray(vector.to_numpy(zero_copy_only=False), np.float32))
                at += 1
        if held:
            yield (*held, np.stack(rows))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _filesystem(self.staging)
        folder, files = f"{base}/{uuid.uuid4().hex}", []
        target = _filesystem(self.path)[1]
        fs.create_dir(folder, recursive=True)
        for n, (video, modality, matrix) in enumerate(self._matrices(batches)):
            out = io.BytesIO()
            np.save(out, matrix)
            with fs.open_output_stream(f"{folder}/{n}.npy", compression=None) as f:
                f.write(out.getvalue())
            files.append((f"{folder}/{n}.npy", f"{target}/{video}{self.suffixes[modality]}"))
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, target = _filesystem(self.path)
        fs.create_dir(target, recursive=True)
        moves = [m for message in messages if message for m in message.files]
        ends = [end for _, end in moves]
        if len(set(ends)) < len(ends):
            self.abort(messages)
            raise ValueError("a matrix was written by two tasks: its rows must be together")
        if self.overwrite:
            from pyarrow import fs as pafs

            kept = set(ends)
            for info in fs.get_file_info(pafs.FileSelector(target)):
                if info.type == pafs.FileType.File and info.base_name.endswith(tuple(self.suffixes.values())) and f"{target}/{info.base_name}" not in kept:
                    fs.delete_file(info.path)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda m: fs.move(*m), moves))
        self._drop()

    def abort(self, messages: list) -> None:
        self._drop()

    def _drop(self) -> None:
        fs, staging = _filesystem(self.staging)
        try:
            fs.delete_dir(staging)
        except FileNotFoundError:
            pass


class NpyFeatures(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy_features"

    def schema(self) -> str:
        return FEATURES

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options, overwrite)


def write_npy(features: DataFrame, path: str, overwrite: bool = False) -> None:
    """A .npy file for each video and modality of long rows; steps must count from 0 without a gap. With ``overwrite`` the feature files
    that were there and are not written now go. A task holds one matrix at a time, which is what the file format needs."""
    features.sparkSession.dataSource.register(NpyFeatures)
    rows = features.select("video_id", "modality", "step", features["feature"].cast("array<float>").alias("feature"))
    rows = rows.repartition("video_id", "modality").sortWithinPartitions("video_id", "modality", "step")
    rows.write.format("npy_features").option("path", path).mode("overwrite" if overwrite else "append").save()
