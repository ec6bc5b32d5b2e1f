"""Listing media files.

Spark's own file sources skip names that begin with ``_`` or ``.``, and ids that begin with ``_`` are normal here; so names come
from a Python data source, which lists each directory in a task of its own through pyarrow (local, S3, GCS, HDFS)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from ..functions.names import stem

SCHEMA = "directory string, name string, path string, length long, modified timestamp"


class _Directory(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _listed(directory: str, prefix: str = "", ext: str = ""):
    """The files of a directory whose names begin with ``prefix`` and end with ``ext``; a directory that isn't there has none."""
    from pyarrow import fs as pafs

    fs, path = pafs.FileSystem.from_uri(directory) if "://" in directory else (pafs.LocalFileSystem(), directory)
    for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if info.type == pafs.FileType.File and info.base_name.startswith(prefix) and info.base_name.endswith(ext):
            yield info


def _row(directory: str, info):
    return (directory, info.base_name, info.path, info.size, info.mtime.replace(tzinfo=None) if info.mtime else None)


def _paths(options: dict) -> list[str]:
    return [p for p in options.get("paths", options.get("path", "")).split("\n") if p]


class MediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.prefix, self.ext = _paths(options), options.get("prefix", ""), options.get("ext", "")

    def partitions(self):
        return [_Directory(p) for p in self.paths]

    def read(self, partition):
        for info in _listed(partition.path, self.prefix, self.ext):
            yield _row(partition.path, info)


class PushingReader(MediaReader):
    """Takes what a filter says of how names begin and end, so that other files never leave the task that lists them."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("name",) and f.value.startswith(self.prefix):
                self.prefix = f.value
            elif isinstance(f, StringEndsWith) and f.attribute == ("name",) and f.value.endswith(self.ext):
                self.ext = f.value
            else:
                yield f


class _Span(InputPartition):
    def __init__(self, path: str, start: list, end: list):
        self.path, self.start, self.end = path, start, end


class MediaStream(DataSourceStreamReader):
    """Files as they come, in the order of (time of their last change, path). A file younger than ``settle`` seconds waits for a later
    batch, so that no file of the same time can come after the end of a batch; a file that is changed comes again."""

    def __init__(self, options: dict):
        self.paths, self.prefix, self.ext, self.settle = _paths(options), options.get("prefix", ""), options.get("ext", ""), float(options.get("settle", 2))

    def _found(self, directory: str):
        for info in _listed(directory, self.prefix, self.ext):
            yield [info.mtime_ns or 0, f"{directory}\n{info.base_name}"], info

    def initialOffset(self) -> dict:
        return {"after": [-1, ""]}

    def latestOffset(self) -> dict:
        import time

        until = time.time_ns() - int(self.settle * 1e9)
        return {"after": max((place for d in self.paths for place, _ in self._found(d) if place[0] <= until), default=[-1, ""])}

    def partitions(self, start: dict, end: dict):
        return [_Span(p, start["after"], end["after"]) for p in self.paths]

    def read(self, partition):
        for place, info in self._found(partition.path):
            if partition.start < place <= partition.end:
                yield _row(partition.path, info)


class MediaListing(DataSource):
    """``spark.read.format("media_listing").option("paths", "dir1\\ndir2").load()``, and the same with ``readStream``; options ``prefix``
    and ``ext`` choose by name."""

    @classmethod
    def name(cls) -> str:
        return "media_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> MediaReader:
        return (PushingReader if self.options.get("pushdown") == "true" else MediaReader)(self.options)

    def streamReader(self, schema: StructType) -> MediaStream:
        return MediaStream(self.options)


def list_files(spark: SparkSession, *directories: str, prefix: str = "", ext: str = "") -> DataFrame:
    """The files of some directories. Where the session lets Python sources take filters (spark.sql.python.filterPushdown.enabled), those
    on the beginning and end of names go to the listing."""
    spark.dataSource.register(MediaListing)
    reader = spark.read.format("media_listing").option("paths", "\n".join(directories)).option("prefix", prefix).option("ext", ext)
    return reader.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).load()


def stream_files(spark: SparkSession, *directories: str, prefix: str = "", ext: str = "", settle: float = 2) -> DataFrame:
    """A stream of the files of some directories, each once, those that come later as well."""
    spark.dataSource.register(MediaListing)
    reader = spark.readStream.format("media_listing").option("paths", "\n".join(directories)).option("prefix", prefix).option("ext", ext)
    return reader.option("settle", str(settle)).load()


def media_ids(files: DataFrame, ext: str = ".mp4", prefix: str = "") -> DataFrame:
    """(video_id, <the other columns>) of the files whose names begin with ``prefix`` and end with ``ext``."""
    chosen = files.filter(F.col("name").startswith(prefix) & F.col("name").endswith(ext))
    return chosen.withColumn("video_id", stem("name", prefix))
