"""One JSON document of any size, read and written by many tasks.

A document is {..., "database": {key: entry, ...}, ...}. To read it, its bytes are cut into ranges. Where a range begins, inside a
string or not and how deep, is not known from its bytes; so each range first says what it changes, for either case, and sums over the
ranges before give its beginning. With that the ranges find where the database is and where its entries part, and each gives the
entries that begin in it. Strings and nesting are found with array operations; no task holds more than a range and
an entry.

To write it, entries are sorted by ranges of keys into compressed pieces, the sizes of the pieces give each one its place in the file,
and each task writes a piece at its place. The file gets its name when all are done; a task that runs again writes the same bytes."""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import _filesystem
from .text import ANNOTATION, SEGMENT

RANGE_BYTES = 8 << 20
#: Bytes of a document, and of the rows of one to be, that make a task.
TASK_BYTES = 32 << 20
QUOTE, BACKSLASH, COMMA = 34, 92, 44
_KEY = re.compile(r'("(?:[^"\\]|\\.)*")\s*:\s*\Z', re.S)
_STEP = np.zeros(256, np.int64)
_STEP[[123, 91]], _STEP[[125, 93]] = 1, -1


class _File:
    """Byte ranges of a file."""

    def __init__(self, path: str):
        fs, p = _filesystem(path)
        self.file = fs.open_input_file(p)
        self.size = self.file.size()

    def read(self, start: int, end: int) -> np.ndarray:
        start, end = max(0, start), min(end, self.size)
        return np.frombuffer(self.file.read_at(max(0, end - start), start), np.uint8)

    def before(self, start: int) -> int:
        """How many backslashes come right before a place."""
        n, step = 0, 64
        while start - n > 0:
            a = self.read(start - n - step, start - n)
            other = np.flatnonzero(a != BACKSLASH)
            if len(other):
                return n + len(a) - 1 - int(other[-1])
            n += len(a)
        return n

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def quotes(a: np.ndarray, before: int) -> np.ndarray:
    """Places of the quotes that begin or end a string: an odd number of backslashes right before one makes it part of the string."""
    q = np.flatnonzero(a == QUOTE)
    slashes = a == BACKSLASH
    if not len(q) or not before and not slashes.any():
        return q
    last = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(a))))
    prev = np.where(q > 0, last[q - 1], -1)
    run = q - 1 - prev + np.where(prev < 0, before, 0)
    return q[run % 2 == 0]


def changes(a: np.ndarray, before: int) -> tuple[int, int, int]:
    """(odd number of quotes, change of depth if the range begins outside a string, change if it begins inside one)."""
    q, marks = quotes(a, before), np.flatnonzero(_STEP[a])
    inside = np.searchsorted(q, marks) % 2
    step = _STEP[a[marks]]
    return len(q) % 2, int(step[inside == 0].sum()), int(step[inside == 1].sum())


def marks_of(a: np.ndarray, before: int, in_string: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, bytes, depth after) of the brackets, braces and commas outside of strings."""
    marks = np.flatnonzero((_STEP[a] != 0) | (a == COMMA))
    marks = marks[np.searchsorted(quotes(a, before), marks) % 2 == int(in_string)]
    return marks, a[marks], depth + np.cumsum(_STEP[a[marks]])


def _tasks(spark: SparkSession, size: int, most: int) -> int:
    """How many tasks share ``size`` bytes. The number is given to ``repartition``: rows that only name ranges are so short that Spark would
    join their partitions to one, and one task would then read the whole document."""
    return max(1, min(most, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))


def _ranges(spark: SparkSession, paths: tuple[str, ...], size: int) -> tuple[DataFrame, int]:
    """(path, k, start, end) of each range, and the number of tasks that they are dealt to."""
    found = []
    for p in paths:
        with _File(p) as f:
            found.append((p, f.size))
    n = F.ceil(F.col("bytes") / size)
    tasks = _tasks(spark, sum(b for _, b in found), sum(-(-b // size) for _, b in found))
    rows = spark.createDataFrame(found, "path string, bytes long").filter("bytes > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return rows.select("path", "k", (F.col("k") * size).alias("start"), F.least((F.col("k") + 1) * size, "bytes").alias("end")).repartition(tasks, "path", "k"), tasks


def _changes(batches):
    for pdf in batches:
        out = []
        for path, k, start, end in pdf.itertuples(index=False, name=None):
            with _File(path) as f:
                out.append((path, k, start, end, *changes(f.read(start, end), f.before(start))))
        yield pd.DataFrame(out, columns=["path", "k", "start", "end", "odd", "outside", "inside"])


def _landmarks(batches):
    """Objects that open at the second level with their keys, places where the second level ends, and the first comma there."""
    for pdf in batches:
        out = []
        for path, k, start, end, in_string, depth in pdf.itertuples(index=False, name=None):
            with _File(path) as f:
                places, what, deep = marks_of(f.read(start, end), f.before(start), in_string, depth)
                opens, closes, commas = ((deep == 2) & (what == 123), (deep == 1) & (_STEP[what] < 0), (deep == 2) & (what == COMMA))
                for at in (places[opens] + start).tolist():
                    m = _KEY.search(f.read(at - 4096, at).tobytes().decode("utf-8", "replace"))
                    out.append((path, k, "open", at, json.loads(m[1], strict=False) if m else None))
                out += [(path, k, "close", at, None) for at in (places[closes] + start).tolist()]
                out += [(path, k, "comma", at, None) for at in (places[commas][:1] + start).tolist()]
        yield pd.DataFrame(out, columns=["path", "k", "kind", "at", "key"])


def _entries(batches):
    decode = json.JSONDecoder(strict=False).raw_decode
    for pdf in batches:
        for path, start, end, in_string, depth, first, last, following in pdf.itertuples(index=False, name=None):
            with _File(path) as f:
                a = f.read(start, end)
                places, what, deep = marks_of(a, f.before(start), in_string, depth)
                commas = places[(deep == 2) & (what == COMMA)] + start
                cuts = [int(c) for c in commas if first < c < last]
                begins = ([first] if start <= first < end else []) + cuts
                ends = cuts if start <= first < end else cuts[1:]
                ends = [*ends, min(last, int(following))][: len(begins)]
                out = []
                for b, e in zip(begins, ends, strict=True):
                    raw = a[b + 1 - start : e - start] if e <= end else f.read(b + 1, e)
                    text = raw.tobytes().decode("utf-8", "replace").strip()
                    if text:
                        key, at = decode(text)
                        out.append((path, key, text[at:].lstrip()[1:].strip()))
                    if len(out) >= 2000:
                        yield pd.DataFrame(out, columns=["path", "key", "entry"])
                        out = []
                yield pd.DataFrame(out, columns=["path", "key", "entry"])


def document_entries(spark: SparkSession, *paths: str, range_bytes: int = RANGE_BYTES, name: str = "database") -> DataFrame:
    """(path, key, entry): the members of the object ``name`` of each document, entries as JSON text. A document without that object, or
    in which it never ends, has none; of several the last counts."""
    ranges, tasks = _ranges(spark, paths, range_bytes)
    spans = ranges.mapInPandas(_changes, "path string, k long, start long, end long, odd int, outside long, inside long")
    spans = spans.persist()
    ahead = W.partitionBy("path").orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    spans_at = spans.withColumn("in_string", F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2 == 1)
    spans_at = spans_at.withColumn("depth", F.coalesce(F.sum(F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))).over(ahead), F.lit(0)))
    spans_at = spans_at.select("path", "k", "start", "end", "in_string", "depth")
    marks = spans_at.repartition(tasks, "path", "k").mapInPandas(_landmarks, "path string, k long, kind string, at long, key string").persist()
    first = marks.filter((F.col("kind") == "open") & (F.col("key") == name)).groupBy("path").agg(F.max("at").alias("first"))
    last = marks.filter("kind = 'close'").join(first, "path").filter("at > first").groupBy("path", "first").agg(F.min("at").alias("last"))
    commas = marks.filter("kind = 'comma'").select("path", "k", F.col("at").alias("comma"))
    beyond = W.partitionBy("path").orderBy("k").rowsBetween(1, W.unboundedFollowing)
    rows = spans_at.join(commas, ["path", "k"], "left").withColumn("following", F.first("comma", ignorenulls=True).over(beyond)).join(last, "path")
    rows = rows.filter("start < last and end > first").select("path", "start", "end", "in_string", "depth", "first", "last", F.coalesce("following", "last").alias("following"))
    return rows.repartition(tasks, "path", "start").mapInPandas(_entries, "path string, key string, entry string")


def ids_of(entries: DataFrame) -> DataFrame:
    """Distinct ids: an entry's video_id, or else its key."""
    return entries.select(F.coalesce(F.get_json_object("entry", "$.video_id"), "key").alias("video_id")).distinct()


def segments_of(training: DataFrame, validation: DataFrame) -> DataFrame:
    """(seg_id, video_id, subset, duration, segment, recipe_type, sentence) of the entries of two documents."""
    parts = [e.select(F.col("key").alias("seg_id"), F.lit(s).alias("subset"), F.from_json("entry", SEGMENT).alias("v")).select("seg_id", "subset", "v.*") for e, s in ((training, "training"), (validation, "validation"))]
    return reduce(DataFrame.unionByName, parts)


def annotations_of(entries: DataFrame) -> DataFrame:
    """(video_id, subset, duration, annotations) of the entries of an annotation database."""
    return entries.select(F.col("key").alias("video_id"), F.from_json("entry", ANNOTATION).alias("v")).select("video_id", "v.*")


def write_document(rows: DataFrame, key: Column | str, entry: Column, path: str, head: dict | None = None, name: str = "database") -> int:
    """Write {<head>, name: {key: entry, ...}} in the order of the keys to ``path``, a file in a folder that all tasks share; returns its
    bytes. Nothing is at ``path`` before the document is whole, and what was there before is replaced by it."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path}: a document is written in place by many tasks, which needs a mounted folder")
    target = path.removeprefix("file://")
    part = f"{target}.{uuid.uuid4().hex}.part"
    key = F.col(key) if isinstance(key, str) else key
    text = F.to_json(F.map_from_arrays(F.array(key.cast("string")), F.array(entry)))
    texts = rows.select(key.cast("string").alias("key"), text.alias("text")).withColumn("text", F.substr("text", F.lit(2), F.length("text") - 2))
    plain, ranged = f"{part}-rows/plain", f"{part}-rows/ranged"
    spark = rows.sparkSession
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        # written before it is sorted by ranges: the sizes say how many there must be, and finding their borders does not make the rows again
        texts.write.option("compression", "zstd").parquet(f"file://{plain}")
        whole = spark.read.parquet(f"file://{plain}").agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        tasks = _tasks(spark, whole, max(1, whole >> 20))
        sort = spark.read.parquet(f"file://{plain}").repartitionByRange(tasks, "key").sortWithinPartitions("key")
        sort.select("text", F.spark_partition_id().alias("range")).write.option("compression", "zstd").parquet(f"file://{ranged}")
        shutil.rmtree(plain)
        # the sorted pieces are files, some for each range, so they go to their places without a shuffle; one row for each comes back
        file = F.substring_index(F.input_file_name(), "/", -1).alias("file")
        sums = spark.read.parquet(f"file://{ranged}").groupBy("range", file).agg(F.sum(F.octet_length("text") + 1).alias("n")).orderBy("range", "file").collect()
        total = sum(r.n for r in sums)
        opening = json.dumps(head or {}, separators=(",", ":"), ensure_ascii=False)[:-1]
        opening = f"{opening}{',' if head else ''}{json.dumps(name)}:{{".encode()
        size = len(opening) + max(0, total - 1) + 2
        with open(part, "wb") as f:
            f.write(opening)
            f.truncate(size)
            f.seek(size - 2)
            f.write(b"}}")
        body, end = len(opening), size - 2

        def write(batches):
            with open(part, "r+b") as f:
                for pdf in batches:
                    for file, offset in zip(pdf["file"], pdf["offset"].tolist(), strict=True):
                        f.seek(at := body + offset)
                        for batch in pq.ParquetFile(f"{ranged}/{file}").iter_batches(8192, columns=["text"]):
                            raw = b"".join(line.encode() + b"," for line in batch.column(0).to_pylist())
                            at += len(raw)
                            f.write(raw[:-1] if at > end else raw)
                yield pd.DataFrame({"done": [1]})

        if sums:
            pieces = zip((r.file for r in sums), accumulate((r.n for r in sums), initial=0))
            placed = spark.createDataFrame(list(pieces), "file string, offset long").repartition(len(sums))
            placed.mapInPandas(write, "done int").write.format("noop").mode("overwrite").save()
        os.replace(part, target)
    finally:
        shutil.rmtree(f"{part}-rows", ignore_errors=True)
        if os.path.exists(part):
            os.remove(part)
    return size
