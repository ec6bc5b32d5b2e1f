"""A stream that skips what is done and records what it does.

The ledger of a stream is snapshots and deltas. A batch writes a delta: its videos and what became of them. Every so many
batches all lines so far become a snapshot, the last line of each video with ok before all else, and what older snapshots and
deltas held is in it. A batch reads the last snapshot and the deltas after it, so the folders it reads don't grow with the
number of batches.

A folder counts once Spark has marked it as written to its end, and a batch looks only at what batches before it have left; so a
batch that was cut off, wherever, runs again as if it never had."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LINE = "video_id {kind}, status string, batch long"
#: A batch of up to so many ids is sent to the tasks that read the snapshot; a larger one meets it by a shuffle.
SMALL_BATCH = 1_000_000


class Ledger:
    """The ledger of a stream at ``path``, with a snapshot after every ``every`` batches."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path.rstrip("/"), every

    def _folders(self) -> dict[str, list[int]]:
        """Numbers of the snapshots and deltas that are whole, in order."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found: dict[str, list[int]] = {"snapshot": [], "batch": []}
        if fs.exists(root):
            for s in fs.listStatus(root):
                m = re.fullmatch(r"(snapshot|batch)-(\d+)", s.getPath().getName())
                if m and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS")):
                    found[m[1]].append(int(m[2]))
        return {k: sorted(v) for k, v in found.items()}

    def _remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def folders_before(self, number: int | None = None) -> list[str]:
        """What tells all that the batches before ``number`` did: a snapshot and the deltas after it."""
        found = self._folders()
        before = lambda x: number is None or x < number
        snapshot = max(filter(before, found["snapshot"]), default=-1)
        return ([f"snapshot-{snapshot:09d}"] if snapshot >= 0 else []) + [f"batch-{n:09d}" for n in found["batch"] if n > snapshot and before(n)]

    def lines(self, kind: str, number: int | None = None) -> DataFrame:
        """(video_id, status, batch) of the batches before ``number``."""
        schema, folders = LINE.format(kind=kind), self.folders_before(number)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def left(self, ids: DataFrame, number: int) -> DataFrame:
        """The rows of ``ids`` (video_id, ...) that have no ok line before batch ``number``. A batch is small against what is done, so
        its ids go to the tasks that read the ledger, and only those of them that are done come back."""
        kind = ids.schema["video_id"].dataType.simpleString()
        done = self.lines(kind, number).filter("status = 'ok'").select("video_id")
        asked = ids.select("video_id").distinct()
        if ids.count() <= SMALL_BATCH:
            done = done.join(F.broadcast(asked), "video_id", "left_semi").distinct()
        return ids.join(done, "video_id", "left_anti")

    def record(self, lines: DataFrame, number: int) -> None:
        """The delta of a batch from (video_id, status)."""
        lines.select("video_id", "status").distinct().withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch-{number:09d}")

    def compact(self, kind: str, number: int) -> None:
        """A snapshot of all up to batch ``number``, if it is time for one; what the snapshot before the last one made needless goes."""
        if (number + 1) % self.every:
            return
        rows = self.lines(kind, number + 1)
        last = F.max_by(F.struct("status", "batch"), F.struct(F.col("status") == "ok", "batch")).alias("last")
        rows.groupBy("video_id").agg(last).select("video_id", "last.*").write.mode("overwrite").parquet(f"{self.path}/snapshot-{number:09d}")
        found = self._folders()
        kept = [n for n in found["snapshot"] if n < number][-1:]
        for n in found["snapshot"]:
            if kept and n < kept[0]:
                self._remove(f"snapshot-{n:09d}")
        for n in found["batch"]:
            if kept and n <= kept[0]:
                self._remove(f"batch-{n:09d}")


def resume_batch(df: DataFrame, number: int, work: Callable[[DataFrame], DataFrame], output: str, ledger: str, every: int = 20) -> None:
    """One batch: what is not done yet is worked on, its rows replace those of an attempt of this batch that was cut off, then its
    delta and, in its turn, a snapshot are written."""
    spark = df.sparkSession
    book, kind = Ledger(spark, ledger, every), df.schema["video_id"].dataType.simpleString()
    ids = df.dropDuplicates(["video_id"]).persist()
    target = f"{output}/batch={number:09d}"
    work(book.left(ids, number)).write.mode("overwrite").parquet(target)
    ids.unpersist()
    book.record(spark.read.parquet(target), number)
    book.compact(kind, number)


def resumable(items: DataFrame, work: Callable[[DataFrame], DataFrame], output: str, ledger: str, checkpoint: str, every: int = 20) -> StreamingQuery:
    """Runs ``work`` on the new items (video_id) of a stream and writes its rows (video_id, status, ...) below ``output``.

    Ids with an ok line in the ledger are skipped; failed ones come again when they are sent again."""
    run = lambda df, number: resume_batch(df, number, work, output, ledger, every)
    return items.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
