"""Queries that run streams over tables derived from the given ones, to their end, and read what they wrote."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..streaming import assemble as asm
from ..streaming import resume, windows
from . import query
from .standins import FRAMES, MESSAGES, frames, messages, r6, scratch, table
from .windows import _clips_sql

STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Batches of a stream, and files that a batch reads, each in a task of its own.
BATCHES, FILES = 3, 4
#: Buckets that share the state of videos of some events each.
BUCKETS = 1024


def _stream(spark, rows, key: str, order):
    """``rows`` written in ``BATCHES`` parts, by the number that ``order`` gives, one after another and each as several files by
    ``key``; read as a stream that takes as many files at a time, so that state goes from batch to batch."""
    path = scratch(spark, "stream-in")
    numbered = rows.withColumn("_part", F.greatest(F.lit(0), F.least(F.lit(BATCHES - 1), order)).cast("int")).persist()
    for k in range(BATCHES):
        numbered.filter(F.col("_part") == k).drop("_part").repartition(FILES, key).write.mode("append").parquet(path)
    numbered.unpersist()
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def _run(spark, stream, mode: str = "append"):
    """Run a stream to the end of its input into a table, and read that."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE)
    path = scratch(spark, "stream-out")
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", scratch(spark, "stream-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(_clips_sql(FRAMES, 16, 8))
def stream_clip_windows(spark, d):
    rows = frames(spark, d)
    last = F.col("frame_idx") == F.max("frame_idx").over(W.partitionBy("video_id"))
    rows = rows.select("video_id", "frame_idx", "value", last.alias("last"))
    out = _run(spark, windows.stream_clips(_stream(spark, rows, "video_id", F.floor(F.col("frame_idx") / 24)), 16, 8, buckets=BUCKETS)).filter("error is null")
    return out.groupBy("video_id", "clip_idx").agg(F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_frame"), F.max("frame_idx").alias("last_frame"), F.sum(F.col("pos") * F.col("frame_idx")).alias("mix"), r6(F.avg("value")).alias("mean"))


@query("""WITH e AS (SELECT user_id, epoch_us(ts) // 1000000 // 86400 * 86400 AS day, value FROM events), w AS (SELECT user_id, day - back AS start, value FROM e, (SELECT unnest([0, 86400]) AS back)),
m AS (SELECT max(epoch_ms(ts)) - 3600000 AS mark FROM events)
SELECT user_id AS video_id, CAST(start AS BIGINT) AS start, count(*) AS n, round(avg(value), 6) AS mean FROM w, m WHERE (start + 172800) * 1000 <= mark GROUP BY user_id, start HAVING count(*) = 7""")
def event_time_clips(spark, d):
    """Windows of two days that move by one, with exactly seven events."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("video_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    day = F.unix_seconds("ts") / 86400
    span = rows.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    part = F.floor((day - F.lit(span["low"] or 0.0)) / F.lit(((span["high"] or 0.0) - (span["low"] or 0.0) or 1.0) / BATCHES))
    out = _run(spark, windows.event_time_clips(_stream(spark, rows, "video_id", part), "2 days", "1 day", 7, "1 hour"))
    return out.select("video_id", F.unix_seconds("start").alias("start"), "n", r6("mean").alias("mean"))


ASSEMBLED = f"""WITH {MESSAGES}, per AS (SELECT video_id, count(*) FILTER (kind = 'start') AS starts, count(*) FILTER (kind = 'end') AS ends, coalesce(sum(n) FILTER (kind = 'chunk'), 0) AS n,
  arg_min(error, seq) FILTER (kind = 'chunk' AND error IS NOT NULL) AS chunk_error, max(error) FILTER (kind = 'end') AS end_error FROM errs GROUP BY video_id),
done AS (SELECT *, coalesce(chunk_error, end_error, CASE WHEN starts = 0 THEN 'end without start' END, CASE WHEN n = 0 THEN 'no windows' END) AS error FROM per WHERE ends > 0)
SELECT video_id, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, CAST(CASE WHEN error IS NULL THEN n ELSE 0 END AS BIGINT) AS windows, error FROM done"""


@query(ASSEMBLED)
def assemble_messages(spark, d):
    return asm.assemble(messages(spark, d))


@query(ASSEMBLED)
def stream_assemble(spark, d):
    return _run(spark, asm.stream_assemble(_stream(spark, messages(spark, d), "video_id", F.col("seq"))))


@query("SELECT doc_id AS video_id, 2::BIGINT AS runs FROM documents WHERE n_chars % 10 = 3 UNION ALL SELECT doc_id, 1 FROM documents WHERE n_chars % 10 <> 3")
def stream_resume(spark, d):
    """All documents come twice; those that failed at first are worked on again, the others are not."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), "n_chars")
    src, out, ledger, check = (scratch(spark, n) for n in ("items", "out", "ledger", "check"))
    work = lambda df: df.select("video_id", F.when(F.col("n_chars") % 10 == 3, "failed").otherwise("ok").alias("status"))
    for _ in range(2):
        docs.repartition(FILES, "video_id").write.mode("append").parquet(src)
        items = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", FILES).parquet(src)
        resume.resumable(items, work, out, ledger, check).awaitTermination()
    return spark.read.parquet(out).groupBy("video_id").agg(F.count(F.lit(1)).alias("runs"))
