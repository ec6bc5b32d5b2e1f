"""Videos from messages (video_id, seq, kind, n, error): start, chunk, end.

A video is done when its end comes without an error and it has windows; a failed chunk or an end with an error fails it, later
chunks are then ignored; an end without a start fails. State is a few counters, and goes with the end, or when nothing has come
for a given time; vectors are not kept in it, they are written as they come."""

from __future__ import annotations

import pickle

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


class Assembly:
    """The function of ``applyInPandasWithState`` for the videos of a bucket, which share calls, frames and one value of the state.

    ``idle_ms``: how long a video may send nothing before it fails with "no end" and its state goes; None: for ever."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def __call__(self, key, rows, group: GroupState):
        now, idle, out = group.getCurrentProcessingTimeMs(), self.idle_ms, []
        held = pickle.loads(group.get[0]) if group.exists else {}  # by video: started, windows, error, when it last sent something
        if not group.hasTimedOut:
            for video, kind, n, err in pd.concat(list(rows)).sort_values("seq")[["video_id", "kind", "n", "error"]].itertuples(index=False, name=None):
                video, err = None if video != video else video, err if isinstance(err, str) else None
                started, windows, error, _ = held.get(video, (False, 0, None, now))
                if kind == "start":
                    started, windows, error = True, 0, None
                elif kind == "chunk":
                    if error is None and err is None:
                        windows += int(n)
                    error = error or err
                elif kind == "end":
                    error = error or err or (None if started else "end without start") or (None if windows else "no windows")
                    out.append((video, "failed" if error else "ok", 0 if error else windows, error))
                    started, windows, error = False, 0, None
                held[video] = (started, windows, error, now)
        for video, (started, windows, error, seen) in list(held.items()):
            if not (started or windows or error):
                del held[video]
            elif idle is not None and seen + idle <= now:
                out.append((video, "failed", 0, "no end"))
                del held[video]
        if held:
            group.update((pickle.dumps(held),))
            if idle is not None:
                group.setTimeoutDuration(max(1, min(h[3] for h in held.values()) + idle - now))
        else:
            group.remove()
        yield pd.DataFrame(out, columns=["video_id", "status", "windows", "error"], dtype=object)


def stream_assemble(messages: DataFrame, idle_ms: int | None = None, buckets: int = 1024) -> DataFrame:
    """(video_id, status, windows, error), a row for each end, and one for each video that sent nothing for ``idle_ms``. The counters of
    videos are kept in so many buckets; a bucket's messages of one batch must fit in a task."""
    kind = messages.schema["video_id"].dataType.simpleString()
    rows = messages.withColumn("_bucket", F.when(F.col("video_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("video_id"), F.lit(buckets))))
    return rows.groupBy("_bucket").applyInPandasWithState(
        Assembly(idle_ms), outputStructType=f"video_id {kind}, status string, windows long, error string", stateStructType="videos binary", outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def assemble(messages: DataFrame) -> DataFrame:
    """The batch form, for videos of one start and one end at most: counts and first errors by video, no list of messages."""
    end = F.min(F.when(F.col("kind") == "end", F.col("seq"))).over(W.partitionBy("video_id"))
    rows = messages.withColumn("_end", end).filter("_end is null or seq <= _end")
    failed = F.min(F.when((F.col("kind") == "chunk") & F.col("error").isNotNull(), F.struct("seq", "error")))["error"]
    per = rows.groupBy("video_id").agg(
        F.count_if(F.col("kind") == "start").alias("starts"), F.count_if(F.col("kind") == "end").alias("ends"),
        F.coalesce(F.sum(F.when(F.col("kind") == "chunk", F.col("n"))), F.lit(0)).cast("long").alias("n"), failed.alias("chunk_error"),
        F.max(F.when(F.col("kind") == "end", F.col("error"))).alias("end_error"),
    )
    error = F.coalesce("chunk_error", "end_error", F.when(F.col("starts") == 0, "end without start"), F.when(F.col("n") == 0, "no windows"))
    done = per.filter("ends > 0").withColumn("error", error)
    return done.select("video_id", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), F.when(F.col("error").isNull(), F.col("n")).otherwise(F.lit(0)).alias("windows"), "error")
