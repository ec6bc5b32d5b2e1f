"""The tables seen as media, frames, segments, features and messages: as DataFrames, and as SQL for the oracles."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder where all executors can read and write, below spark.checkpoint.dir; only a session on one machine may lack that."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "clipfeat")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}/{name}"


def r6(c):
    return F.round(c, 6)


def media(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.col("n_chars").alias("total"))


def frames(spark, d, kind: str | None = None) -> DataFrame:
    """(video_id, frame_idx, pts, value): a user's events as frames; pts in seconds."""
    ev = table(spark, d, "events")
    ev = ev if kind is None else ev.filter(F.col("event_type") == kind)
    order = W.partitionBy("user_id").orderBy("ts")
    return ev.select(F.col("user_id").alias("video_id"), (F.row_number().over(order) - 1).cast("long").alias("frame_idx"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("pts"), "value")


FRAMES = "frames AS (SELECT user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS frame_idx, epoch_us(ts) / 1e6 AS pts, value FROM events)"
SHORT = FRAMES.replace("FROM events)", "FROM events WHERE event_type = 'error')")


#: Rows that make a task where whole tables are sorted by a key, and of a table that is sent to every task instead.
TASK_ROWS, SMALL_TABLE = 250_000, 1_000_000


def by_key(rows: DataFrame, n: int, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` to as many tasks as ``n`` rows need, so that what a task sorts doesn't grow with the table, whatever the
    session's number of shuffle partitions. Joins, windows and groups by that key then need no shuffle of their own."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-n // TASK_ROWS)), key)


def segments(spark, d) -> DataFrame:
    """Line items as segments of orders, some without a category; has_video and has_feature stand for files that exist. They stay
    dealt by video, in as many tasks as there are line items for."""
    li, o, p = (table(spark, d, t) for t in ("lineitem", "orders", "part"))
    n = max(li.count(), o.count())  # from the footers of the files
    if p.count() <= SMALL_TABLE:
        rows = li.join(F.broadcast(p), p.p_partkey == li.l_partkey)
    else:
        rows = by_key(li, n, "l_partkey").join(by_key(p, n, "p_partkey").hint("merge"), p.p_partkey == li.l_partkey)
    rows = by_key(rows, n, "l_orderkey").join(by_key(o, n, "o_orderkey").hint("merge"), li.l_orderkey == o.o_orderkey)
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rows.select(
        F.col("l_orderkey").alias("video_id"), F.concat_ws("_", "l_orderkey", F.row_number().over(order)).alias("seg_id"),
        F.when(F.col("o_orderkey") % 4 == 0, "validation").otherwise("training").alias("subset"), (F.col("o_totalprice") / 1000).alias("duration"),
        F.array(F.col("l_quantity") * 10, F.col("l_quantity") * 10 + F.col("l_discount") * 1000).alias("segment"), F.when(F.col("p_size") % 10 != 7, F.col("p_size")).cast("string").alias("recipe_type"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("sentence"), (F.col("o_custkey") % 10 != 0).alias("has_video"), (F.col("o_orderkey") % 7 != 0).alias("has_feature"),
        (F.col("l_suppkey") % 4 == 0).alias("other_subset"),
    )


SEGMENTS = """segs AS (
  SELECT l_orderkey AS video_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k,
    CASE WHEN o_orderkey % 4 = 0 THEN 'validation' ELSE 'training' END AS subset, o_totalprice / 1000 AS duration, l_quantity * 10 AS seg_start,
    l_quantity * 10 + l_discount * 1000 AS seg_end, CASE WHEN p_size % 10 <> 7 THEN CAST(p_size AS VARCHAR) END AS recipe_type, o_custkey % 10 <> 0 AS has_video, o_orderkey % 7 <> 0 AS has_feature,
    l_suppkey % 4 = 0 AS other_subset, 'line ' || l_linenumber AS sentence
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
judged AS (SELECT *, least(seg_end, duration) AS e, CASE WHEN NOT has_video THEN 'no_video' WHEN NOT has_feature THEN 'no_feature'
    WHEN NOT (least(seg_end, duration) > seg_start) THEN 'empty' ELSE 'kept' END AS outcome FROM segs)"""


def segment_media(segs: DataFrame) -> DataFrame:
    return segs.filter("has_video").select("video_id").distinct()


def segment_features(segs: DataFrame) -> DataFrame:
    """(video_id, modality): both modalities where has_feature, else the audio alone."""
    ids = segs.select("video_id", "has_feature").distinct()
    both = F.when(F.col("has_feature"), F.array(F.lit("visual"), F.lit("audio"))).otherwise(F.array(F.lit("audio")))
    return ids.select("video_id", F.explode(both).alias("modality"))


def categories(spark, d) -> DataFrame:
    """Names for part sizes up to 40."""
    return table(spark, d, "part").select(F.col("p_size").cast("string").alias("id")).distinct().filter("cast(id as int) <= 40").withColumn("name", F.concat(F.lit("dish "), F.col("id")))


def audio_features(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.expr("vec_id div 10").alias("video_id"), F.lit("audio").alias("modality"), (F.col("vec_id") % 10).alias("step"), F.col("embedding").cast("array<double>").alias("feature"), "label")


def visual_features(spark, d) -> DataFrame:
    a = audio_features(spark, d).filter("not (video_id % 5 = 0 and step >= 8) and video_id % 11 <> 10")
    return a.withColumn("modality", F.lit("visual")).withColumn("feature", F.transform("feature", lambda x: x * (20 + F.col("label"))))


def features(spark, d) -> DataFrame:
    return audio_features(spark, d).unionByName(visual_features(spark, d)).drop("label")


FEATURES = """audio AS (SELECT vec_id // 10 AS video_id, 'audio' AS modality, vec_id % 10 AS step, CAST(embedding AS DOUBLE[]) AS feature, label FROM embeddings),
visual AS (SELECT video_id, 'visual' AS modality, step, list_transform(feature, lambda x: x * (20 + label)) AS feature, label FROM audio
  WHERE NOT (video_id % 5 = 0 AND step >= 8) AND video_id % 11 <> 10),
features AS (SELECT video_id, modality, step, feature FROM audio UNION ALL SELECT video_id, modality, step, feature FROM visual)"""


def annotations(spark, d) -> DataFrame:
    """(video_id, duration): more ids than have features."""
    ids = table(spark, d, "embeddings").select(F.expr("vec_id div 8").alias("video_id")).distinct()
    return ids.withColumn("duration", F.lit(4.0) + (F.col("video_id") % 30) / F.lit(10.0))


ANNOTATIONS = "annos AS (SELECT DISTINCT vec_id // 8 AS video_id, 4e0 + (vec_id // 8 % 30) / 10e0 AS duration FROM embeddings)"


def messages(spark, d) -> DataFrame:
    """Turns as messages: the first starts a video, the last ends it, except where the number of the conversation says otherwise."""
    c = table(spark, d, "conversations")
    last = F.max("turn").over(W.partitionBy("conv_id"))
    chars = F.length("text")
    kind = F.when((F.col("turn") == 0) & (F.col("conv_id") % 9 != 0), "start").when(F.col("turn") == last, "end").otherwise("chunk")
    rows = c.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seq"), kind.alias("kind"), (chars % 5 + 1).cast("long").alias("n"), F.when(chars % 7 == 0, "broken").alias("error"))
    return rows.withColumn("error", F.when(F.col("kind") != "start", F.col("error")))


MESSAGES = """lasts AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
msgs AS (SELECT conv_id AS video_id, turn AS seq, CASE WHEN turn = 0 AND conv_id % 9 <> 0 THEN 'start' WHEN turn = last THEN 'end' ELSE 'chunk' END AS kind,
  length(text) % 5 + 1 AS n, length(text) AS chars FROM conversations JOIN lasts USING (conv_id)),
errs AS (SELECT *, CASE WHEN kind <> 'start' AND chars % 7 = 0 THEN 'broken' END AS error FROM msgs)"""
