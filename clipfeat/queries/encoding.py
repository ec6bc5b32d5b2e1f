"""Queries that run encoders, heads and user functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..jobs import extract
from ..operators import encode
from ..sources import store
from . import query
from .sources import FOLDERS, _touch, wav_file
from .standins import FRAMES, frames, r6, scratch, table
from .windows import WINDOWS, _waves


def _pixel_frames(spark, d):
    """Each event as a frame of 2 by 2 pixels of one grey level."""
    level = F.greatest(F.lit(0), F.least(F.lit(255), F.floor("value"))).cast("int")
    pixel = F.unhex(F.lpad(F.hex(level), 2, "0"))
    return frames(spark, d).select("video_id", "frame_idx", "pts", F.lit(2).alias("height"), F.lit(2).alias("width"), F.concat(*[pixel] * 12).alias("pixels"))


@query(f"""WITH {FRAMES}, t AS (SELECT video_id, count(*) AS total FROM frames GROUP BY video_id), n AS (SELECT *, CAST(greatest(0, floor((total - 16) / 8.0)) + 1 AS BIGINT) AS n FROM t),
p AS (SELECT video_id, step, unnest(range(16)) AS pos, total FROM (SELECT *, unnest(range(n)) AS step FROM n)),
x AS (SELECT p.video_id, step, greatest(0, least(255, floor(value))) AS g FROM p JOIN frames f ON f.video_id = p.video_id AND f.frame_idx = least(step * 8 + pos, total - 1))
SELECT video_id, step, round(avg((g - 122.771e0) / 68.5e0 + (g - 116.746e0) / 66.632e0 + (g - 104.094e0) / 70.323e0) / 3, 4) AS mean, NULL::VARCHAR AS error FROM x GROUP BY ALL""")
def encode_clips(spark, d):
    """Chunks of frames through an encoder that gives the mean of its input."""
    f = _pixel_frames(spark, d)
    chunks = encode.gather_chunks(f, 16, 8, 3)
    mean = lambda: lambda x: x.reshape(len(x), -1).mean(axis=1, keepdims=True)
    return encode.encode_clips(chunks, mean, 16, 8, 3).select("video_id", "step", F.round(F.col("feature")[0].cast("double"), 4).alias("mean"), "error")


@query(f"""WITH {FRAMES}, {WINDOWS}, n AS (SELECT video_id, step, pos, CAST((value - avg(value) OVER w) / sqrt(var_pop(value) OVER w + 1e-5) AS FLOAT)::DOUBLE AS x FROM x WINDOW w AS (PARTITION BY video_id, step)),
v AS (SELECT video_id, step, d, CAST(sum(x * cos(pos * (d + 1))) AS FLOAT)::DOUBLE AS v FROM n, (SELECT unnest(range(64)) AS d) GROUP BY ALL),
u AS (SELECT video_id, step, d, CAST(CASE WHEN sum(v * v) OVER w > 0 THEN v / sqrt(sum(v * v) OVER w) ELSE v END AS FLOAT)::DOUBLE AS u FROM v WINDOW w AS (PARTITION BY video_id, step))
SELECT video_id, step, count(*) AS dim, round(sum(u * (d % 7 + 1)), 4) AS weighted, NULL::VARCHAR AS error FROM u GROUP BY ALL""")
def encode_audio(spark, d):
    """Audio windows through the projection encoder; every element of the unit vectors counts in the sum."""
    e = encode.encode_sound(_waves(spark, d), encode.projection_encoder(64), 16, 8)
    each = F.transform("feature", lambda x, i: x.cast("double") * (i % 7 + 1))
    return e.select("video_id", "step", F.size("feature").cast("long").alias("dim"), F.round(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), 4).alias("weighted"), "error")


def _staged(spark, rows):
    """``rows`` as a written table: a job reads its frames several times, and numbering them anew each time would sort them all."""
    where = scratch(spark, "frames")
    rows.write.parquet(where)
    return spark.read.schema(rows.schema).parquet(where)


@query(f"""WITH {FRAMES}, t AS (SELECT video_id, CAST(greatest(0, floor((count(*) - 16) / 8.0)) + 1 AS BIGINT) AS n, video_id % 17 = 3 AND count(*) > 5 AS broken FROM frames GROUP BY video_id)
SELECT CAST(video_id AS VARCHAR) AS video_id, 'visual' AS modality, CASE WHEN broken THEN 'failed' ELSE 'ok' END AS status, CASE WHEN broken THEN 0 ELSE n END AS windows, CASE WHEN broken THEN 0 ELSE n END AS stored FROM t""")
def extract_visual_job(spark, d):
    """The whole visual job over all events as frames, of which some videos have a damaged one; the ledger and the store, read back."""
    f = _pixel_frames(spark, d).withColumn("video_id", F.col("video_id").cast("string"))
    damaged = (F.col("video_id").cast("long") % 17 == 3) & (F.col("frame_idx") == 5)
    f = _staged(spark, f.withColumn("pixels", F.when(damaged, F.substring("pixels", 1, 5)).otherwise(F.col("pixels"))))
    return _recorded(spark, lambda out, ledger: extract.extract_visual(f.select("video_id").distinct(), f, encode.projection_encoder(8), out, ledger, size=2))


_GAPS = " UNION ALL ".join(
    f"""SELECT CAST(video_id AS VARCHAR) AS video_id, {s} AS stride, CASE WHEN lost > 0 AND until > there THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN lost > 0 AND until > there THEN 0 ELSE CAST(greatest(0, floor((there - 16) / {s}.0)) + 1 AS BIGINT) END AS windows FROM t WHERE there > 0"""
    for s in (4, 16, 20)
)


@query(f"""WITH {FRAMES}, k AS (SELECT *, video_id % 5 = 2 AND frame_idx >= 32 AND frame_idx < 64 OR video_id % 7 = 3 AND frame_idx = 17 AS gone FROM frames),
t AS (SELECT video_id, count(*) FILTER (gone) AS lost, count(*) FILTER (NOT gone) AS there, max(frame_idx) FILTER (NOT gone) + 1 AS until FROM k GROUP BY video_id) {_GAPS}""")
def extract_visual_gaps(spark, d):
    """The visual job where videos have lost frames: whole chunks, and a frame that lies between two clips at a stride of 20."""
    f = _pixel_frames(spark, d)
    lost = (F.col("video_id") % 5 == 2) & F.col("frame_idx").between(32, 63) | (F.col("video_id") % 7 == 3) & (F.col("frame_idx") == 17)
    f = _staged(spark, f.filter(~lost).withColumn("video_id", F.col("video_id").cast("string")))
    parts = []
    for stride in (4, 16, 20):
        job = lambda out, ledger: extract.extract_visual(f.select("video_id").distinct(), f, encode.projection_encoder(8), out, ledger, size=2, stride=stride, clips_per_chunk=2)  # noqa: B023, E731
        parts.append(_recorded(spark, job).select("video_id", F.lit(stride).alias("stride"), "status", F.col("stored").alias("windows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _recorded(spark, job):
    """(video_id, modality, status, windows, stored) of a job's ledger, with the vectors that readers of its store see."""
    out, ledger = scratch(spark, "job"), scratch(spark, "job-ledger")
    job(out, ledger)
    lines = store.read_ledger(spark, ledger)
    kept = store.read_features(spark, f"{out}/store", lines).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
    rows = lines.join(kept, "video_id", "left").select("video_id", "modality", "status", "windows", F.when(F.col("status") == "silent", 0).otherwise(F.coalesce("n", F.lit(0))).alias("stored"))
    return rows.withColumn("stored", F.col("stored").cast("long"))


@query("""WITH v AS (SELECT doc_id, n_chars, doc_id % 10 AS k, CASE WHEN doc_id % 10 = 3 THEN 0 ELSE octet_length(encode(text)) // 4 END AS frames FROM documents),
t AS (SELECT *, k <> 7 AND frames = 0 AS silent, CASE WHEN k = 7 THEN 0 WHEN frames = 0 THEN n_chars * 16 ELSE frames * 2 END AS total FROM v),
w AS (SELECT *, CASE WHEN total > 0 THEN CAST(greatest(0, floor((total - 1600) / 800.0)) + 1 AS BIGINT) ELSE 0 END AS n FROM t)
SELECT CAST(doc_id AS VARCHAR) AS video_id, 'audio' AS modality, CASE WHEN n > 0 THEN 'ok' ELSE 'failed' END AS status, n AS windows, n AS stored FROM w
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'audio', 'silent', 0, 0 FROM w WHERE silent""")
def extract_audio_job(spark, d):
    """The whole audio job: a WAV file of each text's bytes at 8 kHz, some videos without a track, some files that are no sound."""
    i, raw, where = F.col("doc_id"), F.encode("text", "UTF-8"), scratch(spark, "sound")
    rows = table(spark, d, "documents").select(i.cast("string").alias("video_id"), "n_chars", raw.alias("raw"), (i % 10).alias("k"), F.pmod(i, F.lit(FOLDERS)).cast("string").alias("folder"))
    name = F.concat("folder", F.lit("/"), "video_id", F.lit(".wav"))
    _touch(rows.filter("k <> 3").select(name.alias("name"), F.when(F.col("k") == 7, F.lit(b"no sound")).otherwise(wav_file()("raw")).alias("data")), where)
    files = rows.select("video_id", F.when(F.col("k") != 3, F.concat(F.lit(where + "/"), name)).alias("path"), (F.col("n_chars") / 1000.0).alias("duration"))
    return _recorded(spark, lambda out, ledger: extract.extract_audio(files.select("video_id"), files, encode.projection_encoder(8), out, ledger, 1600, 800))


@query("""SELECT doc_id AS item, unnest(range(CASE WHEN doc_id % 10 = 7 THEN 2 ELSE doc_id % 3 END)) AS seq, NULL::VARCHAR AS error FROM documents
UNION ALL SELECT doc_id, 2, 'ValueError(''item ' || doc_id || ''')' FROM documents WHERE doc_id % 10 = 7""")
def map_items(spark, d):
    """Some outputs per item; items ending in 7 fail after two."""

    def fn(x):
        for k in range(2 if x % 10 == 7 else x % 3):
            yield k
        if x % 10 == 7:
            raise ValueError(f"item {x}")

    return encode.map_items(table(spark, d, "documents"), fn, "long", "doc_id").select("item", "seq", "error")


@query("""SELECT doc_id, unnest(range(doc_id % 4)) AS seq, (doc_id % 4) * 10 + unnest(range(doc_id % 4)) AS output, NULL::VARCHAR AS error FROM documents
UNION ALL SELECT doc_id, doc_id % 4, NULL, 'ValueError(' || chr(39) || 'item ' || doc_id || chr(39) || ')' FROM documents WHERE doc_id % 10 = 7""")
def map_items_sql(spark, d):
    """The same from SQL, as a table function beside the table it is applied to."""

    def fn(x):
        yield from (x % 4 * 10 + k for k in range(x % 4))
        if x % 10 == 7:
            raise ValueError(f"item {x}")

    encode.register_mapper(spark, "clipfeat_map_items", fn, "long")
    table(spark, d, "documents").select("doc_id").createOrReplaceTempView("clipfeat_items")
    return spark.sql("SELECT t.doc_id, m.seq, m.output, m.error FROM clipfeat_items t, LATERAL clipfeat_map_items(t.doc_id) m")


_HEAD = [[((c * 7 + i * 3) % 11 - 5) / 10 for i in range(64)] for c in range(12)]


@query("""WITH h AS (SELECT c, list_transform(range(64), lambda i: ((c * 7 + i * 3) % 11 - 5) / 10e0) AS w, c / 100e0 AS b FROM (SELECT unnest(range(12)) AS c)),
l AS (SELECT vec_id, c, list_dot_product(CAST(embedding AS DOUBLE[]), w) + b AS z FROM embeddings, h),
p AS (SELECT vec_id, c, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM l), q AS (SELECT vec_id, c, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, c) AS rank FROM q)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(c AS INTEGER) AS class_id, 'class ' || c AS name, round(p, 6) AS probability, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
FROM r JOIN embeddings USING (vec_id) WHERE rank <= 5""")
def topk_classes(spark, d):
    classes = table(spark, d, "embeddings").select(F.col("label").alias("class_id")).distinct().unionByName(spark.range(12).select(F.col("id").cast("int").alias("class_id"))).distinct().withColumn("name", F.concat(F.lit("class "), F.col("class_id").cast("string")))
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("feature"))
    out = encode.topk_classes(rows, np.array(_HEAD), np.arange(12) / 100, classes)
    return out.select("vec_id", "rank", "class_id", "name", r6("probability").alias("probability"), r6("norm").alias("norm"))
