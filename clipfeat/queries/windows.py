"""Queries on index arithmetic, clips, chunks, batches, rates and audio windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import windows as fw
from ..operators import audio, clips, qa
from ..operators import frames as fr
from . import query
from .standins import FRAMES, SHORT, frames, media, r6, table


@query("SELECT doc_id AS video_id, n_chars AS total, CAST(greatest(0, floor((n_chars - 16) / 8.0)) + 1 AS BIGINT) AS n_clips FROM documents")
def num_windows(spark, d):
    return media(spark, d).withColumn("n_clips", fw.num_windows("total", 16, 8))


@query("""SELECT doc_id AS video_id, CAST(greatest(0, floor((CAST(trunc(n_chars / 7.0 * 16) AS BIGINT) - 16) / 8.0)) + 1 AS BIGINT) AS n_clips,
  CAST(greatest(0, floor((coalesce(CAST(trunc(CASE WHEN n_chars % 5 > 0 THEN n_chars / 7e0 END * 16) AS BIGINT), 0) - 16) / 4.0)) + 1 AS BIGINT) AS n_null FROM documents""")
def expected_clips(spark, d):
    rows = media(spark, d).withColumn("duration", F.col("total") / 7.0)
    null = F.when(F.col("total") % 5 > 0, F.col("duration"))
    return rows.select("video_id", fw.expected_clips("duration").cast("long").alias("n_clips"), fw.expected_clips(null, stride=4).alias("n_null"))


@query("SELECT doc_id AS video_id, CAST(least(greatest(0, floor((CAST(trunc(n_chars / 7.0 * 16) AS BIGINT) - 16) / 8.0)) + 1, 400) AS BIGINT) AS n_clips FROM documents")
def limit_expected_clips(spark, d):
    rows = media(spark, d).withColumn("duration", F.col("total") / 7.0)
    return rows.select("video_id", fw.expected_clips("duration", max_clips=400).cast("long").alias("n_clips"))


@query("SELECT doc_id AS video_id, CAST(greatest(0, floor((n_chars / 7e0 * 16 - 16) / 8)) + 1 AS BIGINT) AS expected FROM documents")
def expected_steps(spark, d):
    return media(spark, d).select("video_id", fw.expected_steps(F.col("total") / 7.0).alias("expected"))


@query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) * 16 + 64 AS w, CAST(l_discount * 100 AS INTEGER) * 50 + 72 AS h FROM lineitem),
n AS (SELECT w, h, CAST(floor(w * (256e0 / least(w, h)) + 0.5) AS INTEGER) AS nw, CAST(floor(h * (256e0 / least(w, h)) + 0.5) AS INTEGER) AS nh,
  CASE WHEN w <= h THEN 256 ELSE CAST(floor(w * 256 / CAST(h AS DOUBLE) / 2 + 0.5) * 2 AS INTEGER) END AS ew, CASE WHEN w <= h THEN CAST(floor(h * 256 / CAST(w AS DOUBLE) / 2 + 0.5) * 2 AS INTEGER) ELSE 256 END AS eh FROM g)
SELECT w, h, nw, nh, CAST(floor((nw - 256) / 2.0) AS INTEGER) AS crop_left, CAST(floor((nh - 256) / 2.0) AS INTEGER) AS crop_top, ew, eh, count(*) AS n FROM n GROUP BY ALL""")
def resize_geometry(spark, d):
    g = table(spark, d, "lineitem").select((F.col("l_quantity").cast("int") * 16 + 64).alias("w"), (F.round(F.col("l_discount") * 100).cast("int") * 50 + 72).alias("h"))
    g = g.groupBy("w", "h").agg(F.count(F.lit(1)).alias("n")).withColumn("a", fw.resize_geometry("w", "h")).withColumn("b", fw.resize_geometry("w", "h", mode="even"))
    return g.select("w", "h", F.col("a.new_width").alias("nw"), F.col("a.new_height").alias("nh"), F.col("a.left").alias("crop_left"), F.col("a.top").alias("crop_top"), F.col("b.new_width").alias("ew"), F.col("b.new_height").alias("eh"), "n")


@query(f"""WITH {FRAMES}, t AS (SELECT *, pts - min(pts) OVER (PARTITION BY video_id) AS since FROM frames), c AS (SELECT * FROM t WHERE since >= 86400 AND since < 604800)
SELECT video_id, frame_idx - min(frame_idx) OVER (PARTITION BY video_id) AS frame_idx, value FROM c""")
def cut_seconds(spark, d):
    """From one day to seven days after each user's first event."""
    return clips.cut_seconds(frames(spark, d), 86_400, 518_400).select("video_id", "frame_idx", "value")


@query(f"WITH {FRAMES} SELECT video_id, frame_idx - 32 AS frame_idx, value FROM frames WHERE frame_idx >= 32 AND frame_idx < 48")
def trim_time(spark, d):
    return clips.cut_range(frames(spark, d), 2.0, 1.0, 16).select("video_id", "frame_idx", "value")


@query(f"WITH {FRAMES} SELECT video_id, frame_idx, round((value - 122.771e0) / 68.5e0, 6) AS r, round((value - 116.746e0) / 66.632e0, 6) AS g, round((value - 104.094e0) / 70.323e0, 6) AS b FROM frames")
def normalize_pixels(spark, d):
    return frames(spark, d).select("video_id", "frame_idx", *[r6(fw.normalize_pixel("value", k)).alias(c) for k, c in enumerate("rgb")])


@query(f"WITH {FRAMES} SELECT video_id, frame_idx AS clip_idx, round(1.5e0 + frame_idx * 8 / 16e0, 6) AS sec FROM frames")
def clip_time(spark, d):
    return frames(spark, d).select("video_id", F.col("frame_idx").alias("clip_idx"), r6(fw.clip_time("frame_idx", start_sec=1.5)).alias("sec"))


@query("SELECT DISTINCT l_quantity AS stride, CAST(round_even(l_quantity / 16e0 * 16000, 0) AS BIGINT) AS samples, l_quantity / 16e0 AS stride_sec, CAST(round_even(l_quantity * 0.00003125e0 * 16000, 0) AS BIGINT) AS half FROM lineitem")
def audio_params(spark, d):
    q = table(spark, d, "lineitem").select(F.col("l_quantity").alias("stride")).distinct()
    return q.select("stride", fw.seconds_to_samples(fw.stride_seconds("stride")).alias("samples"), fw.stride_seconds("stride").alias("stride_sec"), fw.seconds_to_samples(F.col("stride") * 0.00003125).alias("half"))


def _clips_sql(base: str, nf: int, stride: int) -> str:
    return f"""WITH {base}, t AS (SELECT video_id, count(*) AS total, CAST(greatest(0, floor((count(*) - {nf}) / {stride}.0)) + 1 AS BIGINT) AS n FROM frames GROUP BY video_id),
c AS (SELECT video_id, total, unnest(range(n)) AS clip_idx FROM t), p AS (SELECT *, unnest(range({nf})) AS pos FROM c),
x AS (SELECT p.video_id, clip_idx, pos, frame_idx, value FROM p JOIN frames f ON f.video_id = p.video_id AND f.frame_idx = least(clip_idx * {stride} + pos, total - 1))
SELECT video_id, clip_idx, count(*) AS n, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame, sum(pos * frame_idx)::BIGINT AS mix, round(avg(value), 6) AS mean FROM x GROUP BY ALL"""


def _clips(rows, nf, stride):
    w = clips.clip_windows(rows, nf, stride).join(rows.select("video_id", "frame_idx", "value"), ["video_id", "frame_idx"])
    return w.groupBy("video_id", "clip_idx").agg(F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_frame"), F.max("frame_idx").alias("last_frame"), F.sum(F.col("pos") * F.col("frame_idx")).alias("mix"), r6(F.avg("value")).alias("mean"))


@query(_clips_sql(FRAMES, 16, 8))
def clip_windows(spark, d):
    return _clips(frames(spark, d), 16, 8)


@query(_clips_sql(SHORT, 16, 20))
def clip_windows_short(spark, d):
    return _clips(frames(spark, d, "error"), 16, 20)


@query("""WITH t AS (SELECT doc_id AS video_id, n_chars AS total, CAST(greatest(0, floor((n_chars - 16) / 8.0)) + 1 AS BIGINT) AS n FROM documents WHERE n_chars > 0),
c AS (SELECT *, unnest(range(0, n, 30)) AS first_clip FROM t)
SELECT video_id, first_clip // 30 AS chunk_id, first_clip, least(30, n - first_clip) AS n_clips, first_clip * 8 AS first_frame,
  least((least(30, n - first_clip) - 1) * 8 + 16, total - first_clip * 8) AS n_frames FROM c""")
def clip_chunks(spark, d):
    return clips.chunk_plan(media(spark, d), 16, 8, 30)


@query("""WITH t AS (SELECT doc_id AS video_id, n_chars AS total, least(CAST(greatest(0, floor((n_chars - 16) / 8.0)) + 1 AS BIGINT), 1000) AS n FROM documents WHERE n_chars > 0),
c AS (SELECT *, unnest(range(0, n, 30)) AS first_clip FROM t)
SELECT video_id, first_clip // 30 AS chunk_id, first_clip, least(30, n - first_clip) AS n_clips, first_clip * 8 AS first_frame,
  least((least(30, n - first_clip) - 1) * 8 + 16, total - first_clip * 8) AS n_frames FROM c""")
def limit_chunks(spark, d):
    return clips.chunk_plan(media(spark, d), 16, 8, 30, limit=1000)


@query(f"WITH {FRAMES} SELECT video_id, frame_idx // 7 AS batch_id, count(*) AS n, min(frame_idx) AS first_frame FROM frames GROUP BY ALL")
def batches(spark, d):
    return clips.batches(frames(spark, d), 7, ["frame_idx"]).groupBy("video_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_frame"))


@query(f"WITH {FRAMES} SELECT video_id, frame_idx // 7 AS batch_id, count(*) AS n, min(frame_idx) AS first_frame FROM frames WHERE frame_idx < 60 GROUP BY ALL")
def limit_batches(spark, d):
    return clips.batches(frames(spark, d), 7, ["frame_idx"], limit=60).groupBy("video_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_frame"))


@query(f"""WITH {FRAMES}, k AS (SELECT *, CAST(floor((pts - min(pts) OVER (PARTITION BY video_id)) * (1 / 3600e0) + 0.5) AS BIGINT) AS tick FROM frames),
l AS (SELECT video_id, tick, arg_max(frame_idx, pts) AS frame_idx, arg_max(value, pts) AS value FROM k GROUP BY video_id, tick),
m AS (SELECT *, coalesce(lead(tick) OVER (PARTITION BY video_id ORDER BY tick) - 1, tick) AS till FROM l)
SELECT video_id, unnest(range(tick, till + 1)) AS tick, frame_idx, value FROM m""")
def resample_fps(spark, d):
    return clips.resample_fps(frames(spark, d), 1 / 3600).select("video_id", "tick", "frame_idx", "value")


@query(_clips_sql(FRAMES, 16, 4).replace("SELECT video_id, clip_idx, count(*)", "SELECT video_id, clip_idx, count(*)").replace("FROM x GROUP BY ALL", "FROM x WHERE clip_idx < 5 GROUP BY ALL"))
def limit_clips(spark, d):
    return clips.first_clips(_clips(frames(spark, d), 16, 4), 5)


@query("SELECT s AS stride, CAST(sum(greatest(0, floor((n_chars - 16) / s)) + 1) AS BIGINT) AS clips, CAST(sum(greatest(0, floor((n_chars - 16) / s)) + 1) AS BIGINT) * 1536 * 4 AS bytes FROM (SELECT n_chars, unnest([4, 8]) AS s FROM documents) GROUP BY s")
def storage_budget(spark, d):
    return qa.storage_budget(media(spark, d))


def _waves(spark, d, kind=None):
    """Blocks of 10 samples of each user's values."""
    rows = frames(spark, d, kind)
    blocks = rows.groupBy("video_id", F.floor(F.col("frame_idx") / 10).cast("int").alias("block_id")).agg(F.array_sort(F.collect_list(F.struct("frame_idx", "value"))).alias("v"))
    return blocks.select("video_id", "block_id", (F.col("block_id").cast("long") * 10).alias("sample_offset"), F.transform("v", lambda x: x["value"].cast("float")).alias("samples"))


#: The samples of each window, from frames.
WINDOWS = """t AS (SELECT video_id, count(*) AS total, CAST(greatest(0, floor((count(*) - 16) / 8.0)) + 1 AS BIGINT) AS n FROM frames GROUP BY video_id),
p AS (SELECT video_id, total, step, unnest(range(16)) AS pos FROM (SELECT video_id, total, unnest(range(n)) AS step FROM t)),
x AS (SELECT p.video_id, step, pos, CAST(value AS FLOAT)::DOUBLE AS value FROM p JOIN frames f ON f.video_id = p.video_id AND f.frame_idx = (step * 8 + pos) % total)"""


def _audio_sql(base: str) -> str:
    return f"""WITH {base}, {WINDOWS} SELECT video_id, step, count(*) AS n, round(sum(value * (pos + 1)), 4) AS weighted FROM x GROUP BY ALL"""


def _audio(blocks):
    w = audio.audio_windows(blocks, 16, 8, normalize=False)
    return w.select("video_id", "step", F.size("samples").cast("long").alias("n"), F.round(F.aggregate(F.transform("samples", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda s, x: s + x), 4).alias("weighted"))


@query(_audio_sql(FRAMES))
def audio_windows(spark, d):
    return _audio(_waves(spark, d))


@query(_audio_sql(SHORT))
def audio_windows_short(spark, d):
    return _audio(_waves(spark, d, "error"))


@query(f"""WITH {FRAMES}, x AS (SELECT video_id, frame_idx // 16 AS step, frame_idx % 16 AS pos, value FROM frames)
SELECT video_id, step, pos, round((value - avg(value) OVER w) / sqrt(var_pop(value) OVER w + 1e-5), 5) AS value FROM x WINDOW w AS (PARTITION BY video_id, step)""")
def layer_norm_windows(spark, d):
    rows = frames(spark, d).select("video_id", F.floor(F.col("frame_idx") / 16).alias("step"), (F.col("frame_idx") % 16).alias("pos"), "value")
    return audio.layer_norm_long(rows).withColumn("value", F.round("value", 5))


@query("""WITH v AS (SELECT doc_id AS video_id, CASE WHEN n_chars % 4 > 0 THEN n_chars / 1000e0 END AS duration FROM documents WHERE n_chars % 3 = 0),
t AS (SELECT video_id, CAST(trunc(duration * 16000) AS BIGINT) AS total FROM v)
SELECT video_id, count(*) AS blocks, sum(least(65536, total - o))::BIGINT AS zeros FROM (SELECT video_id, total, unnest(range(0, total, 65536)) AS o FROM t WHERE total > 0) GROUP BY video_id""")
def silence_fallback(spark, d):
    v = media(spark, d).select("video_id", F.when(F.col("total") % 4 > 0, F.col("total") / 1000.0).alias("duration"), (F.col("total") % 3 != 0).alias("has_audio"))
    s = audio.silence_fallback(v)
    return s.groupBy("video_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.size(F.filter("samples", lambda x: x == 0)).cast("long")).alias("zeros"))


def pcm_digest() -> str:
    """SQL: a weighted sum of the stereo samples (left and right added) in the bytes of a text, from its hexadecimal digits ``h``."""
    half = lambda at: f"(CAST('0x' || c[{at + 2}:{at + 3}] || c[{at}:{at + 1}] AS INTEGER) + 32768) % 65536 - 32768"
    return f"CAST(coalesce(list_sum(list_transform(regexp_extract_all(h, '.{{8}}'), lambda c, i: ((i - 1) % 7 + 1) * ({half(1)} + {half(5)}))), 0) AS BIGINT)"


def weighted_samples(samples, first, scale: int = 1 << 16):
    """The sum of samples, as whole numbers of 1/scale, times 1 to 7 in turn from the place ``first`` on."""

    @F.pandas_udf("long")
    def weighted(x: pd.Series, at: pd.Series) -> pd.Series:
        def one(v, a):
            if v is None or a is None:
                return None
            whole = np.trunc(np.asarray(v, np.float64) * scale).astype(np.int64)
            return int(whole @ ((int(a) + np.arange(len(whole))) % 7 + 1))

        return pd.Series([one(*r) for r in zip(x, at, strict=True)], dtype="Int64")

    return weighted(samples, first)


@query(f"SELECT doc_id AS video_id, octet_length(encode(text)) // 4 AS n, {pcm_digest()} AS weighted FROM (SELECT doc_id, text, hex(encode(text)) AS h FROM documents)")
def pcm_to_mono(spark, d):
    """The bytes of each text as 16-bit stereo PCM; every sample counts in the sum."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), audio.pcm_to_mono(2)(F.encode("text", "UTF-8")).alias("samples"))
    return rows.select("video_id", F.size("samples").cast("long").alias("n"), weighted_samples(F.col("samples"), F.lit(0)).alias("weighted"))


BESSEL = "list_sum(list_transform(range(60), lambda k: exp(2 * (k * ln({0} / 2) - lgamma(k + 1)))))"


def _resampled_sql(up: int, down: int, zeros: int, beta: float, rolloff: float) -> str:
    return f"""WITH {FRAMES}, f AS (SELECT {rolloff!r}e0 * least(1e0, {up} / {down}e0) AS cut, {beta!r}e0 AS beta), h AS (SELECT *, CAST(ceil({zeros} / cut) AS BIGINT) AS half FROM f),
g AS (SELECT phase, tap_at, tap_at - phase / {up}e0 AS x, h.* FROM h, (SELECT unnest(range({up})) AS phase), (SELECT unnest(range(-300, 301)) AS tap_at) WHERE abs(tap_at) <= half),
taps AS (SELECT phase, tap_at, CASE WHEN abs(x * cut) > {zeros} THEN 0e0 ELSE cut * (CASE WHEN x = 0 THEN 1e0 ELSE sin(pi() * cut * x) / (pi() * cut * x) END)
  * {BESSEL.format(f'greatest(1e-9, beta * sqrt(greatest(0, 1 - (x * cut / {zeros}) * (x * cut / {zeros}))))')} / {BESSEL.format('beta')} END AS tap FROM g),
o AS (SELECT video_id, unnest(range(CAST(ceil(count(*) * {up} / {down}.0) AS BIGINT))) AS j FROM frames GROUP BY video_id),
y AS (SELECT o.video_id, j, CAST(sum(CAST(value AS FLOAT)::DOUBLE * tap) AS FLOAT)::DOUBLE AS y FROM o JOIN frames USING (video_id) JOIN taps ON phase = (j * {down}) % {up} AND tap_at = frame_idx - (j * {down}) // {up} GROUP BY o.video_id, j)
SELECT video_id, count(*) AS n, round(sum(y * (j % 7 + 1)), 2) AS weighted FROM y GROUP BY video_id"""


def _resampled(blocks):
    each = F.transform("samples", lambda x, i: x.cast("double") * ((F.col("sample_offset") + i) % 7 + 1))
    return blocks.groupBy("video_id").agg(F.sum(F.size("samples").cast("long")).alias("n"), F.round(F.sum(F.aggregate(each, F.lit(0.0), lambda a, x: a + x)), 2).alias("weighted"))


@query(_resampled_sql(2, 3, *audio.FILTERS["kaiser_best"]))
def resample_audio(spark, d):
    """Each user's values resampled from 24 kHz to 16 kHz; every output sample counts in the sum."""
    return _resampled(audio.resample_blocks(_waves(spark, d), 24_000, 16_000))


@query(_resampled_sql(160, 441, *audio.FILTERS["kaiser_best"]))
def resample_audio_cd(spark, d):
    """From 44.1 kHz, whose ratio to 16 kHz has 160 phases."""
    return _resampled(audio.resample_blocks(_waves(spark, d), 44_100, 16_000))


@query(_resampled_sql(160, 441, *audio.FILTERS["kaiser_fast"]))
def resample_audio_fast(spark, d):
    return _resampled(audio.resample_blocks(_waves(spark, d), 44_100, 16_000, res_type="kaiser_fast"))


@query("""WITH i AS (SELECT doc_id, regexp_extract_all(list_aggregate(list_transform(range(36), lambda k: md5(text || k)), 'string_agg', ''), '..') AS p FROM documents),
axes AS (SELECT o, (o + 0.5e0) * 12 / 16 - 0.5e0 AS y, (o + 2 + 0.5e0) * 16 / 21 - 0.5e0 AS x FROM (SELECT unnest(range(16)) AS o)),
rows AS (SELECT o AS r, CAST(greatest(0, least(11, floor(y))) AS INTEGER) AS y0, CAST(greatest(0, least(11, floor(y) + 1)) AS INTEGER) AS y1, CAST(y - floor(y) AS FLOAT) AS fy FROM axes),
cols AS (SELECT o AS c, CAST(greatest(0, least(15, floor(x))) AS INTEGER) AS x0, CAST(greatest(0, least(15, floor(x) + 1)) AS INTEGER) AS x1, CAST(x - floor(x) AS FLOAT) AS fx FROM axes),
v AS (SELECT doc_id, (r * 16 + c) * 3 + k AS place, fx, fy, CAST(CAST('0x' || p[(y0 * 16 + x0) * 3 + k + 1] AS INTEGER) AS FLOAT) AS a, CAST(CAST('0x' || p[(y1 * 16 + x0) * 3 + k + 1] AS INTEGER) AS FLOAT) AS b,
  CAST(CAST('0x' || p[(y0 * 16 + x1) * 3 + k + 1] AS INTEGER) AS FLOAT) AS e, CAST(CAST('0x' || p[(y1 * 16 + x1) * 3 + k + 1] AS INTEGER) AS FLOAT) AS f FROM i, rows, cols, (SELECT unnest(range(3)) AS k)),
w AS (SELECT doc_id, place, fx, a * (1::FLOAT - fy) + b * fy AS l, e * (1::FLOAT - fy) + f * fy AS h FROM v),
z AS (SELECT doc_id, place, least(255, CAST(floor(l * (1::FLOAT - fx) + h * fx + 0.5::FLOAT) AS BIGINT)) AS level FROM w)
SELECT doc_id AS video_id, 0::BIGINT AS frame_idx, 16 AS height, 16 AS width, count(*) AS bytes, CAST(sum(level * (place % 7 + 1)) AS BIGINT) AS weighted FROM z GROUP BY doc_id""")
def resize_crop(spark, d):
    """A small image from MD5 sums of each text, resized and cropped; every level counts in the sum."""
    pixels = F.unhex(F.concat(*[F.md5(F.concat("text", F.lit(str(k)))) for k in range(36)]))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.lit(0).cast("long").alias("frame_idx"), F.lit(0.0).alias("pts"), F.lit(12).alias("height"), F.lit(16).alias("width"), pixels.alias("pixels"))
    out = fr.resize_frames(rows, 16)
    levels = F.transform(F.regexp_extract_all(F.hex("pixels"), F.lit(".."), F.lit(0)), lambda x, i: F.conv(x, 16, 10).cast("long") * (i % 7 + 1))
    return out.select("video_id", "frame_idx", "height", "width", F.length("pixels").cast("long").alias("bytes"), F.aggregate(levels, F.lit(0).cast("long"), lambda a, x: a + x).alias("weighted"))
