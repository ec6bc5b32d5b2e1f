"""Queries that write files derived from the tables and read them back."""

from __future__ import annotations

import io
import wave

import pandas as pd
from pyspark.sql import functions as F

from ..sources import media, npy, store
from ..streaming.resume import resumable
from . import query
from .standins import FEATURES, features, scratch, table
from .windows import pcm_digest, weighted_samples


#: Folders that many small files are dealt to, so that as many tasks list them.
FOLDERS = 64


def _touch(rows, directory: str):
    """Write a small file for each row (name, data) and return how many there are; a name may begin with a folder."""

    def run(batches):
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(directory)
        fs.create_dir(base, recursive=True)
        there = set()
        for pdf in batches:
            for name, raw in pdf.itertuples(index=False, name=None):
                folder = name.rpartition("/")[0]
                if folder and folder not in there:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    there.add(folder)
                with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                    f.write(bytes(raw))
            yield pd.DataFrame({"n": [len(pdf)]})

    return rows.select("name", "data").mapInPandas(run, "n long").agg(F.sum("n")).first()[0]


def wav_file(rate: int = 8000, channels: int = 2):
    """A pandas UDF from 16-bit PCM to the bytes of a WAV file; a last incomplete frame is left out."""

    @F.pandas_udf("binary")
    def wav(pcm: pd.Series) -> pd.Series:
        def one(b):
            out = io.BytesIO()
            with wave.open(out, "wb") as w:
                w.setnchannels(channels)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes(bytes(b[: len(b) // (2 * channels) * 2 * channels]))
            return out.getvalue()

        return pcm.map(one)

    return wav


@query("SELECT CASE WHEN page_id % 2 = 0 THEN '_' ELSE '-' END || page_id || '.5_x' AS video_id, page_id % 7 AS length FROM pages WHERE page_id % 3 < 2")
def media_ids(spark, d):
    """A file per page; names begin with a prefix and then often with _ or -; the others are not media."""
    p = table(spark, d, "pages")
    i = F.col("page_id")
    stem = F.concat(F.lit("Y"), F.when(i % 2 == 0, "_").otherwise("-"), i.cast("string"), F.lit(".5_x"))
    name = F.concat(F.when(i % 3 == 1, stem).when(i % 3 == 0, stem).otherwise(F.concat(F.lit("n"), i.cast("string"))), F.when(i % 3 == 2, ".txt").otherwise(".mp4"))
    where = scratch(spark, "media")
    _touch(p.select(name.alias("name"), F.encode(F.repeat(F.lit("x"), (i % 7).cast("int")), "UTF-8").alias("data")), where)
    return media.media_ids(media.list_files(spark, where), ".mp4", "Y").select("video_id", F.col("length"))


@query(f"WITH {FEATURES} SELECT CAST(video_id AS VARCHAR) AS video_id, modality, count(*) AS t, round(sum(CAST(feature[3] AS FLOAT)::DOUBLE), 4) AS third FROM features GROUP BY ALL")
def read_features_npy(spark, d):
    """The feature store exported as .npy files, listed and read back."""
    where = scratch(spark, "npy")
    f = features(spark, d).select(F.col("video_id").cast("string").alias("video_id"), "modality", "step", F.col("feature").cast("array<float>").alias("feature"))
    written = store.export_npy(f, where).select(F.regexp_extract("path", "[^/]*$", 0).alias("name")).agg(F.count(F.lit(1))).first()[0]
    assert written is not None
    back = store.read_features_npy(media.list_files(spark, where).select("name", "path"), tasks=8)
    return back.groupBy("video_id", "modality").agg(F.count(F.lit(1)).alias("t"), F.round(F.sum(F.col("feature")[2].cast("double")), 4).alias("third"))


@query(f"WITH {FEATURES} SELECT CAST(video_id AS VARCHAR) AS video_id, modality, count(*) AS t, round(sum((step + 1) * CAST(feature[3] AS FLOAT)::DOUBLE), 4) AS third FROM features GROUP BY ALL")
def write_features_npy(spark, d):
    """The feature store through the .npy sink, which moves files in place when all tasks are done; listed and read back."""
    where = scratch(spark, "npy")
    npy.write_npy(features(spark, d).withColumn("video_id", F.col("video_id").cast("string")), where)
    back = store.read_features_npy(media.list_files(spark, where, ext=".npy").select("name", "path"), tasks=8)
    return back.groupBy("video_id", "modality").agg(F.count(F.lit(1)).alias("t"), F.round(F.sum((F.col("step") + 1) * F.col("feature")[2].cast("double")), 4).alias("third"))


@query("SELECT 'v' || page_id AS video_id, page_id % 7 AS length, 1::BIGINT AS times FROM pages WHERE page_id % 3 <> 2")
def stream_media(spark, d):
    """A file per page, in two goes with a stream over the folder after each: every medium is worked on once, other files never."""
    p, i = table(spark, d, "pages"), F.col("page_id")
    name = F.concat(F.lit("Yv"), i.cast("string"), F.when(i % 3 == 2, ".txt").otherwise(".mp4"))
    where, out, ledger, check = (scratch(spark, n) for n in ("media", "out", "ledger", "check"))
    rows = p.select("page_id", name.alias("name"), F.encode(F.repeat(F.lit("x"), (i % 7).cast("int")), "UTF-8").alias("data"))
    for part in ("page_id % 2 = 0", "page_id % 2 = 1"):
        _touch(rows.filter(part), where)
        files = media.media_ids(media.stream_files(spark, where, prefix="Y", ext=".mp4", settle=0), ".mp4", "Y").select("video_id", "length")
        resumable(files, lambda df: df.withColumn("status", F.lit("ok")), out, ledger, check).awaitTermination()
    return spark.read.parquet(out).groupBy("video_id", "length").agg(F.count(F.lit(1)).alias("times"))


@query(f"WITH {FEATURES} SELECT modality, count(*) AS n, round(sum(feature[3]), 4) AS third FROM features GROUP BY ALL")
def write_features(spark, d):
    where = scratch(spark, "features")
    store.write_features(features(spark, d), where)
    return store.read_features(spark, where).groupBy("modality").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("feature")[2]), 4).alias("third"))


@query(f"""SELECT 'w' || doc_id AS video_id, CAST(ceil((octet_length(encode(text)) // 4) / 1000.0) AS BIGINT) AS blocks, octet_length(encode(text)) // 4 AS n, 8000 AS sample_rate, {pcm_digest()} AS weighted
FROM (SELECT doc_id, text, hex(encode(text)) AS h FROM documents) WHERE octet_length(encode(text)) >= 4""")
def read_wav(spark, d):
    """The bytes of each text as a stereo WAV file, read back in blocks."""
    raw = F.encode("text", "UTF-8")
    name = F.concat(F.pmod("doc_id", F.lit(FOLDERS)).cast("string"), F.lit("/Yw"), F.col("doc_id").cast("string"), F.lit(".wav"))
    rows = table(spark, d, "documents").select(name.alias("name"), raw.alias("raw"))

    where = scratch(spark, "wav")
    _touch(rows.select("name", wav_file()("raw").alias("data")), where)
    files = media.list_files(spark, *[f"{where}/{k}" for k in range(FOLDERS)]).select("name", "path")
    blocks = store.read_wav(files, block=1000, prefix="Y")
    return blocks.groupBy("video_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.size("samples").cast("long")).alias("n"), F.max("sample_rate").alias("sample_rate"), F.sum(weighted_samples(F.col("samples"), F.col("sample_offset"))).alias("weighted"))
