"""Queries on segments and annotations."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..jobs.annotate import annotate
from ..operators import annotate as op
from ..sources import documents, text
from . import query
from .standins import SEGMENTS, categories, r6, scratch, segment_features, segment_media, segments

CATS = "cats AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'dish ' || p_size AS name FROM part WHERE p_size <= 40)"
LABELLED = f"{SEGMENTS}, {CATS}, labelled AS (SELECT judged.*, coalesce(name, 'recipe ' || coalesce(recipe_type, 'None')) AS label FROM judged LEFT JOIN cats ON id = recipe_type WHERE outcome = 'kept')"


def _judged(spark, d):
    s = op.ordered_segments(segments(spark, d))
    return op.with_outcome(s, segment_media(s), op.with_both_features(segment_features(s)))


def _kept(spark, d):
    return _judged(spark, d).filter("outcome = 'kept'")


def _labelled(spark, d):
    return op.label_ids(op.label_segments(_kept(spark, d), categories(spark, d)))


@query(f"WITH {SEGMENTS} SELECT video_id || '_' || k AS seg_id, round(seg_start, 6) AS s, round(e, 6) AS e FROM judged WHERE e > seg_start")
def clamp_segments(spark, d):
    return op.clamp_segments(segments(spark, d)).select("seg_id", r6("start").alias("s"), r6("end").alias("e"))


@query(f"WITH {SEGMENTS} SELECT video_id || '_' || k AS seg_id, CAST(k AS BIGINT) AS k, CAST(row_number() OVER (PARTITION BY video_id ORDER BY subset <> 'training', k) AS INTEGER) AS ord FROM segs")
def segment_order(spark, d):
    return op.ordered_segments(segments(spark, d)).select("seg_id", "k", "ord")


@query(f"""WITH {SEGMENTS}, feats AS (SELECT DISTINCT video_id, 'audio' AS modality FROM segs UNION ALL SELECT DISTINCT video_id, 'visual' FROM segs WHERE has_feature),
both_there AS (SELECT video_id FROM feats WHERE modality IN ('visual', 'audio') GROUP BY video_id HAVING count(DISTINCT modality) = 2)
SELECT video_id || '_' || k AS seg_id, video_id, subset, round(duration, 6) AS duration, round(seg_start, 6) AS s, round(seg_end, 6) AS e, recipe_type, sentence FROM segs SEMI JOIN both_there USING (video_id)""")
def segments_with_features(spark, d):
    s = segments(spark, d)
    start, end = (r6(F.col("segment")[k]) for k in (0, 1))
    return op.segments_with_features(s, segment_features(s)).select("seg_id", "video_id", "subset", r6("duration").alias("duration"), start.alias("s"), end.alias("e"), "recipe_type", "sentence")


@query(f"WITH {SEGMENTS} SELECT subset, outcome, count(*) AS n FROM judged GROUP BY ALL")
def drop_reasons(spark, d):
    return op.drop_reasons(_judged(spark, d))


@query(f"WITH {LABELLED} SELECT video_id || '_' || k AS seg_id, label, 'cooking step' AS step_label FROM labelled")
def label_segments(spark, d):
    rows = op.label_segments(_kept(spark, d), categories(spark, d))
    return op.label_segments(rows.withColumnRenamed("label", "name"), None, "step").select("seg_id", F.col("name").alias("label"), F.col("label").alias("step_label"))


@query(f"WITH {LABELLED} SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, count(*) AS n FROM labelled GROUP BY label")
def label_ids(spark, d):
    return _labelled(spark, d).groupBy("label", "label_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LABELLED} SELECT count(DISTINCT label) AS num_classes FROM labelled")
def num_classes(spark, d):
    return op.num_classes(_labelled(spark, d))


@query(f"WITH {SEGMENTS} SELECT video_id, count(DISTINCT other_subset) AS n_subsets FROM judged WHERE outcome = 'kept' GROUP BY video_id HAVING count(DISTINCT other_subset) > 1")
def subset_leakage(spark, d):
    return op.leaking_videos(_kept(spark, d).withColumn("subset", F.col("other_subset").cast("string")))


@query(f"""WITH {LABELLED}, ids AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS label_id FROM labelled GROUP BY label)
SELECT video_id, arg_min(subset, k) AS subset, round(arg_min(duration, k), 6) AS duration, count(*) AS n,
  string_agg(label || '/' || label_id || '/' || sentence, ';' ORDER BY k) AS nested FROM labelled JOIN ids USING (label) GROUP BY video_id""")
def build_annotations(spark, d):
    rows = annotate(segments(spark, d), segment_media(segments(spark, d)), segment_features(segments(spark, d)), categories(spark, d))["annotations"]
    nested = F.array_join(F.transform("annotations", lambda a: F.concat_ws("/", a["label"], a["label_id"].cast("string"), a["sentence"])), ";")
    return rows.select("video_id", "subset", r6("duration").alias("duration"), F.size("annotations").cast("long").alias("n"), nested.alias("nested"))


@query(f"""WITH {LABELLED}, v AS (SELECT video_id, arg_min(subset, k) AS subset, arg_min(duration, k) AS duration, count(*) AS n, sum(e - seg_start) AS s, min(e - seg_start) AS lo, max(e - seg_start) AS hi FROM labelled GROUP BY video_id)
SELECT subset, count(*) AS videos, CAST(sum(n) AS BIGINT) AS segments, round(avg(n), 6) AS segments_per_video, round(avg(duration), 6) AS video_sec, round(sum(s) / sum(n), 6) AS segment_sec, round(min(lo), 6) AS min_sec, round(max(hi), 6) AS max_sec FROM v GROUP BY subset""")
def subset_summary(spark, d):
    s = op.subset_summary(_labelled(spark, d))
    return s.select("subset", "videos", "segments", *[r6(c).alias(c) for c in ("segments_per_video", "video_sec", "segment_sec", "min_sec", "max_sec")])


def _written(spark, d):
    """The annotations as JSON lines, written and read again."""
    path = scratch(spark, "annotations")
    text.annotation_lines(annotate(segments(spark, d), segment_media(segments(spark, d)), segment_features(segments(spark, d)), categories(spark, d))["annotations"]).write.text(path)
    return spark.read.text(path)


@query(f"WITH {LABELLED} SELECT video_id, count(*) AS n, round(sum(e), 6) AS ends FROM labelled GROUP BY video_id")
def write_annotations(spark, d):
    rows = _written(spark, d).select(F.from_json("value", f"struct<video_id:long,{text.ANNOTATION[7:-1]}>").alias("v")).select("v.*")
    return rows.select("video_id", F.size("annotations").cast("long").alias("n"), F.round(F.aggregate("annotations", F.lit(0.0), lambda s, a: s + a["segment"][1]), 6).alias("ends"))


@query(f"WITH {LABELLED} SELECT CAST(video_id AS VARCHAR) AS video_id, k_pos AS pos, label FROM (SELECT *, CAST(row_number() OVER (PARTITION BY video_id ORDER BY k) - 1 AS INTEGER) AS k_pos FROM labelled)")
def read_annotations(spark, d):
    """A database document per video, read back as segment rows."""
    v = F.from_json("value", f"struct<video_id:string,{text.ANNOTATION[7:-1]}>")
    docs = _written(spark, d).select(v.alias("v")).select(F.to_json(F.struct(F.lit("1").alias("version"), F.map_from_arrays(F.array("v.video_id"), F.array(F.struct("v.subset", "v.duration", "v.annotations"))).alias("database"))).alias("value"))
    return text.annotation_segments(text.read_annotations(docs)).select("video_id", "pos", "label")


@query(f"WITH {SEGMENTS} SELECT video_id || '_' || k AS seg_id, CAST(video_id AS VARCHAR) AS video_id, subset, round(duration, 6) AS duration, round(seg_end, 6) AS seg_end, recipe_type FROM segs")
def read_segments(spark, d):
    """Segments as database documents of one subset each, read back."""
    s = segments(spark, d)
    entry = F.to_json(F.struct(F.col("video_id").cast("string").alias("video_id"), "duration", "segment", "recipe_type", "sentence"))
    pairs = s.select("subset", "video_id", F.concat(F.lit('"'), F.col("seg_id"), F.lit('":'), entry).alias("p"))
    docs = pairs.groupBy("subset", "video_id").agg(F.concat(F.lit('{"database":{'), F.array_join(F.collect_list("p"), ","), F.lit("}}")).alias("value"))
    part = lambda x: docs.filter(F.col("subset") == x).select("value")
    rows = text.read_segments(part("training"), part("validation"))
    return rows.select("seg_id", "video_id", "subset", r6("duration").alias("duration"), r6(F.col("segment")[1]).alias("seg_end"), "recipe_type")


def _segment_documents(spark, d):
    """(folder, a function that writes the document of a subset there at its places by many tasks, and gives its entries as read by ranges)."""
    where = scratch(spark, "documents")
    segments(spark, d).write.option("compression", "zstd").partitionBy("subset").parquet(f"{where}/segments")
    s = spark.read.parquet(f"{where}/segments")
    entry = F.struct(F.col("video_id").cast("string").alias("video_id"), "duration", "segment", "recipe_type", "sentence")

    def entries(x):
        documents.write_document(s.filter(F.col("subset") == x), "seg_id", entry, f"{where}/{x}.json")
        return documents.document_entries(spark, f"{where}/{x}.json", range_bytes=1 << 20)

    return where, entries


@query(f"WITH {SEGMENTS} SELECT video_id || '_' || k AS seg_id, CAST(video_id AS VARCHAR) AS video_id, subset, round(duration, 6) AS duration, round(seg_end, 6) AS seg_end, recipe_type FROM segs")
def read_segments_document(spark, d):
    rows = documents.segments_of(*map(_segment_documents(spark, d)[1], op.SUBSETS))
    return rows.select("seg_id", "video_id", "subset", r6("duration").alias("duration"), r6(F.col("segment")[1]).alias("seg_end"), "recipe_type")


@query(f"WITH {SEGMENTS} SELECT DISTINCT CAST(video_id AS VARCHAR) AS video_id FROM segs")
def ids_from_document(spark, d):
    """A document at a time, which goes when its ids are written: documents are many times the bytes of all that they are made of."""
    where, entries = _segment_documents(spark, d)
    for x in op.SUBSETS:
        documents.ids_of(entries(x)).write.parquet(f"{where}/ids/{x}")
        os.remove(f"{where}/{x}.json".removeprefix("file://"))
    return spark.read.parquet(*[f"{where}/ids/{x}" for x in op.SUBSETS]).distinct()


@query(f"WITH {LABELLED} SELECT CAST(video_id AS VARCHAR) AS video_id, count(*) AS n, round(sum(e), 6) AS ends, string_agg(label, ';' ORDER BY k) AS labels FROM labelled GROUP BY video_id")
def write_annotation_document(spark, d):
    """All annotations as one document by many tasks, read back as a database."""
    rows = annotate(segments(spark, d), segment_media(segments(spark, d)), segment_features(segments(spark, d)), categories(spark, d))["annotations"]
    path = f"{scratch(spark, 'documents')}/annotations.json"
    documents.write_document(rows, "video_id", F.struct("subset", "duration", "annotations"), path, {"version": "1", "label_mode": "recipe"})
    back = documents.annotations_of(documents.document_entries(spark, path, range_bytes=1 << 20))
    ends = F.round(F.aggregate("annotations", F.lit(0.0), lambda s, a: s + a["segment"][1]), 6)
    return back.select("video_id", F.size("annotations").cast("long").alias("n"), ends.alias("ends"), F.array_join(F.transform("annotations", lambda a: a["label"]), ";").alias("labels"))
