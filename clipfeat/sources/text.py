"""Ids, categories and class names from text and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = "struct<video_id:string,duration:double,segment:array<double>,recipe_type:string,sentence:string>"
ANNOTATION = "struct<subset:string,duration:double,annotations:array<struct<segment:array<double>,label:string,sentence:string,label_id:int>>>"


def json_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(value): the whole text of each file."""
    return spark.read.text(list(paths), wholetext=True)


def _entries(docs: DataFrame, kind: str) -> DataFrame:
    parsed = F.from_json("value", f"database map<string,{kind}>")
    return docs.select(F.explode(parsed["database"]).alias("key", "entry"))


def ids_from_json(docs: DataFrame) -> DataFrame:
    """Distinct ids of {"database": {key: entry}}: the entry's video_id, or else its key."""
    return _entries(docs, "string").select(F.coalesce(F.get_json_object("entry", "$.video_id"), "key").alias("video_id")).distinct()


def ids_from_text(lines: DataFrame) -> DataFrame:
    """Distinct trimmed lines that are not blank."""
    return lines.select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("video_id")).filter("video_id <> ''").distinct()


def read_segments(training: DataFrame, validation: DataFrame) -> DataFrame:
    """(seg_id, video_id, subset, duration, segment, recipe_type, sentence) of two segment files (value)."""
    part = lambda docs, subset: _entries(docs, SEGMENT).select(F.col("key").alias("seg_id"), F.lit(subset).alias("subset"), "entry.*")
    return part(training, "training").unionByName(part(validation, "validation"))


def read_category_names(lines: DataFrame) -> DataFrame:
    """(id, name) of lines (line_no, value) ``id,name``: cut at the first comma, trimmed; ids of digits only; the last line wins."""
    parts = F.split("value", ",", 2)
    rows = lines.filter(F.col("value").contains(",")).select("line_no", F.trim(parts[0]).alias("id"), F.trim(parts[1]).alias("name"))
    return rows.filter(F.col("id").rlike("^[0-9]+$")).groupBy("id").agg(F.max_by("name", "line_no").alias("name"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a small file, in its order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))


def read_label_map(docs: DataFrame) -> DataFrame:
    """(class_id, name): a class per line of the whole text (value), numbered from 0; a last line break adds none."""
    return docs.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), "\r?\n")).alias("class_id", "name"))


def read_annotations(docs: DataFrame) -> DataFrame:
    """(video_id, subset, duration, annotations) of annotation databases (value)."""
    return _entries(docs, ANNOTATION).select(F.col("key").alias("video_id"), "entry.*")


def annotation_segments(annotations: DataFrame) -> DataFrame:
    """(video_id, pos, segment, label, sentence, label_id), one row per annotated segment."""
    return annotations.select("video_id", F.posexplode("annotations").alias("pos", "a")).select("video_id", "pos", "a.*")


def annotation_lines(annotations: DataFrame) -> DataFrame:
    """(value): a JSON document per video, for parallel writing."""
    return annotations.select(F.to_json(F.struct("video_id", "subset", "duration", "annotations")).alias("value"))


def annotation_document(annotations: DataFrame, version: str, label_mode: str) -> DataFrame:
    """(value): the whole database as one JSON document, in order of the ids. One row holds it all, so it suits sets that a reader
    can load whole; ``annotation_lines`` has no such bound."""
    entry = F.struct(F.col("video_id").alias("key"), F.struct("subset", "duration", "annotations").alias("value"))
    every = annotations.agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return every.select(F.to_json(F.struct(F.lit(version).alias("version"), F.lit(label_mode).alias("label_mode"), F.map_from_entries("e").alias("database"))).alias("value"))
