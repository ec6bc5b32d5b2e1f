"""Queries on ids, ledgers and work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import worklist
from ..sources import store, text
from . import query
from .sources import _touch
from .standins import media, scratch, table


def _ids(spark, d):
    return table(spark, d, "documents").select(F.concat(F.lit("v_"), F.col("doc_id").cast("string")).alias("video_id"))


def _have(spark, d):
    return _ids(spark, d).filter("cast(substring(video_id, 3) as long) % 4 <> 1")


def _lines(spark, d):
    """A ledger line for every id, written in various ways."""
    i = F.col("doc_id").cast("string")
    name = F.concat(F.lit("v_"), i)
    forms = [name, F.concat(name, F.lit(".mp4")), F.concat(F.lit("dir\\sub\\"), name, F.lit(".wav")), F.concat(F.lit("\"/x/"), name, F.lit(f'{names.SUFFIXES["audio"]}"')), F.concat(name, F.lit("\tbroken pipe")), F.concat(F.lit("  "), name, F.lit(" "))]
    line = F.lit(None).cast("string")
    for k, f in enumerate(forms):
        line = F.when(F.col("doc_id") % 6 == k, f).otherwise(line)
    return table(spark, d, "documents").select("doc_id", line.alias("value"))


ID = "'v_' || doc_id"


@query(f"SELECT {ID} AS video_id FROM documents")
def done_line_to_id(spark, d):
    return _lines(spark, d).select(names.done_line_to_id("value", names.SUFFIXES["audio"]).alias("video_id"))


@query("SELECT regexp_replace(regexp_replace(regexp_extract(url, '[^/]*$'), '\\t.*', ''), '(\\.mp4|\\.wav)$', '') AS video_id, count(*) AS n FROM pages WHERE trim(url) <> '' GROUP BY 1")
def done_urls(spark, d):
    return table(spark, d, "pages").select(names.done_line_to_id("url", ".npy").alias("video_id")).filter("video_id is not null").groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT DISTINCT {ID} AS video_id FROM documents WHERE doc_id % 7 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0")
def done_ids(spark, d):
    stored = _ids(spark, d).filter("cast(substring(video_id, 3) as long) % 7 = 0")
    return worklist.done_ids(stored, _lines(spark, d).filter("doc_id % 3 = 0 or doc_id % 5 = 0").select("value"), "audio")


@query(f"SELECT DISTINCT {ID} AS video_id FROM documents WHERE doc_id % 7 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0 OR doc_id % 11 = 1 OR (doc_id % 13 = 2 AND doc_id < 500)")
def done_set(spark, d):
    """Feature files of a folder and the lines of its ledgers of one prefix, each with the lines of 500 documents, of a further folder and of a text file; other ledgers, other
    modalities, temporary files and what isn't there don't count."""
    here, there = scratch(spark, "done-here"), scratch(spark, "done-there")
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("v_"), F.col("doc_id").cast("string")).alias("id"))
    file = lambda rule, tail: docs.filter(rule).select(F.concat("id", F.lit(tail)).alias("name"), F.lit(b"x").alias("data"))
    audio, visual = names.SUFFIXES["audio"], names.SUFFIXES["visual"]
    _touch(file("doc_id % 7 = 0", audio).unionByName(file("doc_id % 2 = 0", visual)).unionByName(file("doc_id % 2 = 1", audio.removesuffix(".npy") + ".tmp.npy")), here)
    _touch(file("doc_id % 11 = 1", audio), there)
    lines = lambda rule: F.array_join(F.collect_list(F.when(F.expr(rule), F.col("value"))), "\n")
    ledgers = _lines(spark, d).groupBy(F.floor(F.col("doc_id") / 500).alias("k")).agg(lines("doc_id % 3 = 0 or doc_id % 5 = 0").alias("done"), lines("true").alias("other"), lines("doc_id % 13 = 2").alias("more"))
    named = lambda head, column: ledgers.select(F.concat(F.lit(head), F.col("k").cast("string"), F.lit(".txt")).alias("name"), F.encode(column, "UTF-8").alias("data"))
    _touch(named("done_audio_", "done").unionByName(named("failed_audio_", "other")), here)
    _touch(named("more_", "more"), where := scratch(spark, "done-more"))
    return store.done_set(spark, [here], "audio", "done_audio", [there, f"{where}/more_0.txt", f"{where}/nowhere.txt"])


@query(f"SELECT {ID} AS video_id FROM documents WHERE doc_id % 4 <> 1")
def existing_ids(spark, d):
    return worklist.existing_ids(_ids(spark, d), _have(spark, d))


@query(f"SELECT {ID} AS video_id FROM documents WHERE doc_id % 4 = 1")
def missing_ids(spark, d):
    return worklist.missing_ids(_ids(spark, d), _have(spark, d))


@query(f"SELECT {ID} AS video_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0")
def pending_ids(spark, d):
    return worklist.pending_ids(_ids(spark, d), done_ids(spark, d))


@query(f"SELECT {ID} AS video_id, row_number() OVER (ORDER BY {ID}) - 1 AS position, CAST((row_number() OVER (ORDER BY {ID}) - 1) % 3 AS INTEGER) AS shard FROM (SELECT DISTINCT doc_id FROM documents)")
def shard_ids(spark, d):
    return worklist.shard_ids(_ids(spark, d), 3)


@query(f"SELECT {ID} AS video_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 ORDER BY 1 LIMIT 20")
def limit_pending(spark, d):
    return worklist.first_pending(pending_ids(spark, d), 20)


@query("""WITH r AS (SELECT CAST(doc_id % 4 AS INTEGER) AS shard, n_chars % 11 <> 0 AS ok, n_chars // 8 + 1 AS w, n_chars / 16e0 AS s, n_chars % 3 AS wait FROM documents)
SELECT shard, CAST(count(*) FILTER (ok) AS BIGINT) AS n_ok, CAST(count(*) FILTER (NOT ok) AS BIGINT) AS n_failed, CAST(coalesce(sum(w) FILTER (ok), 0) AS BIGINT) AS windows_ok, CAST(coalesce(sum(w) FILTER (NOT ok), 0) AS BIGINT) AS windows_failed,
  round(sum(w) FILTER (ok) / sum(s), 6) AS windows_per_sec, round(sum(wait) / sum(s), 6) AS wait_share FROM r GROUP BY shard""")
def run_summary(spark, d):
    c = F.col("total")
    runs = media(spark, d).select((F.col("video_id") % 4).cast("int").alias("shard"), F.when(c % 11 != 0, "ok").otherwise("failed").alias("status"), (F.expr("total div 8") + 1).alias("windows"), (c / 16.0).alias("seconds"), (c % 3).cast("double").alias("wait_seconds"))
    s = worklist.run_summary(runs)
    return s.withColumn("windows_per_sec", F.round("windows_per_sec", 6)).withColumn("wait_share", F.round("wait_share", 6))


@query(f"SELECT {ID} AS video_id, m AS modality, {ID} || CASE m WHEN 'visual' THEN '{names.SUFFIXES['visual']}' ELSE '{names.SUFFIXES['audio']}' END AS name, {ID} AS back, m AS back_modality FROM documents, (SELECT unnest(['visual', 'audio']) AS m)")
def feature_name(spark, d):
    rows = _ids(spark, d).withColumn("modality", F.explode(F.array(F.lit("visual"), F.lit("audio")))).withColumn("name", names.feature_name("video_id", "modality"))
    return rows.withColumn("p", names.parse_feature_name("name")).select("video_id", "modality", "name", F.col("p.video_id").alias("back"), F.col("p.modality").alias("back_modality"))


@query("""SELECT doc_id AS video_id, CASE WHEN doc_id % 5 > 0 THEN (n_chars % 3) * 3600 + (n_chars % 60) * 60 + (n_chars % 61) + 0.5e0 END AS duration,
  CASE WHEN doc_id % 3 > 0 THEN 640 END AS width, CASE WHEN doc_id % 3 > 0 THEN CAST(100 + n_chars % 900 AS INTEGER) END AS height, CASE WHEN doc_id % 4 > 0 THEN 44100 END AS sample_rate FROM documents""")
def parse_probe(spark, d):
    """Probe logs made from each document's numbers, with parts left out."""
    n = F.col("n_chars")
    parts = F.concat(
        F.lit("Input #0, mov\n"), F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("  Duration: "), F.format_string("%02d:%02d:%02d.50", n % 3, n % 60, n % 61), F.lit(", start: 0.0\n"))).otherwise(""),
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("  Stream #0:0: Video: h264, yuv420p, 640x"), (100 + n % 900).cast("string"), F.lit(" [SAR 1:1], 25 fps\n"))).otherwise(""),
        F.when(F.col("doc_id") % 4 > 0, F.lit("  Stream #0:1: Audio: aac, 44100 Hz, stereo\n")).otherwise(""),
    )
    return table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), names.parse_probe(parts).alias("p")).select("video_id", "p.*")


@query("SELECT CASE WHEN doc_id % 2 = 0 THEN 'w_' || doc_id % 50 ELSE 's_' || doc_id END AS video_id FROM documents GROUP BY 1")
def ids_from_json(spark, d):
    """A database document for every 20 documents; even ones name their video, odd ones are named by their key."""
    i = F.col("doc_id")
    entry = F.when(i % 2 == 0, F.to_json(F.struct(F.concat(F.lit("w_"), (i % 50).cast("string")).alias("video_id"), F.col("n_chars").alias("duration")))).otherwise(F.to_json(F.struct(F.col("n_chars").alias("duration"))))
    pairs = table(spark, d, "documents").select(F.expr("doc_id div 20").alias("g"), F.concat(F.lit('"s_'), i.cast("string"), F.lit('":'), entry).alias("p"))
    docs = pairs.groupBy("g").agg(F.concat(F.lit('{"database":{'), F.array_join(F.collect_list("p"), ","), F.lit("}}")).alias("value"))
    return text.ids_from_json(docs.select("value"))


@query("SELECT DISTINCT lang AS video_id FROM documents UNION SELECT DISTINCT source FROM documents")
def ids_from_text(spark, d):
    docs = table(spark, d, "documents")
    lines = docs.select(F.explode(F.array(F.concat(F.lit("  "), F.col("lang"), F.lit("\t")), F.col("source"), F.lit("  "), F.lit(""))).alias("value"))
    return text.ids_from_text(lines)


@query("SELECT CAST(n_chars % 100 AS VARCHAR) AS id, arg_max('name, ' || doc_id, doc_id) AS name FROM documents WHERE doc_id % 10 > 0 GROUP BY 1")
def read_category_names(spark, d):
    i = F.col("doc_id")
    line = F.when(i % 10 == 0, F.concat(F.lit("x"), i.cast("string"), F.lit(",bad"))).otherwise(F.concat((F.col("n_chars") % 100).cast("string"), F.lit(" , name, "), i.cast("string"), F.lit(" ")))
    return text.read_category_names(table(spark, d, "documents").select(i.alias("line_no"), line.alias("value")))


@query("SELECT doc_id, CAST(k AS INTEGER) AS class_id, 'class ' || doc_id || '.' || k AS name FROM documents, (SELECT unnest(range(5)) AS k)")
def read_label_map(spark, d):
    names_ = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.concat(F.lit("class "), F.col("doc_id").cast("string"), F.lit("."), k.cast("string"))), "\n")
    rows = table(spark, d, "documents").select("doc_id", F.concat(names_, F.lit("\n")).alias("value"))
    return _maps(rows)


def _maps(rows):
    """A label map per row: the class belongs to the row whose text holds it."""
    return text.read_label_map(rows).withColumn("doc_id", F.regexp_extract("name", r"class (\d+)\.", 1).cast("long")).select("doc_id", "class_id", "name")


@query("""SELECT CASE WHEN n_chars % 6 = 0 THEN 'failed' WHEN n_chars % 6 = 1 THEN 'silent' ELSE 'done' END AS status,
  'v_' || doc_id || CASE WHEN n_chars % 6 = 0 THEN chr(9) || 'error ' || n_chars ELSE '' END AS value FROM documents""")
def append_ledger(spark, d):
    """Ledger rows of two shards, appended one after the other and read back."""
    from .standins import scratch

    n = F.col("n_chars")
    rows = table(spark, d, "documents").select(
        F.concat(F.lit("v_"), F.col("doc_id").cast("string")).alias("video_id"), F.lit("audio").alias("modality"), (F.col("doc_id") % 2).cast("int").alias("shard_id"),
        F.when(n % 6 == 0, "failed").when(n % 6 == 1, "silent").otherwise("done").alias("status"), F.when(n % 6 == 0, F.concat(F.lit("error "), n.cast("string"))).alias("error"),
    )
    path = scratch(spark, "ledger")
    for k in (0, 1):
        store.append_ledger(rows.filter(F.col("shard_id") == k), path)
    return store.ledger_lines(store.read_ledger(spark, path))
