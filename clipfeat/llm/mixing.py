"""Mixing sources to target weights.

Every document gets a hash-random key; within its source the documents are put in the order of the keys by
ranges of keys (the ranges are even, since the keys are), prefix sums of the word counts run inside each range
and across the sums of the ranges, and each source is cut at its exact budget. A budget above the source's
size repeats whole epochs first. No source or range is ever gathered in one task.

Cases: a null or empty text has size 0 and takes 0 words; a null source is a source of its own, last in order;
repeated rows count each; ties of the key are broken by doc_id and size, and rows equal in both are alike; a
source of size 0 has target 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import staged, table
from .words import WORD

#: Documents in a range of keys, about.
RANGE_ROWS = 20_000
_KEYS = 1 << 60


def random_key(doc_id: Column) -> Column:
    """60 bits of the MD5 of a doc_id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key): the words of each whole text, and a key from an MD5 of doc_id."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), random_key(F.col("doc_id")).alias("key"))


def targets(sizes: DataFrame, share: float = 1.0, cap: int = 3) -> DataFrame:
    """(source, source_size, n, weight, target), one row per source: weights 1, 2, 3 in turn by code point, null last;
    all targets add to ``share`` of all words; what exceeds ``cap`` times a source's size is dealt out again by weight.

    With sources in the order of their cap per weight, a prefix is capped and the rest divides what is left by weight;
    the first source that stays under its cap ends the prefix. The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = W.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("rank", F.row_number().over(order)).withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    per = per.withColumn("cap", F.col("source_size") * cap)
    by_cap = W.orderBy(F.col("cap") * 6 / F.col("weight"), "rank")
    everything = W.partitionBy()
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, W.unboundedFollowing)
    per = per.withColumns({
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "open": F.sum("weight").over(after),
        "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
    })
    per = per.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
    per = per.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("capped", "level"))).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", "source_size", "n", "weight", target.alias("target"))


def mix(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``sizes`` with source_size, target, before (words of the source ahead in random order) and taken."""
    goals = staged(goals, "mix-goals")
    rows = sizes.join(goals, sizes["source"].eqNullSafe(goals["source"]), "left").drop(goals["source"])
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / RANGE_ROWS))
    rows = rows.withColumn("range", F.floor(F.col("key") / F.lit(float(_KEYS)) * ranges).cast("int"))
    rows = staged(rows, "mix-rows")
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    rows = rows.join(sums, rows["source"].eqNullSafe(sums["s"]) & (rows["range"] == sums["r"])).drop("s", "r")
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    whole = F.when(F.col("source_size") > 0, budget - budget % F.greatest(F.col("source_size"), F.lit(1))).otherwise(F.lit(0))
    epochs = (whole / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.withColumns({"epochs": epochs, "rest": rest, "taken": epochs * F.col("size") + part})


#: Sources whose plan is sent to every task; with more of them the plan is joined by a shuffle of the documents.
MOST_SOURCES = 100_000


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: one copy for each epoch that takes a document.

    Texts stay whole: the document at a source's cut is in if at least half of it lies inside the budget; empty
    documents are in while the budget lasts. What a source takes beyond whole epochs is the beginning of its random order, so
    one small row per source (epochs, and the last key and doc_id that are in) tells each document its copies, and texts
    don't move. Rows that share a doc_id are in or out together."""
    sizes = staged(sized(docs), "mix-sizes")
    plan = mix(sizes, targets(sizes))
    more = F.when(F.col("size") > 0, (F.col("taken") - F.col("epochs") * F.col("size")) * 2 >= F.col("size")).otherwise(F.col("before") < F.col("rest"))
    cuts = plan.groupBy("source").agg(F.first("epochs").alias("_epochs"), F.max(F.when(more, F.struct("key", "doc_id"))).alias("_cut"))
    cuts = staged(cuts.withColumnRenamed("source", "_source"), "mix-cuts")
    if cuts.count() <= MOST_SOURCES:
        cuts = F.broadcast(cuts)
    name = F.col("row.doc_id")
    rows = docs.select(F.struct("*").alias("row")).join(cuts, F.col("row.source").eqNullSafe(F.col("_source")))
    inside = F.coalesce(F.struct(random_key(name).alias("key"), name.alias("doc_id")) <= F.col("_cut"), F.lit(False))
    copies = (F.col("_epochs") + inside.cast("long")).cast("int")
    return rows.withColumn("_copies", copies).filter("_copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of all documents in one pass, then only small rows move."""
    sizes = staged(sized(table(spark, sf_dir, "documents")), "mix-sizes")
    return mix(sizes, targets(sizes)).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM per),
weighted AS (SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM ranked),
cut AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap * 6 / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
               sum(weight) OVER (ORDER BY cap * 6 / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
               sum(source_size) OVER () AS budget FROM weighted),
levels AS (SELECT *, (CAST(budget AS DOUBLE) - CAST(capped AS DOUBLE)) / CAST(open AS DOUBLE) AS level FROM cut),
lowest AS (SELECT arg_min(level, capped) AS level FROM levels WHERE level * weight <= cap),
goals AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM lowest) * weight, CAST(cap AS DOUBLE))) AS target FROM levels),
laid AS (SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS budget,
                coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
         FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST((budget // greatest(source_size, 1)) * size + greatest(0, least(size, budget % greatest(source_size, 1) - before)) AS BIGINT) AS taken
FROM laid
"""
