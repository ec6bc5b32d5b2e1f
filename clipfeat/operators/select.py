"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts into which a range of values is counted, and rows that a task may sort in the end.
BINS, SORTED = 4096, 50_000


def exact_medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, median): the middle value of each group, or the mean of the middle two; nulls and NaN are left out.

    A pass counts the values in equal parts of each group's range and goes on with the part that the middle lies in, and with the least
    and largest value there; values of one group are never gathered. Evenly spread values need two passes up to some hundred million
    a group. It ends when a part has few rows, which are sorted, or one value."""
    v = F.col("_v")
    rows = rows.select(key, F.col(value).cast("double").alias("_v")).filter(v.isNotNull() & ~F.isnan(v)).withColumnRenamed(key, "_key").persist()
    spans = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    # the places of the lower and the upper middle
    want = spans.select("_key", F.posexplode(F.array(F.expr("(n + 1) div 2"), F.expr("n div 2 + 1"))).alias("t", "k"), "lo", "hi", "n").persist()
    near = lambda: rows.join(want.withColumnRenamed("_key", "_w"), F.col("_key").eqNullSafe(F.col("_w"))).filter(v.between(F.col("lo"), F.col("hi")))
    while want.filter((F.col("lo") < F.col("hi")) & (F.col("n") > SORTED)).take(1):
        # halves, so that the width of a range of any two numbers is a number
        place = (v / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS
        part = F.when(F.col("lo") < F.col("hi"), F.least(F.lit(BINS - 1), F.floor(place))).otherwise(F.lit(0))
        counts = near().groupBy("_key", "t", "k", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        until = F.sum("n").over(W.partitionBy("_key", "t").orderBy("part"))
        want = counts.withColumn("until", until).filter((F.col("until") >= F.col("k")) & (F.col("until") - F.col("n") < F.col("k")))
        want = want.select("_key", "t", (F.col("k") - F.col("until") + F.col("n")).alias("k"), "lo", "hi", "n").persist()
    one = want.filter("lo = hi").select("_key", F.col("lo").alias("m"))
    few = near().filter("lo < hi").withColumn("at", F.row_number().over(W.partitionBy("_key", "t").orderBy("_v"))).filter("at = k").select("_key", v.alias("m"))
    middle = one.unionByName(few).groupBy("_key").agg((F.min("m") * 0.5 + F.max("m") * 0.5).alias("median"))
    return middle.withColumnRenamed("_key", key)
