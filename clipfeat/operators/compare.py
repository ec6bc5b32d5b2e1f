"""Comparing feature stores, and means of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.vectors import arrow_cosine, cosine, l2_normalize, pair_sums, sum_squares
from .select import exact_medians


def align_modalities(features: DataFrame, left: str = "visual", right: str = "audio") -> DataFrame:
    """(video_id, step, left, right): the steps that both modalities have, so the longer one is cut."""
    side = lambda m, name: features.filter(F.col("modality") == m).select("video_id", "step", F.col("feature").alias(name))
    return side(left, "left").join(side(right, "right"), ["video_id", "step"])


def pair_features(a: DataFrame, b: DataFrame) -> DataFrame:
    """(video_id, modality, step, a, b) of two stores, row by row."""
    keys = ["video_id", "modality", "step"]
    return a.select(*keys, F.col("feature").alias("a")).join(b.select(*keys, F.col("feature").alias("b")), keys)


def unpaired(a: DataFrame, b: DataFrame) -> DataFrame:
    """(video_id, modality, only_a, only_b): steps that one store alone has, where there are any."""
    keys = ["video_id", "modality", "step"]
    both = a.select(*keys).withColumn("_a", F.lit(1)).unionByName(b.select(*keys).withColumn("_b", F.lit(1)), allowMissingColumns=True)
    per = both.groupBy(*keys).agg(F.max("_a").alias("a"), F.max("_b").alias("b"))
    out = per.groupBy("video_id", "modality").agg(F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))
    return out.filter("only_a > 0 or only_b > 0")


def merge_stores(*stores: tuple[str, DataFrame]) -> DataFrame:
    """One store of (modality, store) parts kept apart."""
    parts = [df.select("video_id", F.lit(m).alias("modality"), "step", "feature") for m, df in stores]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repeated_rows(features: DataFrame) -> DataFrame:
    """(video_id, modality, step, n) of keys that come more than once."""
    return features.groupBy("video_id", "modality", "step").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def feature_diff(pairs: DataFrame, wide: bool = False) -> DataFrame:
    """(n, min_cosine, relative_error) of pairs (a, b): relative error is the norm of all differences over that of all b. ``wide`` takes
    whole batches of vectors with NumPy."""
    if wide:
        sums = pairs.select(pair_sums("a", "b").alias("s")).select("s.*")
        cos = F.try_divide("ab", F.sqrt("aa") * F.sqrt("bb"))
        return sums.agg(F.count(F.lit(1)).alias("n"), F.min(cos).alias("min_cosine"), F.sqrt(F.try_divide(F.sum("gap"), F.sum("bb"))).alias("relative_error"))
    gap = F.zip_with("a", "b", lambda x, y: x.cast("double") - y.cast("double"))
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.min(cosine("a", "b")).alias("min_cosine"), F.sqrt(F.try_divide(F.sum(sum_squares(gap)), F.sum(sum_squares("b")))).alias("relative_error"))


def cosine_summary(pairs: DataFrame, above: float = 0.9, wide: bool = False) -> DataFrame:
    """By variant, from (variant, video_id, a, b): mean, median, least mean cosine of a video, and how many lie above ``above``. The
    median is selected by counts, so a variant of any number of videos is never one task. ``wide`` as for ``feature_diff``."""
    pairs = pairs.withColumn("c", (arrow_cosine if wide else cosine)("a", "b"))
    per = pairs.groupBy("variant", "video_id").agg(F.avg("c").alias("c")).persist()
    sums = per.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.avg("c").alias("mean"), F.min("c").alias("min"), F.count_if(F.col("c") > above).alias("above"))
    medians = exact_medians(per, "variant", "c").withColumnRenamed("variant", "_variant")
    return sums.join(medians, F.col("variant").eqNullSafe(F.col("_variant")), "left").select("variant", "n", "mean", "median", "min", "above")


def vector_means(rows: DataFrame, keys: list[str], vector: str = "feature") -> DataFrame:
    """(keys, n, mean): the mean vector of each group, for few dimensions: one number at a time, summed before the shuffle."""
    each = rows.select(*keys, F.posexplode(vector).alias("_i", "_x"))
    per = each.groupBy(*keys, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"), F.count(F.lit(1)).alias("n"))
    out = per.groupBy(*keys).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias("_v"))
    return out.select(*keys, "n", F.transform("_v", lambda p: p["_m"]).alias("mean"))


#: Sums of a group that meet in the last step of a tree, at most; groups of which a task holds the sums at a time.
FANOUT, GROUPS_HELD = 32, 2_000


def wide_vector_means(rows: DataFrame, keys: list[str], vector: str = "feature") -> DataFrame:
    """``vector_means`` for wide vectors: each task adds up its own groups with NumPy, and the sums of tasks are added in a tree, so what
    is shuffled is a vector for each group and task at first and fewer at each level, and no place of a vector is a row."""
    schema = "".join(f"`{k}` {rows.schema[k].dataType.simpleString()}, " for k in keys) + "n long, total array<double>"
    column = rows.select(*keys, F.lit(1).cast("long").alias("n"), F.col(vector).cast("array<double>").alias("total")).filter("total is not null")

    def added(batches):
        """One row for each group of a task; a task that sees very many groups sends what it has and goes on."""
        held: dict = {}

        def frame():
            columns = zip(*((*k, n, x) for k, (n, x) in held.items()), strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)
            held.clear()
            return out

        for batch in batches:
            totals = batch.column("total")
            flat, ends = totals.values.to_numpy(zero_copy_only=False), totals.offsets.to_numpy()
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)) if keys else [()] * batch.num_rows
            counts = batch.column("n").to_numpy()
            by_group: dict = {}
            for at, key in enumerate(names):
                by_group.setdefault(key, []).append(at)
            for key, these in by_group.items():
                part = np.stack([flat[ends[a] : ends[a + 1]] for a in these]).sum(axis=0)
                n, x = held.get(key, (0, 0.0))
                held[key] = (n + int(counts[these].sum()), x + part)
            if len(held) > GROUPS_HELD:
                yield frame()
        if held:
            yield frame()

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    # a tree: what each task adds up, then some sums of each group by a salt, then one
    level = column.mapInArrow(added, schema)
    level = level.withColumn("_salt", F.spark_partition_id() % FANOUT).repartition(*keys, "_salt").drop("_salt").mapInArrow(added, schema)
    level = (level.repartition(*keys) if keys else level.coalesce(1)).mapInArrow(added, schema)
    return level.select(*keys, "n", F.transform("total", lambda x: x / F.col("n")).alias("mean"))


def pool_clips(frames: DataFrame) -> DataFrame:
    """(video_id, clip_idx, n, mean): the mean of a clip's frame vectors."""
    return vector_means(frames, ["video_id", "clip_idx"])


#: Groups of a block, about: of so many with as many, place by place, a task makes its sums.
BLOCK_GROUPS = 1_000


def space_similarity(features: DataFrame, group: str = "modality", wide: bool = False) -> DataFrame:
    """(left, right, mean_vector_cosine, mean_pairwise_cosine) of each two groups and of each with itself.

    The mean cosine of all pairs is the dot product of the mean unit vectors, so no pair of vectors is ever formed; groups
    meet place by place, as one row for each place of a mean, in blocks by a hash of the group, so that with many groups the work of a
    place is many tasks. ``wide`` sums vectors with NumPy."""
    means = wide_vector_means if wide else vector_means
    places = lambda df, name: means(df, [group]).select(group, F.posexplode("mean").alias("_i", name))
    m = places(features, "m").join(places(features.select(group, l2_normalize("feature").alias("feature")), "u"), [group, "_i"])
    blocks = max(1, -(-features.select(group).distinct().count() // BLOCK_GROUPS))
    own, other = F.pmod(F.xxhash64(group), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sides = (("left", own, other), ("right", other, own))
    a, b = (m.select("_i", F.col(group).alias(name), F.col("m").alias(f"m_{name}"), F.col("u").alias(f"u_{name}"), x.alias("_x"), y.alias("_y")) for name, x, y in sides)
    sums = a.join(b, ["_i", "_x", "_y"]).filter(F.col("left") <= F.col("right")).groupBy("left", "right").agg(
        F.sum(F.col("m_left") * F.col("m_right")).alias("mm"), F.sum(F.col("m_left") * F.col("m_left")).alias("ll"), F.sum(F.col("m_right") * F.col("m_right")).alias("rr"), F.sum(F.col("u_left") * F.col("u_right")).alias("uu")
    )
    return sums.select("left", "right", F.try_divide("mm", F.sqrt("ll") * F.sqrt("rr")).alias("mean_vector_cosine"), F.col("uu").alias("mean_pairwise_cosine"))
