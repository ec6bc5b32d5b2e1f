"""What is left to do: ids that exist, are not done, and belong to a shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import SUFFIXES, done_line_to_id, parse_feature_name


def existing_ids(ids: DataFrame, media: DataFrame, id_col: str = "video_id") -> DataFrame:
    return ids.join(media.select(id_col), id_col, "left_semi")


def missing_ids(ids: DataFrame, media: DataFrame, id_col: str = "video_id") -> DataFrame:
    """Distinct ids asked for that have no medium."""
    return ids.select(id_col).join(media.select(id_col), id_col, "left_anti").distinct()


def pending_ids(ids: DataFrame, done: DataFrame, overwrite: bool = False, id_col: str = "video_id") -> DataFrame:
    return ids if overwrite else ids.join(done.select(id_col), id_col, "left_anti")


def done_ids(stored: DataFrame, ledger_lines: DataFrame, modality: str, *more: DataFrame, id_col: str = "video_id") -> DataFrame:
    """Distinct ids that are done: those with a stored matrix (``stored``: id), those of ledger lines (``ledger_lines``: value),
    and those of further frames of either kind. A lost matrix with a ledger line still counts as done."""
    parts = []
    for df in (stored, ledger_lines, *more):
        parts.append(df.select(id_col) if id_col in df.columns else df.select(done_line_to_id("value", SUFFIXES[modality]).alias(id_col)).filter(F.col(id_col).isNotNull()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def ids_of_feature_files(names: DataFrame, modality: str) -> DataFrame:
    """(video_id) of file names (``name``) of one modality; temporary files don't count."""
    parsed = names.filter(~F.col("name").endswith(".tmp.npy")).select(parse_feature_name("name").alias("p"))
    return parsed.filter(F.col("p.modality") == modality).select("p.video_id")


#: Ids in a range, about; how many of each range's ids come to the driver to find where ranges begin; ranges, at most: with more ids
#: the ranges grow, and what comes to the driver doesn't.
RANGE_IDS, SAMPLED, MOST_RANGES = 100_000, 20, 10_000


def _ranges(ids: DataFrame, id_col: str) -> list:
    """Where ranges of about ``RANGE_IDS`` distinct ids begin, from an even sample by hash: ``SAMPLED`` ids of each range, and of no
    more than ``MOST_RANGES`` ranges."""
    n = ids.count()
    if n <= RANGE_IDS:
        return []
    share = SAMPLED / max(RANGE_IDS, n / MOST_RANGES)
    sample = ids.filter(F.xxhash64(id_col) < F.lit(int(share * (1 << 64)) - (1 << 63)))
    return [r[0] for r in sample.orderBy(id_col).collect()][::SAMPLED][1:]


def shard_ids(ids: DataFrame, num_shards: int, shard_id: int | None = None, id_col: str = "video_id") -> DataFrame:
    """Sorted distinct ids dealt out in turn: (id, position, shard); only one shard's if ``shard_id`` is given.

    Ids are dealt to ranges, numbered inside each and from the sums of the ranges before, one row each, so no task sees more than
    its range. The ranges are settled first, so a task that runs again numbers as before."""
    if num_shards < 1 or shard_id is not None and not 0 <= shard_id < num_shards:
        raise ValueError(f"shard {shard_id} of {num_shards}")
    rows = ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    starts = _ranges(rows, id_col)

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(starts, object), values.to_numpy(object), side="right")).astype("int32")

    rows = rows.withColumn("_range", range_of(id_col) if starts else F.lit(0))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(id_col))
    out = rows.withColumn("_at", inside - 1).join(F.broadcast(sums), "_range").select(id_col, (F.col("_first") + F.col("_at")).cast("long").alias("position"))
    out = out.withColumn("shard", (F.col("position") % num_shards).cast("int"))
    return out if shard_id is None else out.filter(F.col("shard") == shard_id)


def first_pending(ids: DataFrame, n: int, id_col: str = "video_id") -> DataFrame:
    """The first ``n`` ids in order."""
    return ids.orderBy(id_col).limit(n)


def run_summary(runs: DataFrame) -> DataFrame:
    """By shard, from (shard, status, windows, seconds, wait_seconds): videos ok and failed, their windows, windows per second,
    and the share of time spent waiting."""
    ok = F.col("status") == "ok"
    return runs.groupBy("shard").agg(
        F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("windows"))), F.lit(0)).alias("windows_ok"), F.coalesce(F.sum(F.when(~ok, F.col("windows"))), F.lit(0)).alias("windows_failed"),
        F.try_divide(F.sum(F.when(ok, F.col("windows"))), F.sum("seconds")).alias("windows_per_sec"), F.try_divide(F.sum("wait_seconds"), F.sum("seconds")).alias("wait_share"),
    )
