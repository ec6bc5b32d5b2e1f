"""Where intermediate tables and files of these operators live.

Everything goes below ``spark.checkpoint.dir``, the folder that the driver and all executors share.
The setting is read from the session; only where it is unset on a single machine (tests, a laptop) a folder is made.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in local mode a fresh one where the setting is absent, on a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="clipfeat-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/clipfeat-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage,
    survives lost executors, and lets several consumers read it without recomputing it."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``df`` through ``run``, pandas frames in and out, as mapInPandas does; but an integer column that holds a null comes as
    Int64 and not as floats, so that no value beyond 2 to the 53 changes."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def frames(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                if pa.types.is_integer(column.type) and column.null_count:
                    pdf[name] = pd.array(column.to_pylist(), dtype="Int64")
            yield pdf

    def through(batches):
        for pdf in run(frames(batches)):
            columns = [pa.array(pdf[f.name], type=f.type, from_pandas=True) for f in kinds]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return df.mapInArrow(through, schema)


def frame_of(rows: list, names: list) -> pd.DataFrame:
    """A frame of rows whose values stay what they are: pandas would make floats of numbers beside a None."""
    return pd.DataFrame(rows, columns=names, dtype=object)


def write_file(uri: str, data: bytes) -> None:
    """Write a whole file under a temporary name, then rename it into place."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, path)


def read_file(uri: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path, compression=None) as src:
        return src.read()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def for_training():
    """True for the rows whose labels may be learned: crc32 of doc_id as text, mod 4, is not 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def label_sample(labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """(doc_id, y): at most ``max_rows`` labelled documents outside the held-out fold, those of the smallest hashes of doc_id,
    so the same ones in every run. A document with several labels counts as its highest; a null label is none.

    A threshold on the hash, from the number of labels, leaves about as many rows as are wanted before they are sorted, so no
    task sends more than its share whatever the number of labels. The result is a small table: 16 bytes a row."""
    known = labels.filter(for_training() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
    known = known.withColumn("hash", F.xxhash64("doc_id"))
    n = known.count()
    if n > max_rows:
        wanted = (max_rows + 8 * max_rows**0.5) / n
        known = known.filter(F.col("hash") <= F.lit(min((1 << 63) - 1, int(wanted * (1 << 64)) - (1 << 63))))
    return staged(known.orderBy("hash", "doc_id").limit(max_rows).select("doc_id", "y"), f"{column}-labels")
