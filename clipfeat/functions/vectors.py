"""Arithmetic on vector columns (arrays of float or double); sums are kept in double.

The column forms stay in the JVM and suit up to some hundred dimensions; the ``arrow_`` forms stack a batch and use NumPy,
for the wide vectors of real encoders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def sum_squares(v) -> Column:
    return F.aggregate(_col(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def l2_norm(v) -> Column:
    return F.sqrt(sum_squares(v))


def cosine(a, b) -> Column:
    """Null where a norm is zero."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def l2_normalize(v) -> Column:
    """A zero vector stays as it is."""
    norm = l2_norm(v)
    return F.when(norm > 0, F.transform(_col(v), lambda x: x.cast("double") / norm)).otherwise(F.transform(_col(v), lambda x: x.cast("double")))


def is_finite(v) -> Column:
    """True if no element is null, NaN or infinite (Spark orders NaN above infinity)."""
    return F.coalesce(F.forall(_col(v), lambda x: F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False))


def to_float32(v) -> Column:
    return F.transform(_col(v), lambda x: x.cast("float"))


def _bf16(a: np.ndarray) -> np.ndarray:
    """To the nearest of 8 significant bits, half to even, by adding below the cut."""
    u = np.ascontiguousarray(a, np.float32).view(np.uint32)
    kept = (u + np.uint32(0x7FFF) + ((u >> np.uint32(16)) & np.uint32(1))) & np.uint32(0xFFFF0000)
    return np.where(np.isfinite(a), kept.view(np.float32), a)


def round_trip(kind: str):
    """A pandas UDF that stores vectors in half precision (``fp16`` or ``bf16``) and reads them back."""
    if kind not in ("fp16", "bf16"):
        raise ValueError(f"precision {kind!r}: fp16 or bf16")

    @F.pandas_udf("array<float>")
    def stored(vectors: pd.Series) -> pd.Series:
        one = (lambda a: a.astype(np.float16).astype(np.float32)) if kind == "fp16" else _bf16
        return vectors.map(lambda v: None if v is None else one(np.asarray(v, np.float32)))

    return stored


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in ("ab", "aa", "bb", "gap")]))
def pair_sums(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """For wide vectors: their dot product, sums of squares, and the sum of squares of their difference; null where one is null or their
    lengths differ. Pairs of one length are taken together."""
    out = np.full((len(a), 4), np.nan)
    sizes: dict[int, list[int]] = {}
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x is not None and y is not None and len(x) == len(y):
            sizes.setdefault(len(x), []).append(k)
    for these in sizes.values():
        for at in range(0, len(these), 512):
            part = these[at : at + 512]
            x, y = (np.stack([np.asarray(v.iloc[k], np.float64) for k in part]) for v in (a, b))
            out[part] = np.stack([np.einsum("ij,ij->i", p, q) for p, q in ((x, y), (x, x), (y, y), (x - y, x - y))], axis=1)
    known = np.zeros(len(a), bool)
    known[[k for these in sizes.values() for k in these]] = True
    frame = pd.DataFrame(out, columns=["ab", "aa", "bb", "gap"])
    return frame if known.all() else frame.astype(object).where(known[:, None], None)


def arrow_cosine(a, b) -> Column:
    """``cosine`` for wide vectors."""
    s = pair_sums(_col(a), _col(b))
    return F.try_divide(s["ab"], F.sqrt(s["aa"]) * F.sqrt(s["bb"]))
