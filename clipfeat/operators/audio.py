"""Waveforms: PCM, resampling, windows, layer norm, silence.

Waves are blocks (video_id, block_id, sample_offset, samples), in any order; a block that could not be read may have null samples
and an ``error``, which goes along to the output blocks and windows that would need it. What an output block or a group of
windows needs follows from offsets alone, so samples are shuffled once in each step and never joined; ``map_windows`` is resampling
and windows in one step."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import SAMPLE_RATE, num_windows
from .groups import gathered, sorted_groups

LAYER_NORM_EPS = 1e-5


def pcm_to_mono(channels: int = 2):
    """A pandas UDF from interleaved 16-bit little-endian PCM to mono samples in [-1, 1); a last incomplete frame is dropped."""

    @F.pandas_udf("array<float>")
    def mono(pcm: pd.Series) -> pd.Series:
        def one(b):
            if b is None:
                return None
            a = np.frombuffer(bytes(b[: len(b) // 2 * 2]), "<i2").astype(np.float32) / np.float32(32768)
            return a[: len(a) // channels * channels].reshape(-1, channels).mean(axis=1, dtype=np.float32)

        return pcm.map(one)

    return mono


def to_blocks(waves: DataFrame, block: int) -> DataFrame:
    """(video_id, block_id, sample_offset, samples) from short whole waves (video_id, samples)."""
    n = F.ceil(F.size("samples") / block).cast("int")
    rows = waves.filter(F.size("samples") > 0).select("video_id", "samples", F.explode(F.sequence(F.lit(0), n - 1)).alias("block_id"))
    return rows.select("video_id", "block_id", (F.col("block_id").cast("long") * block).alias("sample_offset"), F.slice("samples", F.col("block_id") * block + 1, F.lit(block)).alias("samples"))


#: Zero crossings on a side, the window's shape and the pass band of the Kaiser filters of a public resampler.
FILTERS = {"kaiser_best": (64, 14.769656459379492, 0.9475937167399596), "kaiser_fast": (16, 8.555504641634386, 0.85)}


@lru_cache(maxsize=16)
def resample_filter(up: int, down: int, zeros: int | None = None, name: str = "kaiser_best") -> tuple[np.ndarray, int]:
    """(taps by phase, half-width in input samples) of a Kaiser-windowed sinc that changes the rate by up/down; ``zeros`` in place of the
    filter's own number makes it shorter or longer."""
    own, beta, rolloff = FILTERS[name]
    zeros = zeros or own
    cut = rolloff * min(1.0, up / down)
    half = int(np.ceil(zeros / cut))
    at = np.arange(-half, half + 1)
    taps = np.empty((up, 2 * half + 1))
    for phase in range(up):
        x = at - phase / up
        inside = np.clip(1 - (x * cut / zeros) ** 2, 0, None)
        taps[phase] = cut * np.sinc(cut * x) * np.where(np.abs(x * cut) <= zeros, np.i0(beta * np.sqrt(inside)) / np.i0(beta), 0)
    return taps, half


def resample(samples: np.ndarray, first: int, up: int, down: int, begin: int, end: int, taps: np.ndarray, half: int) -> np.ndarray:
    """Output samples [begin, end) from input samples that start at index ``first``; input outside is zero. Places are integers."""
    if end <= begin:
        return np.empty(0, np.float32)
    place, last = begin * down // up, (end - 1) * down // up
    low, high = place - half, last + half + 1  # the input that is needed
    x = np.zeros(high - low)
    a, b = max(low, first), min(high, first + len(samples))
    if a < b:
        x[a - low : b - low] = samples[a - first : b - first]
    out = np.empty(end - begin, np.float32)
    # outputs that lie up apart have the same taps, and their inputs lie down apart: one product of a strided view for each phase
    for j in range(begin, min(end, begin + up)):
        n = -(-(end - j) // up)
        there = x[j * down // up - place :]
        if down == 1:  # neighbouring inputs: the same products without a view of many overlapping rows
            out[j - begin :: up] = np.correlate(there[: n + 2 * half], taps[j * down % up], "valid")
            continue
        view = np.lib.stride_tricks.as_strided(there, (n, 2 * half + 1), (down * x.itemsize, x.itemsize))
        out[j - begin :: up] = view @ taps[j * down % up]
    return out


def _with_error(blocks: DataFrame) -> DataFrame:
    """Blocks that hold samples or an error, of videos with an id."""
    rows = blocks if "error" in blocks.columns else blocks.withColumn("error", F.lit(None).cast("string"))
    return rows.filter(F.col("video_id").isNotNull() & ((F.size("samples") > 0) | F.col("error").isNotNull()))


def _wave(rows: dict[str, np.ndarray], kind) -> tuple[int, np.ndarray]:
    """(offset, samples) of neighbouring blocks in order; raises what one of them could not be read for, or if some are missing."""
    if bad := [e for e in rows["error"] if e is not None and e == e]:
        raise ValueError(bad[0])
    parts = [np.asarray(v, kind) for v in rows["samples"]]
    starts = rows["sample_offset"]
    if not np.array_equal(starts[1:], starts[0] + np.cumsum([len(p) for p in parts[:-1]], dtype=np.int64)):
        raise ValueError("blocks are missing or repeated")
    return int(starts[0]), np.concatenate(parts)


def resample_blocks(blocks: DataFrame, orig_rate: int | str, rate: int = SAMPLE_RATE, block: int = 1 << 16, zeros: int | None = None, res_type: str = "kaiser_best") -> DataFrame:
    """Blocks at another rate, from ``orig_rate``, which is a number or the name of a column. Each block is sent to the output
    blocks that need it, so block borders give what one pass over the whole wave would give; no task holds a whole wave. ``res_type`` names the filter."""
    own, _, rolloff = FILTERS[res_type]
    zeros = zeros or own
    if orig_rate == rate:
        return blocks
    rows = _with_error(blocks).withColumn("_rate", F.lit(orig_rate) if isinstance(orig_rate, int) else F.col(orig_rate))
    names = ["video_id", "block_id", "sample_offset", "samples", "error"]
    stay = (F.col("_rate") == rate) | F.col("_rate").isNull()
    size, ratio = F.coalesce(F.greatest(F.size("samples"), F.lit(0)), F.lit(0)), F.lit(float(rate)) / F.col("_rate")
    half = F.ceil(zeros / (rolloff * F.least(F.lit(1.0), ratio)))
    lo = F.greatest(F.lit(0), F.floor((F.col("sample_offset") - half - 1) * ratio / block)).cast("long")
    hi = F.floor((F.col("sample_offset") + size + half + 1) * ratio / block).cast("long")
    sent = rows.filter(~stay).withColumn("out_block", F.explode(F.sequence(lo, hi))).select("video_id", "out_block", "sample_offset", "samples", "error", "_rate")

    def run(batches):
        def each():
            for (video, k), group in sorted_groups(batches, ["video_id", "out_block"]):
                begin, orig = int(k) * block, int(group["_rate"][0])
                g = gcd(orig, rate)
                up, down = rate // g, orig // g
                try:
                    first, x = _wave(group, np.float64)
                    end = min(begin + block, -(-(first + len(x)) * up // down))  # the group ends with the wave, or beyond what it needs
                    y, error = resample(x, first, up, down, begin, end, *resample_filter(up, down, zeros, res_type)), None
                except ValueError as e:
                    y, error = None, str(e)
                if error or len(y):
                    yield [video], [int(k)], [begin], [y], [error]

        yield from gathered(each(), ["video_id", "block_id", "sample_offset", "samples", "error"], 16 if block > 1 << 14 else 256)

    kind = blocks.schema["video_id"].dataType.simpleString()
    ordered = sent.repartition("video_id", "out_block").sortWithinPartitions("video_id", "out_block", "sample_offset")
    out = ordered.mapInPandas(run, f"video_id {kind}, block_id int, sample_offset long, samples array<float>, error string")
    return out if isinstance(orig_rate, int) else out.unionByName(rows.filter(stay).select(*names))


def silence_length(duration: str, rate: int = SAMPLE_RATE):
    """Whole samples of silence that a duration holds; none without one. Durations are decimal numbers: as binary fractions 16.15 seconds
    of 16,000 would be 258,399.99... samples, one less than there are, which can cost a window."""
    return F.coalesce((F.col(duration).try_cast("decimal(20, 9)") * rate).cast("long"), F.lit(0).cast("long"))


def silence_fallback(videos: DataFrame, rate: int = SAMPLE_RATE, block: int = 1 << 16) -> DataFrame:
    """(video_id, block_id, sample_offset, samples, silent) of zeros for the videos (video_id, duration, has_audio) that have no
    audio: the duration times the rate as binary numbers, cut to a whole one, in blocks. Without a duration there are none, and the
    video fails later."""
    rows = videos.filter(~F.col("has_audio")).withColumn("total", (F.col("duration") * rate).cast("long")).filter("total > 0")
    rows = rows.withColumn("sample_offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(block).cast("long"))))
    n = F.least(F.lit(block).cast("long"), F.col("total") - F.col("sample_offset")).cast("int")
    return rows.select("video_id", (F.col("sample_offset") / block).cast("int").alias("block_id"), "sample_offset", F.array_repeat(F.lit(0.0).cast("float"), n).alias("samples"), F.lit(True).alias("silent"))


def layer_norm(windows: np.ndarray) -> np.ndarray:
    """Each row less its mean, over the root of its population variance; zeros stay zeros."""
    x = windows.astype(np.float64)
    mean = x.mean(axis=1, keepdims=True)
    return ((x - mean) / np.sqrt(x.var(axis=1, keepdims=True) + LAYER_NORM_EPS)).astype(np.float32)


def _groups(blocks: DataFrame, window: int, hop: int, per_group: int, orig_rate: int | str | None, rate: int, zeros: int | None, res_type: str, silent: DataFrame | None) -> DataFrame:
    """(video_id, part, sample_offset, samples, error, rate, silence): what each group of ``per_group`` windows needs of a wave's blocks, at
    their own rate and no more than it needs, groups whole in a task and in order. A silent video sends a length for each group and
    no samples."""
    own, _, rolloff = FILTERS[res_type]
    span = hop * per_group
    reach = span - hop + window  # output samples from a group's first to its last
    rows = _with_error(blocks).withColumn("rate", F.lit(orig_rate).cast("int") if orig_rate is None or isinstance(orig_rate, int) else F.col(orig_rate).cast("int"))
    stay = F.col("rate").isNull() | (F.col("rate") == rate)
    ratio = F.when(stay, 1.0).otherwise(F.lit(float(rate)) / F.col("rate"))
    beside = F.when(stay, 0).otherwise(F.ceil((zeros or own) / (rolloff * F.least(F.lit(1.0), ratio))) + 1).cast("long")
    rows = rows.withColumn("_ratio", ratio).withColumn("_beside", beside).withColumn("_end", F.col("sample_offset") + F.greatest(F.size("samples"), F.lit(1)))
    lo = F.greatest(F.lit(0), F.ceil((F.floor((F.col("sample_offset") - F.col("_beside")) * F.col("_ratio")) - reach + 1) / span)).cast("long")
    hi = F.greatest(lo, F.floor((F.col("_end") - 1 + F.col("_beside")) * F.col("_ratio") / span)).cast("long")
    rows = rows.withColumn("part", F.explode(F.sequence(lo, hi)))
    start = F.greatest(F.col("sample_offset"), F.floor(F.col("part") * span / F.col("_ratio")) - F.col("_beside")).cast("long")
    stop = F.least(F.col("_end"), F.ceil((F.col("part") * span + reach) / F.col("_ratio")) + F.col("_beside")).cast("long")
    rows = rows.withColumn("_start", start).withColumn("_n", (stop - start).cast("int")).filter("_n > 0 or error is not null")
    cut = F.when(F.col("error").isNull(), F.slice("samples", (F.col("_start") - F.col("sample_offset") + 1).cast("int"), F.greatest(F.col("_n"), F.lit(0))))
    rows = rows.select("video_id", "part", F.when(F.col("error").isNull(), F.col("_start")).otherwise(F.col("sample_offset")).alias("sample_offset"), cut.alias("samples"), "error", "rate", F.lit(0).cast("long").alias("silence"))
    if silent is not None:
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((num_windows("total", window, hop) - 1) / per_group).cast("long")))
        still = silent.filter("total > 0").select("video_id", "total", parts.alias("part"))
        rows = rows.unionByName(still.select(
            "video_id", "part", (F.col("part") * span).alias("sample_offset"), F.lit(None).cast("array<float>").alias("samples"), F.lit(None).cast("string").alias("error"),
            F.lit(None).cast("int").alias("rate"), F.least(F.lit(reach), F.col("total") - F.col("part") * span).cast("long").alias("silence"),
        ))
    return rows.repartition("video_id", "part").sortWithinPartitions("video_id", "part", "sample_offset")


def _group_windows(batches, window: int, hop: int, per_group: int, rate: int, zeros: int | None, res_type: str, normalize: bool):
    """Frames of (video_id, step, samples, error) from rows of ``_groups``."""

    def wave(part: int, group):
        """(first output index, samples at ``rate``) of a group."""
        begin = part * per_group * hop
        if n := int(group["silence"][0]):
            return begin, np.zeros(n, np.float32)
        orig = group["rate"][0]
        if orig is None or orig != orig or orig == rate:
            first, x = _wave(group, np.float32)
            if first > begin:
                raise ValueError("blocks are missing or repeated")
            return first, x
        first, x = _wave(group, np.float64)
        g = gcd(int(orig), rate)
        up, down = rate // g, int(orig) // g
        taps, half = resample_filter(up, down, zeros, res_type)
        if first > max(0, begin * down // up - half):
            raise ValueError("blocks are missing or repeated")
        end = min(begin + (per_group - 1) * hop + window, -(-(first + len(x)) * up // down))  # the group ends with the wave, or beyond what it needs
        return begin, resample(x, first, up, down, begin, end, taps, half)

    def each():
        for (video, part), group in sorted_groups(batches, ["video_id", "part"]):
            begin = int(part) * per_group
            try:
                first, x = wave(int(part), group)
                end = first + len(x)
                if end < window and not part:
                    w, steps = np.tile(x, -(-window // end))[None, :window], [0]
                else:
                    steps = list(range(begin, min(begin + per_group, max(0, (end - window) // hop + 1))))
                    w = np.stack([x[k * hop - first : k * hop - first + window] for k in steps]) if steps else np.zeros((0, window), np.float32)
                out = [video] * len(steps), steps, list(layer_norm(w) if normalize else w), [None] * len(steps)
            except ValueError as e:
                out = [video], [begin], [None], [str(e)]
            yield out

    yield from gathered(each(), ["video_id", "step", "samples", "error"], 256)


def audio_windows(blocks: DataFrame, window: int, hop: int, normalize: bool = True, per_group: int = 64) -> DataFrame:
    """(video_id, step, samples, error): hopping windows over a wave's blocks; null samples where a block is missing or has an error.

    Windows are made in groups of some neighbours; a block goes to each group that it overlaps, so a group, not a wave, is what a
    task holds. A wave shorter than a window is repeated to fill one. Rows without a video_id are left out."""
    run = lambda batches: _group_windows(batches, window, hop, per_group, SAMPLE_RATE, None, "kaiser_best", normalize)
    kind = blocks.schema["video_id"].dataType.simpleString()
    return _groups(blocks, window, hop, per_group, None, SAMPLE_RATE, None, "kaiser_best", None).mapInPandas(run, f"video_id {kind}, step long, samples array<float>, error string")


def map_windows(blocks: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, window: int, hop: int, orig_rate: int | str | None = None, rate: int = SAMPLE_RATE, silent: DataFrame | None = None, zeros: int | None = None, res_type: str = "kaiser_best", normalize: bool = True, per_group: int = 64) -> DataFrame:
    """Rows of ``schema`` that ``fn`` makes of frames of windows (video_id, step, samples, error), in the task that makes the windows: windows
    are far more bytes than the samples they overlap on, so they are neither shuffled nor sent between processes.

    ``audio_windows`` of ``resample_blocks`` in one shuffle, of samples at their own rate: what a group of windows needs follows from
    offsets alone. ``orig_rate`` is a number, the name of a column, or None for waves at ``rate`` already; a null rate is ``rate``. ``silent``: (video_id, total)
    of videos that are so many zeros."""
    run = lambda batches: fn(_group_windows(batches, window, hop, per_group, rate, zeros, res_type, normalize))
    return _groups(blocks, window, hop, per_group, orig_rate, rate, zeros, res_type, silent).mapInPandas(run, schema)


def layer_norm_long(rows: DataFrame) -> DataFrame:
    """``layer_norm`` for long rows (video_id, step, pos, value), by sums per window."""
    stats = rows.groupBy("video_id", "step").agg(F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    out = rows.join(stats, ["video_id", "step"])
    return out.select("video_id", "step", "pos", ((F.col("value") - F.col("mean")) / F.sqrt(F.col("var") + LAYER_NORM_EPS)).alias("value"))
