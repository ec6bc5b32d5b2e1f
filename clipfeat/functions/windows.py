"""Index arithmetic of hopping windows, frames and samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FPS, CROP, CLIP_FRAMES, CLIP_STRIDE = 16, 256, 16, 8
SAMPLE_RATE, WINDOW_SEC, STRIDE_SEC = 16_000, 1.0, 0.5


def _col(c: Column | str | int | float) -> Column:
    return c if isinstance(c, Column) else F.col(c) if isinstance(c, str) else F.lit(c)


def num_windows(total, window: int, hop: int) -> Column:
    """Windows that ``total`` items are planned to give: one at least, whatever the total."""
    return F.greatest(F.lit(0), F.floor((_col(total) - window) / hop)).cast("long") + 1


def frames_of(duration, fps: int = FPS) -> Column:
    """Whole frames of ``duration`` seconds; 0 where it is null."""
    return F.coalesce((_col(duration) * fps).cast("long"), F.lit(0).cast("long"))


def expected_clips(duration, fps: int = FPS, num_frames: int = CLIP_FRAMES, stride: int = CLIP_STRIDE, max_clips: int | None = None) -> Column:
    """Clips planned for a video: its whole frames are counted first."""
    n = num_windows(frames_of(duration, fps), num_frames, stride)
    return n if max_clips is None else F.least(n, F.lit(max_clips))


def expected_steps(duration, fps: int = FPS, num_frames: int = CLIP_FRAMES, stride: int = CLIP_STRIDE) -> Column:
    """Steps that a checker expects: one rounding down at the end."""
    return F.greatest(F.lit(0), F.floor((_col(duration) * fps - num_frames) / stride)).cast("long") + 1


def clip_time(clip_idx, stride: int = CLIP_STRIDE, fps: int = FPS, start_sec: float = 0.0) -> Column:
    return F.lit(start_sec) + _col(clip_idx) * stride / fps


def seconds_to_samples(seconds, sample_rate: int = SAMPLE_RATE) -> Column:
    """Rounded half to even."""
    return F.bround(_col(seconds) * sample_rate, 0).cast("long")


def stride_seconds(stride, fps: int = FPS) -> Column:
    return _col(stride) / fps


def resize_geometry(width, height, size: int = CROP, mode: str = "round") -> Column:
    """struct(new_width, new_height, left, top): the short side becomes ``size``, then the centre is cut out.

    ``round`` rounds each side; ``even`` makes the long side the nearest even number instead."""
    w, h = _col(width), _col(height)
    if mode == "round":
        scale = F.lit(float(size)) / F.least(w, h)
        nw, nh = (F.floor(x * scale + 0.5).cast("int") for x in (w, h))
    elif mode == "even":
        long = lambda a, b: (F.floor(a * size / b / 2 + 0.5) * 2).cast("int")
        nw = F.when(w <= h, F.lit(size)).otherwise(long(w, h))
        nh = F.when(w <= h, long(h, w)).otherwise(F.lit(size))
    else:
        raise ValueError(f"mode {mode!r}: round or even")
    half = lambda x: F.floor((x - size) / 2).cast("int")
    return F.struct(nw.alias("new_width"), nh.alias("new_height"), half(nw).alias("left"), half(nh).alias("top"))


#: Mean and standard deviation of the encoder's input, by channel.
PIXEL_MEAN, PIXEL_STD = (122.771, 116.746, 104.094), (68.5, 66.632, 70.323)


def normalize_pixel(value, channel: int) -> Column:
    return (_col(value) - PIXEL_MEAN[channel]) / PIXEL_STD[channel]
