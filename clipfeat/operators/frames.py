"""Pixels: bilinear resizing and the centre crop, on frames (video_id, frame_idx, pts, height, width, pixels)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions.windows import CROP, PIXEL_MEAN, PIXEL_STD


def geometry(width: int, height: int, size: int, mode: str = "round") -> tuple[int, int, int, int]:
    """(new width, new height, left, top), as ``functions.windows.resize_geometry``."""
    if mode == "round":
        scale = size / min(width, height)
        w, h = int(width * scale + 0.5), int(height * scale + 0.5)
    else:
        long = lambda a, b: int(a * size / b / 2 + 0.5) * 2
        w, h = (size, long(height, width)) if width <= height else (long(width, height), size)
    return w, h, (w - size) // 2, (h - size) // 2


def resize_crop(image: np.ndarray, size: int = CROP, mode: str = "round") -> np.ndarray:
    """Only the pixels of the crop are computed: pixel centres at halves, edges repeated, no smoothing."""
    h, w = image.shape[:2]
    nw, nh, left, top = geometry(w, h, size, mode)
    if (nw, nh) == (w, h):
        return np.ascontiguousarray(image[top : top + size, left : left + size])

    def axis(n: int, new: int, first: int):
        x = (np.arange(first, first + size) + 0.5) * n / new - 0.5
        low = np.floor(x).astype(np.int64)
        return np.clip(low, 0, n - 1), np.clip(low + 1, 0, n - 1), (x - low).astype(np.float32)

    y0, y1, fy = axis(h, nh, top)
    x0, x1, fx = axis(w, nw, left)
    rows = image[y0].astype(np.float32) * (1 - fy)[:, None, None] + image[y1].astype(np.float32) * fy[:, None, None]
    out = rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


#: Bytes of resized pixels that a task holds before it sends them on.
_HELD = 4 << 20


def _resized(batches, size: int, mode: str):
    def one(p, h, w):
        if p is None or pd.isna(h) or pd.isna(w) or h <= 0 or w <= 0 or len(p) != h * w * 3:
            return None
        if h == size and w == size:  # the crop is the frame
            return p
        return resize_crop(np.frombuffer(bytes(p), np.uint8).reshape(int(h), int(w), 3), size, mode).tobytes()

    few = max(1, _HELD // (size * size * 3))
    for pdf in batches:
        for at in range(0, len(pdf), few):
            part = pdf.iloc[at : at + few]
            pixels = [one(*x) for x in zip(part["pixels"].tolist(), part["height"].tolist(), part["width"].tolist(), strict=True)]
            yield part.assign(pixels=pd.Series(pixels, index=part.index, dtype=object), height=size, width=size)


def resize_frames(frames: DataFrame, size: int = CROP, mode: str = "round") -> DataFrame:
    """Frames of ``size`` by ``size`` RGB pixels, some megabytes at a time; columns other than the pixels' stay. A frame that does not
    have the bytes of its size gets null pixels, for the encoder to report."""
    return frames.mapInPandas(lambda batches: _resized(batches, size, mode), frames.schema)


def normalize_block(block: np.ndarray) -> np.ndarray:
    """RGB levels to the encoder's scale, by channel."""
    return (block.astype(np.float32) - np.array(PIXEL_MEAN, np.float32)) / np.array(PIXEL_STD, np.float32)
