"""Running encoders over chunks of frames and windows of samples, and linear heads over features.

An encoder is a factory: called once in each task, it returns a function from a batch of arrays to (n, dim) vectors. What
goes wrong with a chunk or a window is a row with its error and no vector; all else goes on. A factory that fails stops the job."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.vectors import l2_norm
from ..functions.windows import SAMPLE_RATE
from .audio import map_windows
from .frames import normalize_block
from .groups import gathered, sorted_groups

Encoder = Callable[[np.ndarray], np.ndarray]
Factory = Callable[[], Encoder]


def projection_encoder(dim: int = 64, seed: int = 0) -> Factory:
    """A deterministic stand-in: means over cells of the input, times fixed cosines. The result doesn't depend on the batch."""

    def factory() -> Encoder:
        cosines = np.cos(np.arange(32)[:, None] * (np.arange(dim) + 1)[None] + seed)

        def encode(batch: np.ndarray) -> np.ndarray:
            flat = batch.reshape(len(batch), -1).astype(np.float64)
            n = flat.shape[1]
            sizes = n // 32 + (np.arange(32) < n % 32)
            cells, there = np.zeros((len(batch), 32)), int((sizes > 0).sum())
            if there:
                cells[:, :there] = np.add.reduceat(flat, (np.cumsum(sizes) - sizes)[:there], axis=1) / sizes[:there]
            return (cells @ cosines).astype(np.float32)

        return encode

    return factory


def unfold(block: np.ndarray, m: int, num_frames: int, stride: int) -> np.ndarray:
    """The m clips of a block of frames as a view; a block shorter than a clip is one clip, its last frame repeated."""
    if len(block) < num_frames:
        block = np.concatenate([block, np.repeat(block[-1:], num_frames - len(block), axis=0)])
    view = np.lib.stride_tricks.sliding_window_view(block, num_frames, axis=0)[::stride][:m]
    return np.moveaxis(view, -1, 1)


def gather_chunks(frames: DataFrame, num_frames: int, stride: int, clips_per_chunk: int, limit: int | None = None) -> DataFrame:
    """(video_id, chunk_id, frame_idx, height, width, pixels): frames sent to the chunks of clips that need them, chunks whole in a
    task and in order.

    A frame's chunks follow from its index alone, so pixels are shuffled once and nothing is joined; only the frames at the
    borders of chunks go twice. A long video is many chunks and so many tasks. Rows without a video_id are left out."""
    f = F.col("frame_idx")
    high = F.floor(f / stride)
    low = F.least(high, F.greatest(F.lit(0), F.ceil((f - (num_frames - 1)) / stride)))
    if limit is not None:
        high = F.least(high, F.lit(limit - 1))
    chunks = F.sequence(F.floor(low / clips_per_chunk), F.floor(high / clips_per_chunk))
    rows = frames.filter((low <= high) & F.col("video_id").isNotNull()).withColumn("chunk_id", F.explode(chunks))
    if limit is not None:  # a video's last clip ends here
        rows = rows.filter(f < (limit - 1) * stride + num_frames)
    return rows.select("video_id", "chunk_id", "frame_idx", "height", "width", "pixels").repartition("video_id", "chunk_id").sortWithinPartitions("video_id", "chunk_id", "frame_idx")


def _block(rows: dict[str, np.ndarray], first: int) -> np.ndarray:
    """The normalized frames of a chunk, which must be numbered from ``first`` without a gap and be of one size."""
    pixels = rows["pixels"]
    if not np.array_equal(rows["frame_idx"], np.arange(first, first + len(pixels))):
        raise ValueError("frames are missing or repeated")
    h, w = int(rows["height"][0]), int(rows["width"][0])
    if any(p is None or len(p) != h * w * 3 for p in pixels):
        raise ValueError(f"a frame does not have {h * w * 3} bytes")
    return normalize_block(np.frombuffer(b"".join(pixels), np.uint8).reshape(len(pixels), h, w, 3))


def encode_clips(chunks: DataFrame, factory: Factory, num_frames: int, stride: int, clips_per_chunk: int, modality: str = "visual") -> DataFrame:
    """(video_id, modality, step, feature, error) of each clip in what ``gather_chunks`` gives. A block is cut into clips by
    strides, without copies; a chunk that fails gives one row, of its first clip and with its error."""

    def run(batches):
        encode = factory()

        def each():
            for (video, chunk), rows in sorted_groups(batches, ["video_id", "chunk_id"]):
                first = int(chunk) * clips_per_chunk
                m = min(clips_per_chunk, max(0, (len(rows["frame_idx"]) - num_frames) // stride + 1)) or int(chunk == 0)
                if not m:  # the frames after the last complete clip
                    continue
                try:
                    vectors = np.asarray(encode(unfold(_block(rows, first * stride), m, num_frames, stride)), np.float32)[:m]
                    n = len(vectors)
                    out = [video] * n, [modality] * n, range(first, first + n), list(vectors), [None] * n
                except Exception as e:  # whatever a chunk does to the encoder belongs to its video
                    out = [video], [modality], [first], [None], [repr(e)]
                yield out

        yield from gathered(each(), ["video_id", "modality", "step", "feature", "error"])

    kind = chunks.schema["video_id"].dataType.simpleString()
    return chunks.mapInPandas(run, f"video_id {kind}, modality string, step long, feature array<float>, error string")


def _encode_windows(batches, factory: Factory, batch_size: int, modality: str):
    """Frames of (video_id, modality, step, feature, error) from frames of windows."""
    encode = factory()

    def vectors(samples):
        if any(x is None for x in samples):
            raise ValueError("samples are missing")
        v = np.asarray(encode(np.stack([np.asarray(x, np.float32) for x in samples])), np.float64)
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return list(np.divide(v, norm, out=v, where=norm > 0).astype(np.float32))

    def one(x):
        try:
            return vectors([x])[0], None
        except Exception as e:  # whatever a window does to the encoder belongs to its video
            return None, repr(e)

    for pdf in batches:
        out, errors = [], []
        if "error" in pdf:
            known = pdf["error"].notna()
            if known.any():
                bad = pdf[known]
                yield pd.DataFrame({"video_id": bad["video_id"].to_numpy(), "modality": modality, "step": bad["step"].to_numpy(), "feature": pd.Series([None] * len(bad), dtype=object), "error": bad["error"].to_numpy()})
                pdf = pdf[~known]
        for at in range(0, len(pdf), batch_size):
            part = pdf["samples"].iloc[at : at + batch_size]
            try:
                out += vectors(part)
                errors += [None] * len(part)
            except Exception:
                for v, e in map(one, part):
                    out.append(v)
                    errors.append(e)
        yield pd.DataFrame({"video_id": pdf["video_id"].to_numpy(), "modality": modality, "step": pdf["step"].to_numpy(), "feature": pd.Series(out, dtype=object), "error": pd.Series(errors, dtype=object)})


_VECTORS = "video_id {kind}, modality string, step long, feature array<float>, error string"


def encode_audio(windows: DataFrame, factory: Factory, batch_size: int = 64, modality: str = "audio") -> DataFrame:
    """(video_id, modality, step, feature, error) of each window, of unit length. If a batch fails its windows are tried one by
    one, and those that fail alone have an error."""
    kind = windows.schema["video_id"].dataType.simpleString()
    return windows.mapInPandas(lambda batches: _encode_windows(batches, factory, batch_size, modality), _VECTORS.format(kind=kind))


def encode_sound(blocks: DataFrame, factory: Factory, window: int, hop: int, orig_rate: int | str | None = None, rate: int = SAMPLE_RATE, silent: DataFrame | None = None, res_type: str = "kaiser_best", batch_size: int = 64, modality: str = "audio") -> DataFrame:
    """``encode_audio`` of the windows over blocks at their own rate and over silent videos, of which ``map_windows`` tells more."""
    kind = blocks.schema["video_id"].dataType.simpleString()
    encode = lambda frames: _encode_windows(frames, factory, batch_size, modality)
    return map_windows(blocks, encode, _VECTORS.format(kind=kind), window, hop, orig_rate, rate, silent, res_type=res_type)


def _outputs(fn: Callable[[object], Iterable[object]], x):
    """(seq, output, error) of an item, as they come."""
    seq = -1
    try:
        for seq, y in enumerate(fn(x)):
            yield seq, y, None
    except Exception as e:  # whatever the user's function raises belongs to its item
        yield seq + 1, None, repr(e)


def register_mapper(spark: SparkSession, name: str, fn: Callable[[object], Iterable[object]], output: str):
    """``map_items`` for SQL: ``SELECT t.id, m.* FROM t, LATERAL name(t.id) m`` gives (item, seq, output, error) for each output of
    each item. The type of item is that of the argument; outputs are sent on as they come."""
    kind = StructType.fromDDL(f"output {output}")["output"].dataType

    class Mapper:
        @staticmethod
        def analyze(item: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(StructType().add("item", item.dataType).add("seq", "long").add("output", kind).add("error", "string"))

        def eval(self, item):
            for row in _outputs(fn, item):
                yield (item, *row)

    return spark.udtf.register(name, udtf(Mapper))


def map_items(items: DataFrame, fn: Callable[[object], Iterable[object]], output: str, item: str = "item") -> DataFrame:
    """(item, seq, output, error): ``fn`` gives any number of outputs for an item, in order; an item's failure is one row with its
    error, after the outputs that came before it, and stops nothing else."""

    def run(batches):
        frame = lambda rows: pd.DataFrame(rows, columns=["item", "seq", "output", "error"])
        for pdf in batches:
            rows = []
            for x in pdf["item"]:
                for row in _outputs(fn, x):
                    rows.append((x, *row))
                    if len(rows) >= 500:
                        yield frame(rows)
                        rows = []
            yield frame(rows)

    kind = items.schema[item].dataType.simpleString()
    return items.select(F.col(item).alias("item")).mapInPandas(run, f"item {kind}, seq long, output {output}, error string")


def topk_classes(clips: DataFrame, weight: np.ndarray, bias: np.ndarray, classes: DataFrame, k: int = 5) -> DataFrame:
    """(<columns but the feature>, norm, rank, class_id, name, probability): the k likeliest classes of a linear head with softmax,
    and the feature's norm.

    ``weight`` (classes, dim) goes to each task; its size is that of the head. Ties go to the smaller class."""
    clips = clips.withColumn("norm", l2_norm("feature"))
    kept = [c for c in clips.columns if c != "feature"]
    schema = ", ".join(f"`{c}` {clips.schema[c].dataType.simpleString()}" for c in kept) + ", rank int, class_id int, probability double"
    head = clips.sparkSession.sparkContext.broadcast((np.asarray(weight, np.float64), np.asarray(bias, np.float64)))

    def run(batches):
        w, b = head.value
        n = min(k, len(b))
        for pdf in batches:
            if not len(pdf):
                continue
            logits = np.stack([np.asarray(v, np.float64) for v in pdf["feature"]]) @ w.T + b
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            order = np.lexsort((np.broadcast_to(np.arange(p.shape[1]), p.shape), -p), axis=1)[:, :n]
            out = pdf[kept].loc[pdf.index.repeat(n)].reset_index(drop=True)
            yield out.assign(rank=np.tile(np.arange(1, n + 1), len(pdf)), class_id=order.ravel(), probability=np.take_along_axis(p, order, axis=1).ravel())

    return clips.mapInPandas(run, schema).join(classes, "class_id", "left")
