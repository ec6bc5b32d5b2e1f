"""Media columns: TIFF images held in a binary column, one row per page.

``read_tiff`` walks the image directories, decodes PackBits, LZW or deflate strips and tiles, and undoes the
horizontal predictor. ``write_tiff`` stores bytes losslessly as 8-bit samples: pages of RGB rows of 64 pixels,
in one of six layouts that a checksum of the bytes picks, so equal bytes give equal files.

Cases: a null medium gives no page; one that can't be read gives one row with its error and no pixels; a null
or empty text is stored as one row of spaces; repeated rows give repeated pages; extra columns are ignored
unless asked for.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import frame_of, map_frames, table

#: Fixed values of the format: tags, compressions, sizes of field types.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PAGE_NUMBER, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 284, 297, 317, 322, 323, 324, 325
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
FIELD_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}

#: (compression, predictor, tiled) by checksum: each codec gets as many payloads, in strips and in tiles.
LAYOUTS = [(LZW, 1, False), (LZW, 2, True), (DEFLATE, 1, False), (DEFLATE, 2, True), (PACKBITS, 1, False), (PACKBITS, 2, True)]
#: No codec here makes more than this many bytes of one.
MOST_RATIO = 4096

ROW_BYTES, PAGE_ROWS, STRIP_ROWS, TILE = 192, 1024, 128, 64


@dataclass
class Page:
    index: int
    width: int
    height: int
    samples: int
    compression: int
    predictor: int
    tiled: bool
    pixels: bytes


# ---------------------------------------------------------------- codecs


def packbits_encode(data: bytes) -> bytes:
    """Runs of three bytes or more as a run, all else as it is."""
    a = np.frombuffer(data, np.uint8)
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    lens = np.diff(np.append(starts, len(a)))
    out, at = bytearray(), 0

    def plain(end: int) -> None:
        nonlocal at
        while at < end:
            n = min(128, end - at)
            out.append(n - 1)
            out.extend(data[at : at + n])
            at += n

    long = lens >= 3
    for s, n in zip(starts[long].tolist(), lens[long].tolist(), strict=True):
        plain(s)
        while n:
            k = min(128, n)
            if k == 1:
                out += bytes((0, data[at]))
            else:
                out += bytes((257 - k, data[at]))
            at += k
            n -= k
    plain(len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while len(out) < size and at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code early."""
    # the book has the code of what a code and a byte make together
    book, width, next_code = {}, 9, 258
    codes, widths = [256], [9]
    known, part = book.get, data[0] if data else None
    for byte in data[1:]:
        more = part << 8 | byte
        if (code := known(more)) is not None:
            part = code
            continue
        codes.append(part)
        widths.append(width)
        book[more] = next_code
        next_code += 1
        if next_code == 4094:
            codes.append(256)
            widths.append(12)
            book.clear()
            width, next_code = 9, 258
        elif next_code > (1 << width) - 1 and width < 12:
            width += 1
        part = byte
    if data:
        codes.append(part)
        widths.append(width)
        if next_code + 1 > (1 << width) - 1 and width < 12:
            width += 1
    codes.append(257)
    widths.append(width)
    c, w = np.array(codes, np.int64), np.array(widths, np.int64)
    bit = np.arange(12)
    bits = (c[:, None] >> (w[:, None] - 1 - bit).clip(0)) & 1
    return np.packbits(bits[bit < w[:, None]].astype(np.uint8)).tobytes()


def lzw_decode(data: bytes, size: int) -> bytes:
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    book, width, out, n = list(first), 9, [], 0
    last, held, bits = b"", 0, 0
    for byte in data:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257 or n >= size:
            break
        if code == 256:
            book, width, last = list(first), 9, b""
            continue
        if code < len(book):
            now = book[code]
        elif code == len(book) and last:
            now = last + last[:1]
        else:
            raise ValueError("bad LZW code")
        if last:
            book.append(last + now[:1])
            if len(book) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(now)
        n += len(now)
        last = now
    return b"".join(out)


def _decode(kind: int, data: bytes, size: int) -> bytes:
    if kind == NONE:
        return data
    if kind in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, size)
    if kind == PACKBITS:
        return packbits_decode(data, size)
    if kind == LZW:
        return lzw_decode(data, size)
    raise ValueError(f"compression {kind} is not supported")


def _differences(block: np.ndarray) -> np.ndarray:
    out = block.copy()
    out[:, 1:] -= block[:, :-1]
    return out


# ---------------------------------------------------------------- files


def write_tiff(payload: bytes) -> bytes:
    """``payload``, whose length must be a positive multiple of 192, as a TIFF of RGB pages."""
    if not payload or len(payload) % ROW_BYTES:
        raise ValueError("the payload must be a positive multiple of 192 bytes")
    layout = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
    kind, predictor, tiled = layout
    encode = {DEFLATE: lambda b: zlib.compress(b, 4), PACKBITS: packbits_encode, LZW: lzw_encode}[kind]
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW_BYTES // 3, 3)
    out = bytearray(b"II*\0\0\0\0\0")
    link, n_pages = 4, -(-len(rows) // PAGE_ROWS)
    for page in range(n_pages):
        pixels = rows[page * PAGE_ROWS : (page + 1) * PAGE_ROWS]
        step = TILE if tiled else STRIP_ROWS
        blocks = []
        for top in range(0, len(pixels), step):
            block = pixels[top : top + step]
            if tiled and len(block) < TILE:
                block = np.concatenate([block, np.zeros((TILE - len(block), *block.shape[1:]), np.uint8)])
            blocks.append(encode((_differences(block) if predictor == 2 else block).tobytes()))
        offsets = []
        for b in blocks:
            offsets.append(len(out))
            out += b + b"\0" * (len(b) % 2)
        counts = [len(b) for b in blocks]
        shape = [(TILE_WIDTH, 4, [TILE]), (TILE_LENGTH, 4, [TILE]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if tiled else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [STRIP_ROWS]), (STRIP_COUNTS, 4, counts)]
        fields = sorted([(WIDTH, 4, [ROW_BYTES // 3]), (LENGTH, 4, [len(pixels)]), (BITS, 3, [8, 8, 8]), (COMPRESSION, 3, [kind]), (PHOTOMETRIC, 3, [2]), (SAMPLES, 3, [3]), (PLANAR, 3, [1]), (PAGE_NUMBER, 3, [page % 65536, n_pages % 65536]), (PREDICTOR, 3, [predictor]), *shape])
        entries = []
        for tag, field, values in fields:
            raw = struct.pack(f"<{len(values)}{'H' if field == 3 else 'I'}", *values)
            if len(raw) > 4:
                at = len(out)
                out += raw + b"\0" * (len(raw) % 2)
                raw = struct.pack("<I", at)
            entries.append(struct.pack("<HHI", tag, field, len(values)) + raw.ljust(4, b"\0"))
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, order: str, at: int) -> tuple[dict[int, list[int]], int]:
    (n,) = struct.unpack_from(order + "H", data, at)
    found = {}
    for k in range(n):
        tag, field, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        place = at + 10 + 12 * k
        if field not in (1, 3, 4):
            continue
        if FIELD_SIZES[field] * count > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        found[tag] = list(struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[field] }", data, place))
    (following,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    return found, following


def _pixels(data: bytes, tags: dict[int, list[int]]) -> Page:
    one = lambda tag, default: tags.get(tag, [default])[0]
    width, height, samples, kind, predictor = one(WIDTH, 0), one(LENGTH, 0), one(SAMPLES, 1), one(COMPRESSION, 1), one(PREDICTOR, 1)
    if set(tags.get(BITS, [1])) != {8}:
        raise ValueError("only 8-bit samples are supported")
    if predictor not in (1, 2):
        raise ValueError(f"predictor {predictor} is not supported")
    if min(width, height, samples) < 1:
        raise ValueError("an image without pixels")
    if width * height * samples > MOST_RATIO * len(data):
        raise ValueError("an image larger than its file can hold")
    planes = samples if one(PLANAR, 1) == 2 else 1
    per = samples // planes
    tiled = TILE_OFFSETS in tags
    bw, bh = (one(TILE_WIDTH, width), one(TILE_LENGTH, height)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
    if min(bw, bh) < 1 or bw * bh * per > MOST_RATIO * len(data):
        raise ValueError("strips or tiles without a proper size")
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    across, down = -(-width // bw), -(-height // bh)
    if across * down * planes > min(len(offsets), len(counts)):
        raise ValueError("strips or tiles are missing")
    image = np.zeros((height, width, samples), np.uint8)
    for k in range(across * down * planes):
        plane, rest = divmod(k, across * down)
        row, col = divmod(rest, across)
        rows = bh if tiled else min(bh, height - row * bh)
        raw = _decode(kind, data[offsets[k] : offsets[k] + counts[k]], rows * bw * per)
        block = np.frombuffer(raw, np.uint8, rows * bw * per).reshape(rows, bw, per)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        part = block[: height - row * bh, : width - col * bw]
        image[row * bh : row * bh + part.shape[0], col * bw : col * bw + part.shape[1], plane * per : (plane + 1) * per] = part
    return Page(0, width, height, samples, kind, predictor, tiled, image.tobytes())


def read_tiff(data: bytes) -> Iterator[Page]:
    """The pages of a file, in the order of its directories."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen: set[int] = set()
    while at and at not in seen:
        seen.add(at)
        tags, following = _directory(data, order, at)
        page = _pixels(data, tags)
        page.index = len(seen) - 1
        yield page
        at = following


# ---------------------------------------------------------------- Spark


def tiff_pages(df: DataFrame, media: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page of the images in column ``media``: the columns ``keep``, then what the page holds.

    The pages of an image come one after another in one task; rows are sent on in batches of some MB."""
    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep) + "page int, width int, height int, samples int, compression int, predictor int, tiled boolean, pixels binary, error string"
    names = [*keep, "page", "width", "height", "samples", "compression", "predictor", "tiled", "pixels", "error"]

    def run(batches):
        for pdf in batches:
            rows, size = [], 0
            for *kept, data in zip(*(pdf[c] for c in keep), pdf["_media"], strict=True):
                if data is None:
                    continue
                try:
                    for p in read_tiff(bytes(data)):
                        rows.append((*kept, p.index, p.width, p.height, p.samples, p.compression, p.predictor, p.tiled, p.pixels, None))
                        size += len(p.pixels)
                        if size > 2_000_000:
                            yield frame_of(rows, names)
                            rows, size = [], 0
                except (ValueError, KeyError, IndexError, OverflowError, struct.error, zlib.error) as e:
                    rows.append((*kept, -1, 0, 0, 0, 0, 0, False, None, f"{type(e).__name__}: {e}"))
            if rows:
                yield frame_of(rows, names)

    return map_frames(df.select(*keep, F.col(media).alias("_media")), run, schema)


def texts_as_tiff(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text in UTF-8, filled up with spaces to a positive multiple of 192 bytes."""

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 200):
                part = pdf.iloc[at : at + 200]
                raw = [(t or "").encode() for t in part["text"]]
                media = [write_tiff(b.ljust(max(1, -(-len(b) // ROW_BYTES)) * ROW_BYTES, b" ")) for b in raw]
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_bytes": [len(b) for b in raw], "media": media})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, media binary")


def image_features(pages: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """One row per image from its pages, which must come one after another: checksums and features of all its pixels.

    Runs in the tasks that made the pages, so nothing moves; it holds counts only, never an image."""
    names = [*keep, "payload_bytes", "payload_sha256", "tail_crc32", "feature"]
    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep) + "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"

    def run(batches):
        held = None

        def finished():
            kept, size, sha, tail, bins, sums, shape = held
            bins = bins.tolist()
            mean = " ".join(f"{s / max(1, size // 3):.3f}" for s in sums)
            return (*kept, size, sha.hexdigest(), zlib.crc32(tail), f"pages {shape[0]} rows {shape[1]} mean {mean} bins {' '.join(map(str, bins))}")

        for pdf in batches:
            rows = []
            for r in pdf[[*keep, "page", "height", "pixels"]].itertuples(index=False, name=None):
                *kept, page, height, pixels = r
                if page <= 0:
                    if held:
                        rows.append(finished())
                    held = [kept, 0, hashlib.sha256(), b"", np.zeros(8, np.int64), np.zeros(3, np.int64), [0, 0]]
                if pixels is None:
                    continue
                a = np.frombuffer(pixels, np.uint8)
                held[1] += len(pixels)
                held[2].update(pixels)
                held[3] = (held[3] + bytes(pixels[-16:]))[-16:]
                held[4] += np.bincount(a >> 5, minlength=8)
                held[5] += [a[c::3].sum(dtype=np.int64) for c in range(3)]
                held[6] = [held[6][0] + 1, held[6][1] + height]
            if rows:
                yield frame_of(rows, names)
        if held:
            yield frame_of([finished()], names)

    return map_frames(pages, run, schema)


def op3_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to TIFF, TIFF to pages, pages to checksums and features, in one stage without a shuffle."""
    stored = texts_as_tiff(table(spark, sf_dir, "documents"))
    stored = stored.select("doc_id", "n_bytes", "media", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    keep = ("doc_id", "n_bytes", "media_bytes", "media_sha256")
    return image_features(tiff_pages(stored, "media", keep), keep).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
