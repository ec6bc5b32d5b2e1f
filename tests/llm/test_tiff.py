import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import tiff

from .edge import documents, empty


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=3000), st.text("ab", max_size=3000).map(str.encode)))
def test_codecs(data):
    assert tiff.packbits_decode(tiff.packbits_encode(data), len(data)) == data
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


def test_lzw_over_many_tables():
    data = np.random.default_rng(0).integers(0, 256, 60_000, dtype=np.uint8).tobytes() + b"abc" * 20_000
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


@pytest.mark.parametrize("n", [1, 63, 64, 65, 128, 1023, 1024, 1025, 2500])
def test_files(n):
    rng = np.random.default_rng(n)
    seen = set()
    for k in range(24):
        data = rng.integers(0, 4 if k % 2 else 256, n * 192, dtype=np.uint8).tobytes()
        pages = list(tiff.read_tiff(tiff.write_tiff(data)))
        assert b"".join(p.pixels for p in pages) == data and [p.index for p in pages] == list(range(-(-n // 1024)))
        seen.add((pages[0].compression, pages[0].predictor, pages[0].tiled))
    assert len(seen) >= 3


def hand_made(order, kind, planar, predictor, image):
    """A file in either byte order, of one strip per plane."""
    h, w, s = image.shape
    planes = [image[:, :, [k]] for k in range(s)] if planar == 2 else [image]
    out, offsets, counts = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0" * 4), [], []
    for p in planes:
        if predictor == 2:
            p = np.concatenate([p[:, :1], p[:, 1:] - p[:, :-1]], axis=1).astype(np.uint8)
        raw = {1: bytes, 5: tiff.lzw_encode, 8: zlib.compress, 32946: zlib.compress, 32773: tiff.packbits_encode}[kind](p.tobytes())
        offsets.append(len(out))
        counts.append(len(raw))
        out += raw
    fields = [(256, 3, [w]), (257, 3, [h]), (258, 3, [8] * s), (259, 3, [kind]), (273, 4, offsets), (277, 3, [s]), (278, 4, [h]), (279, 4, counts), (284, 3, [planar]), (317, 3, [predictor])]
    body = b""
    for tag, t, v in fields:
        raw = struct.pack(f"{order}{len(v)}{'H' if t == 3 else 'I'}", *v)
        if len(raw) > 4:
            at = len(out)
            out += raw
            raw = struct.pack(order + "I", at)
        body += struct.pack(order + "HHI", tag, t, len(v)) + raw.ljust(4, b"\0")
    struct.pack_into(order + "I", out, 4, len(out))
    return bytes(out + struct.pack(order + "H", len(fields)) + body + b"\0" * 4)


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("kind", [1, 5, 8, 32946, 32773])
@pytest.mark.parametrize(("planar", "predictor"), [(1, 1), (1, 2), (2, 1), (2, 2)])
def test_foreign_files(order, kind, planar, predictor):
    image = np.random.default_rng(5).integers(0, 256, (7, 11, 3), dtype=np.uint8)
    (page,) = tiff.read_tiff(hand_made(order, kind, planar, predictor, image))
    assert (page.width, page.height, page.samples) == (11, 7, 3) and page.pixels == image.tobytes()


def test_damaged_media(spark):
    good = tiff.write_tiff(b"x" * 192)
    loop = bytearray(good)
    struct.pack_into("<I", loop, len(loop) - 4, struct.unpack_from("<I", good, 4)[0])
    rows = spark.createDataFrame([(1, bytearray(good)), (2, None), (3, bytearray(b"no")), (4, bytearray(good[:40])), (5, bytearray()), (6, loop)], "page long, media binary")
    got = {}
    for r in tiff.tiff_pages(rows.withColumnRenamed("page", "id"), "media", ("id",)).collect():
        got.setdefault(r.id, []).append((r.page, r.error is None))
    assert got == {1: [(0, True)], 3: [(-1, False)], 4: [(-1, False)], 5: [(-1, False)], 6: [(0, True)]}


def expected(text):
    raw = (text or "").encode()
    data = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
    return len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:])


def digests(docs):
    keep = ("doc_id", "n_bytes")
    stored = tiff.texts_as_tiff(docs)
    return tiff.image_features(tiff.tiff_pages(stored, "media", keep), keep)


@pytest.mark.parametrize("make", [documents, empty])
def test_edge_cases(spark, make):
    docs = make(spark)
    got = sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in digests(docs).collect())
    assert got == sorted(expected(r.text) for r in docs.collect())


def test_op3(spark, sf_dir):
    got = {r.doc_id: r for r in tiff.op3_tiff(spark, sf_dir).collect()}
    same = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        x = got[r.doc_id]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == expected(r.text)
        data = (r.text or "").encode()
        media = tiff.write_tiff(data.ljust(max(1, -(-len(data) // 192)) * 192))
        assert (x.media_bytes, x.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        assert same.setdefault(r.text, x.feature) == x.feature


def test_damaged_images(spark):
    """Images with a changed byte give pages or an error, never a failed job."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6):
        data = tiff.write_tiff((b"some text %d " % k * 200)[: 192 * 10])
        rows += [(k, bytearray(data))] + [(k, data[:a] + bytes([b]) + data[a + 1 :]) for a, b in zip(rng.integers(0, len(data), 300).tolist(), rng.integers(0, 256, 300).tolist(), strict=True)]
    df = spark.createDataFrame([(k, bytes(d)) for k, d in rows], "doc_id long, media binary")
    pages = tiff.tiff_pages(df, "media", ("doc_id",))
    assert pages.filter("error is not null").count() > 20 and pages.filter("error is null").count() > 600
    assert tiff.image_features(pages, ("doc_id",)).count() >= len(rows)


@pytest.mark.parametrize("width,height,pixels", [(5, 7, 35), (1, 1, 1)])
def test_features_of_gray_images(spark, width, height, pixels):
    rows = spark.createDataFrame([(1, 0, height, bytes(range(pixels)))], "doc_id long, page int, height int, pixels binary")
    assert tiff.image_features(rows, ("doc_id",)).first()["payload_bytes"] == pixels


def test_codecs_are_dealt_evenly():
    kinds = [k for k, _, _ in tiff.LAYOUTS]
    assert len({kinds.count(k) for k in kinds}) == 1 and len(set(kinds)) == 3
