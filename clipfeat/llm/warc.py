"""WARC archives: writing records in segments, and putting the segments together again.

A reader takes archives apart into records; continuation records go to the record that their
WARC-Segment-Origin-ID names, in the order of their segment numbers; the joined block must have the length that
the last segment states; then the HTTP framing (chunked or not) is undone.

Cases: a null payload is empty; equal payloads of at least ``min_bytes`` bytes are stored once, by the row of the
largest page_id, and the others become revisits; of rows equal in page_id and payload each is a response; null
page_ids are never the largest unless all are null; an incomplete or damaged record gives a row with its error;
an empty table gives no archives; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import frame_of, map_frames, new_dir, read_file, staged, table, write_file

CRLF = b"\r\n"
#: How a gzip member begins.
MEMBER = b"\x1f\x8b\x08"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = 2048) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        chunk = body[end + 2 : end + 2 + n]
        if len(chunk) != n or body[end + 2 + n : end + 4 + n] != CRLF:
            raise ValueError("a chunk is cut short")
        out.append(chunk)
        at = end + 4 + n


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, compressed as a gzip member of its own."""
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + CRLF * 2, 3, mtime=0)


def page_records(name: str, page_id, url: str, payload: bytes, refers_to, is_revisit: bool, segment: int) -> list[bytes]:
    """The records of one page: a response, cut into segments of at most ``segment`` bytes, or a revisit."""
    sha, uri = digest_of(payload), (url or "").replace("\r", "").replace("\n", "")
    common = [("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("WARC-Page-ID", "" if page_id is None else str(page_id)), ("WARC-Payload-Digest", f"sha1:{sha}")]
    if is_revisit:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        more = [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}:{sha}>")]
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common, *more], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = range(0, len(block), segment)
    if len(cuts) == 1:
        return [record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common], block)]
    out = [record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, ("WARC-Segment-Number", "1")], block[:segment])]
    for k, at in enumerate(cuts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(cuts) else []
        heads = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}/{k}>"), *common[:2], ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", str(k)), *last]
        out.append(record(heads, block[at : at + segment]))
    return out


def parse_records(data: bytes, step: int = 8192):
    """(headers with lower-case names, block, error) of each record of an archive of gzip members.

    A member is fed to its decompressor in small steps, so what it leaves over is at most a step, not the rest of the archive.
    A damaged one gives a record without headers, and reading goes on at the next place that looks like the start of a member."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts, began = zlib.decompressobj(31), [], at
        try:
            while not member.eof and at < len(view):
                parts.append(member.decompress(view[at : at + step]))
                at += min(step, len(view) - at) - len(member.unused_data)
            if not member.eof:
                raise ValueError("the archive is cut short")
            head, _, rest = b"".join(parts).partition(CRLF * 2)
            headers = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
            length = int(headers.get("content-length", 0))
            if length > len(rest):
                raise ValueError("the record is cut short")
            yield headers, rest[:length], None
        except (ValueError, zlib.error) as e:
            yield {}, b"", f"{type(e).__name__}: {e}"
            at = data.find(MEMBER, began + 1)
            at = len(view) if at < 0 else at


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, segment: int = 4096, archive_bytes: int = 8_000_000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives of some MB below ``path``; returns their names.

    Which page keeps a payload is settled on (digest, page_id) alone, summed before the shuffle; then the pages meet
    that small table by digest, a join that Spark splits where one payload is common. Each task writes its own
    archives under new names and only finished ones are listed, so a task that runs again does no harm."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    keep = rows.groupBy("sha").agg(F.max("page_id").alias("keeper"))
    rows = rows.join(keep, "sha").withColumn("revisit", (F.octet_length("html") >= min_bytes) & F.coalesce(F.col("page_id") < F.col("keeper"), F.col("keeper").isNotNull()))

    def run(batches):
        import uuid

        task, n, held, size = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", 0, [], 0
        for pdf in batches:
            for page_id, url, html, keeper, revisit in pdf[["page_id", "url", "html", "keeper", "revisit"]].itertuples(index=False, name=None):
                page_id, keeper = (None if x is None or x is pd.NA else int(x) for x in (page_id, keeper))
                for r in page_records(f"urn:page:{page_id}:{task}:{n}", page_id, url, html.encode(), keeper, revisit, segment):
                    held.append(r)
                    size += len(r)
                n += 1
                if size >= archive_bytes:
                    write_file(name := f"{path}/{task}-{n}.warc.gz", b"".join(held))
                    yield pd.DataFrame({"path": [name], "bytes": [size]})
                    held, size = [], 0
        if held:
            write_file(name := f"{path}/{task}-{n}.warc.gz", b"".join(held))
            yield pd.DataFrame({"path": [name], "bytes": [size]})

    return staged(map_frames(rows, run, "path string, bytes long"), "archives")


def read_archives(paths: DataFrame) -> DataFrame:
    """(origin, segment, type, page, refers_to, digest, total, block, error): one row per record of the archives in ``paths``.path."""

    def fields(h):
        total, page = h.get("warc-segment-total-length"), h.get("warc-page-id")
        refers = h.get("warc-refers-to", "").strip("<>").split(":")
        refers = refers[2] if len(refers) > 2 and refers[2] != "None" else None
        return int(h.get("warc-segment-number", 1)), h.get("warc-type"), str(int(page)) if page else None, refers and str(int(refers)), h.get("warc-payload-digest"), int(total) if total else None

    def run(batches):
        names = ["origin", "segment", "type", "page", "refers_to", "digest", "total", "block", "error"]
        for pdf in batches:
            for path in pdf["path"]:
                out, size = [], 0
                for k, (h, block, error) in enumerate(parse_records(read_file(path))):
                    # a record that can't name itself is one of its own
                    origin = h.get("warc-segment-origin-id") or h.get("warc-record-id") or f"{path}#{k}"
                    try:
                        found = fields(h)
                    except ValueError as e:
                        found, error = (1, None, None, None, None, None), error or f"a damaged header: {e}"
                    out.append((origin, *found, block, error))
                    size += len(block)
                    if size > 4_000_000:
                        yield frame_of(out, names)
                        out, size = [], 0
                if out:
                    yield frame_of(out, names)

    spread = paths.repartition(max(1, paths.sparkSession.sparkContext.defaultParallelism), "path")
    return map_frames(spread, run, "origin string, segment int, type string, page string, refers_to string, digest string, total long, block binary, error string")


def _payload(block: bytes) -> tuple[bytes, int]:
    """The payload of an HTTP message without its framing, and its stated length."""
    head, _, body = block.partition(CRLF * 2)
    heads = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:]))
    if heads.get("transfer-encoding", "").lower() == "chunked":
        body = dechunked(body)
    return body, int(heads.get("content-length", len(body)))


def reassembled(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload, error): one row per record with its segments.

    The segments meet by origin and are sorted by number on disk where they must; a task holds one record at a time."""

    def run(batches):
        held: dict = {}

        def finished():
            error, payload, size = None, None, None
            try:
                if held["error"]:
                    raise ValueError(held["error"])
                numbers, blocks, total = held["numbers"], held["blocks"], held["total"]
                if "type" not in held:
                    raise ValueError("the first segment is missing")
                if numbers != list(range(1, len(numbers) + 1)):
                    raise ValueError("segments are missing or repeated")
                block = b"".join(blocks)
                if len(numbers) > 1 and total != len(block):
                    raise ValueError("the total length differs")
                payload, size = _payload(block)
                if held["type"] == "response" and held["digest"] != f"sha1:{digest_of(payload)}":
                    raise ValueError("the digest differs")
            except (ValueError, KeyError) as e:
                error = str(e)
            page, refers = held.get("page"), held.get("refers_to")
            digest = (held.get("digest") or "").rpartition(":")[2] or None
            return (int(page) if page else None, size, digest, held.get("type"), int(refers) if refers else None, payload if held.get("type") == "response" else None, error)

        names_in = ["origin", "segment", "type", "page", "refers_to", "digest", "total", "block", "error"]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "error"]

        def frame(rows):
            return frame_of(rows, names)

        for pdf in batches:
            out, size = [], 0
            for origin, segment, kind, page, refers, digest, total, block, error in pdf[names_in].itertuples(index=False, name=None):
                if held and held["origin"] != origin:
                    out.append(finished())
                    held = {}
                held = held or {"origin": origin, "numbers": [], "blocks": [], "total": None, "error": None}
                held["error"] = held["error"] or error
                if kind != "continuation":
                    held.update(type=kind, page=page, refers_to=refers, digest=digest)
                held["numbers"].append(segment)
                held["blocks"].append(bytes(block))
                if total is not None and total is not pd.NA:
                    held["total"] = int(total)
                size += len(block)
                if size > 4_000_000 and out:
                    yield frame(out)
                    out, size = [], 0
            if out:
                yield frame(out)
        if held:
            yield frame([finished()])

    records = records if "error" in records.columns else records.withColumn("error", F.lit(None).cast("string"))
    ordered = records.repartition("origin").sortWithinPartitions("origin", "segment")
    return map_frames(ordered, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, error string")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to archives in the shared folder, archives to records, segments to payloads."""
    archives = write_archives(table(spark, sf_dir, "pages"), new_dir(spark, "warc"))
    return reassembled(read_archives(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT sha, max(page_id) AS keeper FROM p GROUP BY sha)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(sha, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p JOIN k USING (sha)
"""
