import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import warc
from clipfeat.llm.shared import new_dir, read_file, write_file

from ..oracle import rows_of, sql_rows


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=5000), st.integers(1, 999))
def test_chunked_framing(data, size):
    assert warc.dechunked(warc.chunked(data, size)) == data


def test_segments_of_a_record():
    payload = bytes(range(256)) * 40
    parts = [p for r in warc.page_records("urn:x", 5, "http://a/", payload, None, False, 1000) for *p, error in warc.parse_records(r) if error is None]
    assert [h["warc-type"] for h, _ in parts] == ["response"] + ["continuation"] * (len(parts) - 1)
    block = b"".join(b for _, b in parts)
    assert int(parts[-1][0]["warc-segment-total-length"]) == len(block) and all(len(b) <= 1000 for _, b in parts)
    assert warc._payload(block)[0] == payload
    assert {h["warc-segment-origin-id"] for h, _ in parts[1:]} == {parts[0][0]["warc-record-id"]}


SCHEMA = "page_id long, url string, html string, sha string, keeper int, origin string"


def pages(spark, rows):
    return spark.createDataFrame([(i, "http://x/\r\n", t, "s", 1, "o") for i, t in rows], SCHEMA)


def through(spark, df, **how):
    return warc.reassembled(warc.read_archives(warc.write_archives(df, new_dir(spark, "warc"), **how)))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "é" * 9000), (4, "é" * 9000), (4, "é" * 9000), (5, "x"), (6, "x"), (None, "x"), (None, "alone"), (7, "a\r\n\r\n0\r\n\r\nb")]
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in through(spark, pages(spark, rows), segment=700, archive_bytes=3000).collect())
    most = {}
    for i, t in rows:
        most[t or ""] = max(most.get(t or "", -1), -1 if i is None else i)
    want = []
    for i, t in rows:
        raw, m = (t or "").encode(), most[t or ""]
        again = m >= 0 and i != m
        want.append((i or 0, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", m if again else None, None))
    assert got == sorted(want, key=lambda r: tuple(x if x is not None else -1 for x in r)) or sorted(got, key=repr) == sorted(want, key=repr)


def test_short_payloads_are_kept(spark):
    got = {r.page_id: r.record_type for r in through(spark, pages(spark, [(1, "abc"), (2, "abc"), (3, "a" * 50), (4, "a" * 50)]), min_bytes=10).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_no_pages(spark):
    assert through(spark, pages(spark, [])).count() == 0


@pytest.mark.parametrize("broken", ["lost", "twice", "length"])
def test_damage_is_told(spark, broken):
    records = warc.read_archives(warc.write_archives(pages(spark, [(1, "y" * 5000), (2, "z")]), new_dir(spark, "warc"), segment=1000))
    if broken == "lost":
        records = records.filter("segment <> 3")
    elif broken == "twice":
        records = records.union(records.filter("segment = 2"))
    else:
        records = records.selectExpr("origin", "segment", "type", "page", "refers_to", "digest", "total + 1 as total", "block")
    got = {r.page_id: r.error for r in warc.reassembled(records).collect()}
    assert got[1] and got[2] is None


def test_op5(spark, sf_dir):
    assert rows_of(warc.op5_warc(spark, sf_dir).toPandas()) == sql_rows(warc.SQL, sf_dir)


def test_damaged_archives(spark):
    """Every archive with one changed byte is read to its end; what was hit has an error, what was not is whole."""
    path = new_dir(spark, "warc")
    texts = {k: f"page {k} " * (20 if k % 3 else 400) for k in range(9)}
    (name,) = [r["path"] for r in warc.write_archives(pages(spark, list(texts.items())).coalesce(1), path, segment=900).filter("bytes > 0").collect()]
    data, names = read_file(name), []
    for at in range(0, len(data), max(1, len(data) // 150)):
        write_file(f"{path}/hit-{at}.warc.gz", data[:at] + bytes([data[at] ^ 0x5B]) + data[at + 1 :])
        names.append(f"{path}/hit-{at}.warc.gz")
    write_file(f"{path}/cut.warc.gz", data[: len(data) // 2])
    records = warc.read_archives(spark.createDataFrame([(n,) for n in [*names, f"{path}/cut.warc.gz"]], "path string").repartition(4))
    told, whole = {}, {}
    for n in names[:: len(names) // 12] + [f"{path}/cut.warc.gz"]:
        one = warc.read_archives(spark.createDataFrame([(n,)], "path string"))
        for r in warc.reassembled(one).collect():
            told[n] = told.get(n, 0) + (r["error"] is not None)
            if r["error"] is None:
                whole[n] = whole.get(n, 0) + 1
                assert r["payload"].decode() == texts[r["page_id"]]
    assert records.filter("error is not null").count() > 50
    assert told[f"{path}/cut.warc.gz"] and sum(v > 0 for v in told.values()) > 5 and min(whole.get(n, 0) for n in told if "cut" not in n) >= 5
