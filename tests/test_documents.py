import json
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipfeat.sources import documents, text

TEXTS = st.text(st.sampled_from('ab"\\{}[],: \né😀'), max_size=12)


def level(data, size):
    """Depth and string state before each range of a text, from the sums of its ranges."""
    a = np.frombuffer(data, np.uint8)
    in_string, depth, out = 0, 0, []
    for at in range(0, len(a), size):
        before = len(data[:at]) - len(data[:at].rstrip(b"\\"))
        odd, outside, inside = documents.changes(a[at : at + size], before)
        out.append((bool(in_string), depth))
        depth += inside if in_string else outside
        in_string ^= odd
    return out, in_string, depth


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.one_of(st.none(), st.integers(), TEXTS), lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(TEXTS, x, max_size=3)), max_leaves=12), st.integers(1, 9), st.booleans())
def test_ranges_know_where_they_begin(value, size, ascii):
    data = json.dumps({"database": value, "x": "\\"}, ensure_ascii=ascii).encode()
    found, in_string, depth = level(data, size)
    assert (in_string, depth) == (0, 0)
    inside, deep, escaped, want = False, 0, False, []
    for k, b in enumerate(data):
        if k % size == 0:
            want.append((inside, deep))
        if escaped:
            escaped = False
        elif inside and b == 92:
            escaped = True
        elif b == 34:
            inside = not inside
        elif not inside:
            deep += {123: 1, 91: 1, 125: -1, 93: -1}.get(b, 0)
    assert found == want


def entries(spark, path, size):
    return sorted((r["key"], json.loads(r["entry"], strict=False)) for r in documents.document_entries(spark, str(path), range_bytes=size).collect())


DOCS = {
    "plain": {"database": {"a": {"video_id": "v", "duration": 1.5}, "b": {"sentence": 'a "quoted" \\ {brace, [x]}'}}},
    "others": {"version": "1", "taxonomy": {"database": {"no": 1}, "z": [1, {"q": 2}]}, "list": [{"database": {"no": 2}}], "database": {"k,{": {"x": [1, [2, {"y": {}}]]}, "é😀\n": None, "n": 5, "s": "text", "": []}, "after": {"w": "}"}},
    "empty": {"database": {}, "x": 1},
    "none": {"x": {"a": 1}},
    "no_object": {"database": [1, 2]},
}


@pytest.mark.parametrize("name", sorted(DOCS))
@pytest.mark.parametrize("size,indent", [(5, None), (33, 2), (1 << 20, None)])
def test_entries_of_small_documents(spark, tmp_path, name, size, indent):
    path = tmp_path / "d.json"
    path.write_text(json.dumps(DOCS[name], ensure_ascii=False, indent=indent))
    want = DOCS[name].get("database")
    assert entries(spark, path, size) == sorted(want.items()) if isinstance(want, dict) else entries(spark, path, size) == []


def test_cut_off_document(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"database": {"a": {"x": 1}, "b": {"x"')
    assert entries(spark, path, 8) == []
    (tmp_path / "none.json").write_text("")
    assert entries(spark, tmp_path / "none.json", 8) == []


def test_a_document_by_many_tasks(spark, tmp_path):
    """Some 25 MB, written at its places by many tasks and read by ranges: as one pass over the whole text gives it."""
    path = str(tmp_path / "out/doc.json")
    rows = spark.range(40_000).select(F.concat(F.lit('v"'), F.col("id").cast("string")).alias("video_id"), F.repeat(F.concat(F.lit('a \\ "b" {, '), F.col("id").cast("string")), 35).alias("sentence"), (F.col("id") / 7).alias("duration"))
    size = documents.write_document(rows, "video_id", F.struct("duration", "sentence"), path, {"version": "1"})
    assert os.path.getsize(path) == size > 20_000_000 and os.listdir(tmp_path / "out") != []
    with open(path) as f:
        whole = json.load(f)
    assert list(whole["database"]) == sorted(whole["database"]) and len(whole["database"]) == 40_000 and whole["version"] == "1"
    got = documents.document_entries(spark, path, range_bytes=1 << 20)
    parsed = got.select("key", F.from_json("entry", "duration double, sentence string").alias("v")).select("key", "v.*")
    want = rows.select("video_id", "duration", "sentence")
    assert parsed.count() == 40_000 and parsed.exceptAll(want).isEmpty()
    assert {r["path"] for r in got.select("path").distinct().collect()} == {path}


def test_same_bytes_as_the_document_in_one_row(spark, tmp_path):
    kind = "video_id string, subset string, duration double, annotations array<struct<segment:array<double>,label:string,sentence:string,label_id:int>>"
    rows = spark.createDataFrame([("b", "training", 2.0, [([0.0, 1.0], "x", "é \"q\"", 0)]), ("a", None, None, []), ("_c", "validation", 1.0, [([0.5, 1.0], None, "", 1)])], kind)
    for df in (rows, rows.limit(0)):
        path = str(tmp_path / "doc.json")
        documents.write_document(df, "video_id", F.struct("subset", "duration", "annotations"), path, {"version": "1", "label_mode": "recipe"})
        assert open(path).read() == text.annotation_document(df, "1", "recipe").first()["value"]
    documents.write_document(rows, "video_id", F.struct("subset", "duration", "annotations"), path)
    again = documents.annotations_of(documents.document_entries(spark, path, range_bytes=11))
    assert again.select(*rows.columns).exceptAll(rows).isEmpty() and again.count() == 3


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text("before")
    rows = spark.range(10).select(F.col("id"), F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="no"):
        documents.write_document(rows, "id", F.struct("x"), str(path))
    assert path.read_text() == "before" and not [f for f in os.listdir(tmp_path) if f.endswith(".part")]


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_what_a_document_is_made_of_is_small(spark, tmp_path, monkeypatch):
    """beside a document lay its rows twice, with a random text each, and a second shuffle of them; now sorted pieces alone."""
    beside, replace = [], os.replace

    def measured(a, b):
        beside.append(folder_bytes(f"{a}-rows"))
        replace(a, b)

    monkeypatch.setattr(os, "replace", measured)
    rows = spark.range(100_000, numPartitions=8).select(F.concat(F.lit("v_"), F.col("id") * 7919 % 100_003).alias("video_id"), (F.col("id") * 0.37).alias("duration"), F.lit("a line of text").alias("sentence"))
    size = documents.write_document(rows, "video_id", F.struct("duration", "sentence"), str(tmp_path / "d.json"))
    assert size > 5e6 and len(beside) == 1 and beside[0] < size / 4
    assert os.listdir(tmp_path) == ["d.json"]
    keys = list(json.loads((tmp_path / "d.json").read_text())["database"])
    assert len(keys) == 100_000 and keys == sorted(keys)


@pytest.mark.parametrize("n", [0, 1, 25_000])
def test_pieces_of_several_files_and_repeated_keys(spark, tmp_path, n):
    """a range of keys may be several files."""
    rows = spark.range(n).select((F.col("id") % 5000).cast("string").alias("key"), F.concat(F.lit("é😀,"), F.col("id")).alias("x"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "700")
    try:
        size = documents.write_document(rows, "key", F.struct("x"), str(tmp_path / "d 1%41.json"), {"version": "é"})
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    raw = (tmp_path / "d 1%41.json").read_bytes()
    pairs = json.loads(raw, object_pairs_hook=list)
    assert len(raw) == size and pairs[0] == ("version", "é")
    assert [k for k, _ in pairs[1][1]] == sorted(str(k % 5000) for k in range(n))
    assert sorted(v[0][1] for _, v in pairs[1][1]) == sorted(f"é😀,{k}" for k in range(n))


def test_documents_go_when_their_ids_are_written(spark, sf_dir):
    """the documents of both subsets stayed."""
    from clipfeat.queries.annotation import ids_from_document

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    documents_there = lambda: {os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".json")}
    before = documents_there()
    assert ids_from_document(spark, sf_dir).count() > 0
    assert documents_there() <= before
