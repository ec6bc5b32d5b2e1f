"""Ledger snapshots: what a batch reads, and batches that are cut off anywhere."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from clipfeat.streaming import resume

BATCHES = [["a", "b", "c3"], ["c3", "d", "a"], ["e", "e", "c3"], ["b", "f"], ["c3", "g", "h"], ["a", "h", "i"], ["c3"]]


def work(df):
    """c3 fails at first and is ok from the third time on."""
    return df.select("video_id", F.when((F.col("video_id") == "c3") & (F.col("n") < 3), "failed").otherwise("ok").alias("status"))


def frames(spark):
    seen: dict = {}
    for rows in BATCHES:
        for v in set(rows):
            seen[v] = seen.get(v, 0) + 1
        yield spark.createDataFrame([(v, seen[v]) for v in rows], "video_id string, n int")


def result(spark, base):
    rows = spark.read.parquet(f"{base}/out").select("video_id", "status", "batch").collect()
    return sorted((r["video_id"], r["status"], int(r["batch"])) for r in rows)


WANT = sorted([
    ("a", "ok", 0), ("b", "ok", 0), ("c3", "failed", 0), ("c3", "failed", 1), ("d", "ok", 1), ("e", "ok", 2), ("c3", "ok", 2), ("f", "ok", 3), ("g", "ok", 4), ("h", "ok", 4), ("i", "ok", 5),
])


def test_snapshots_bound_what_is_read(spark, tmp_path):
    book = resume.Ledger(spark, str(tmp_path / "ledger"), 2)
    for n, df in enumerate(frames(spark)):
        assert len(book.folders_before(n)) <= 2
        resume.resume_batch(df, n, work, str(tmp_path / "out"), book.path, 2)
    assert result(spark, tmp_path) == WANT
    assert book.folders_before() == ["snapshot-000000005", "batch-000000006"]
    assert sorted(f for f in os.listdir(book.path) if not f.startswith(".")) == ["batch-000000004", "batch-000000005", "batch-000000006", "snapshot-000000003", "snapshot-000000005"]
    lines = {r["video_id"]: (r["status"], r["batch"]) for r in book.lines("string").collect()}
    assert lines == {v: ("ok", n) for v, s, n in WANT if s == "ok"}


class Cut(Exception):
    pass


@pytest.mark.parametrize("where", ["work", "before_record", "after_record", "in_snapshot", "before_removal"])
def test_a_batch_that_is_cut_off_runs_again(spark, tmp_path, monkeypatch, where):
    """Every batch is cut off at the same place once, and started again."""
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    armed = {"now": False}

    def cut(*_):
        if armed["now"]:
            armed["now"] = False
            raise Cut

    record, compact, remove = resume.Ledger.record, resume.Ledger.compact, resume.Ledger._remove

    def broken_record(self, lines, number):
        if where == "before_record":
            cut()
        record(self, lines, number)
        if where == "after_record":
            cut()

    def broken_compact(self, kind, number):
        if where == "in_snapshot" and (number + 1) % self.every == 0 and armed["now"]:
            self.spark.range(3).selectExpr("'x' as video_id", "'ok' as status", "0L as batch").write.mode("overwrite").parquet(f"{self.path}/snapshot-{number:09d}")
            os.remove(f"{self.path}/snapshot-{number:09d}/_SUCCESS")
            cut()
        compact(self, kind, number)

    monkeypatch.setattr(resume.Ledger, "record", broken_record)
    monkeypatch.setattr(resume.Ledger, "compact", broken_compact)
    monkeypatch.setattr(resume.Ledger, "_remove", lambda self, name: (where == "before_removal" and cut(), remove(self, name)))

    def broken_work(df):
        return df.select("video_id", F.raise_error(F.lit("cut")).cast("string").alias("status")) if where == "work" and armed["now"] else work(df)

    for n, df in enumerate(frames(spark)):
        armed["now"] = True
        for _ in range(3):
            try:
                resume.resume_batch(df, n, broken_work, out, ledger, 2)
                break
            except Exception:
                armed["now"] = False
    assert result(spark, tmp_path) == WANT
    assert {r["video_id"] for r in resume.Ledger(spark, ledger, 2).lines("string").filter("status = 'ok'").collect()} == {v for v, s, _ in WANT if s == "ok"}


def test_a_batch_of_any_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resume, "SMALL_BATCH", 0)
    for n, df in itertools.islice(enumerate(frames(spark)), 3):
        resume.resume_batch(df, n, work, str(tmp_path / "out"), str(tmp_path / "ledger"), 2)
    assert result(spark, tmp_path) == [x for x in WANT if x[2] < 3]
