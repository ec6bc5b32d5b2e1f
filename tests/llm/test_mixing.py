import pytest
from pyspark.sql import functions as F

from clipfeat.llm import mixing

from ..oracle import rows_of, sql_rows
from .edge import documents, empty


def shares(sizes):
    """Targets by filling up: what a capped source leaves goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        capped |= set(over)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 3, "d": 900, None: 40}, {"x": 5}, {"a": 0, "b": 7}, {"a": 2, "b": 2, "c": 2, "d": 1000, "e": 1}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = shares(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("make", [documents, empty])
def test_edge_cases(spark, make):
    docs = make(spark)
    sizes = mixing.sized(docs)
    rows = mixing.mix(sizes, mixing.targets(sizes)).collect()
    words = lambda t: len((t or "").encode().split())
    assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted((r.doc_id or -1, words(r.text)) for r in docs.collect())
    per = {}
    for r in rows:
        per.setdefault(r.source, [r.target, 0])[1] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(a - b) <= 0.5 + 1e-9 for a, b in per.values())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() >= 0


def test_ranges_change_nothing(spark, sf_dir, monkeypatch):
    sizes = mixing.sized(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    run = lambda: sorted((r.doc_id, r.taken) for r in mixing.mix(sizes, mixing.targets(sizes)).collect())
    whole = run()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert run() == whole


def test_mixed_documents_come_once_an_epoch(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = mixing.sized(docs)
    plan = {r.doc_id: r for r in mixing.mix(sizes, mixing.targets(sizes)).collect()}
    copies = {r.doc_id: r.n for r in mixing.mixed_documents(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i, r in plan.items():
        assert abs(copies.get(i, 0) * r.size - r.taken) <= r.size / 2
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in mixing.mixed_documents(docs).collect())


def test_op6(spark, sf_dir):
    assert rows_of(mixing.op6_mixing(spark, sf_dir).toPandas()) == sql_rows(mixing.SQL, sf_dir)
