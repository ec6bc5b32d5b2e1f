import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p

from .edge import documents, empty


def test_stages(spark, sf_dir):
    """Each stage against what it must do to what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in p.STAGES[:-1]:
        docs = p.staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    every = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert set(kept["near_duplicates"]) <= set(kept["toxicity"]) <= set(every)
    first = {}
    for i in sorted(kept["toxicity"]):
        first.setdefault(every[i], i)
    assert set(kept["near_duplicates"]) <= set(first.values()) and len(kept["near_duplicates"]) > 0.9 * len(first)
    assert len(kept["decontamination"]) == len(set(kept["decontamination"])) and set(kept["mixing"]) <= set(kept["decontamination"])
    out = p.STAGES[-1][1](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in out.collect()) == sorted(kept["mixing"])


@pytest.mark.parametrize("make", [documents, empty])
def test_stages_stand_odd_tables(spark, sf_dir, make, tmp_path):
    docs = make(spark).select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("score"), F.lit(2).alias("_text_key"))
    for name, stage in p.STAGES[:-1]:
        docs = p.staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "_text_key"]
    assert p.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
