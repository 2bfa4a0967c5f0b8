from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from seatlens.llm import neighbours, pii, rules
from tests.llm import helpers as H

SF = "/root/testdata/sf0.01"


def _ids(df) -> list[int]:
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_equal_their_operators(spark):
    """Each stage's decisions, taken from the operators' own verdicts and from brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "quality_rules", "near_duplicates", "personal_data", "packing"]

    first = stages["quality_classifier"](spark, docs, SF)
    scored = neighbours.classify(docs, marks, learn=~neighbours.held_out("doc_id", 4, 2))
    assert _ids(first) == _ids(scored.where("predicted = 1"))

    second = stages["quality_rules"](spark, first, SF)
    assert _ids(second) == _ids(rules.judge(first, marks).where("kept"))

    third = stages["near_duplicates"](spark, second, SF)
    rows = sorted((r.doc_id, r.text) for r in second.collect())
    sets = [H.shingle_set(t, 5) for _, t in rows]
    roots = H.component_labels(sets, 80)
    assert _ids(third) == [rows[i][0] for i in range(len(rows)) if roots[i] == i]
    assert len(rows) > third.count()

    fourth = stages["personal_data"](spark, third, SF)
    assert _ids(fourth) == _ids(third)
    left = pii.pii_digests(fourth).where("spans != ''")
    assert left.count() == 0
    untouched = third.join(pii.pii_digests(third).where("spans = ''"), "doc_id", "left_semi").select("doc_id", "text")
    assert untouched.exceptAll(fourth.select("doc_id", "text")).count() == 0
    assert fourth.where(F.char_length("text") != F.col("n_chars")).count() == 0
    assert all(s.columns == docs.columns for s in (first, second, third, fourth))

    last = stages["packing"](spark, fourth, SF)
    assert sorted(r.doc_id for r in last.where("start = 0").collect()) == _ids(fourth)
    assert last.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_bear_odd_and_missing_rows(spark, name, stage):
    docs = H.odd_docs(spark)
    out = stage(spark, docs, SF)
    assert out.count() >= 1
    if name != "packing":
        assert out.columns == docs.columns
    assert stage(spark, H.no_docs(spark), SF).collect() == []


def test_run_applies_the_stages(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert 0 < pieces.where("start = 0").count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
