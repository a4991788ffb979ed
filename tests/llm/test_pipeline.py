"""The pipeline against its stages done one by one, and its hard inputs."""

import os

import pytest

import corpus_pipeline
from ledgerlens.llm import mixing, pu_quality, quality_rules, simhash_dedup

from .helpers import odd_docs

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    sets = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        sets.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert sets[-1] <= sets[-2], name
    assert 0 < len(sets[-1]) < len(sets[0])
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    scores = pu_quality.with_score(whole, pu_quality.train(whole, labels), keep=["doc_id"])
    assert sets[1] == {r.doc_id for r in scores.filter("score >= 0.3").collect()}
    part = whole.filter(whole.doc_id.isin(list(sets[1])))
    assert sets[2] == {r.doc_id for r in quality_rules.judge(part, labels).filter("kept").collect()}
    part = part.filter(part.doc_id.isin(list(sets[2])))
    assert sets[3] == {r.component_id for r in simhash_dedup.near_duplicates(part).collect()}
    part = part.filter(part.doc_id.isin(list(sets[3])))
    assert sets[4] == {r.doc_id for r in mixing.mix_report(part).filter("kept").collect()}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == sets[4]
    for d in sets[4]:
        own = sorted((r.start, r.length) for r in pieces if r.doc_id == d)
        total = next(r.doc_tokens for r in pieces if r.doc_id == d)
        assert sum(n for _, n in own) == total and all(a == sum(n for _, n in own[:k]) for k, (a, _) in enumerate(own))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, empty):
    docs = odd_docs(spark).limit(0) if empty else odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.count()
        assert not empty or rows == 0, name
        if name != "packing":
            assert out.columns == docs.columns


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for top, _, names in os.walk(os.path.join(root, "ledgerlens")):
        if os.path.basename(top) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "ledgerlens.llm" not in open(os.path.join(top, n)).read(), n
