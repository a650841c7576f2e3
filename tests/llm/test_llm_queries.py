"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

import os

import pytest

import oracle
from gaugeloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the provided tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    oracle.compare(spark, oracle.connect(SF), name, QUERIES[name], ORACLES.get(name), SF)


def test_pipeline(spark):
    import __spark_entry__ as entry
    import corpus_pipeline
    from gaugeloom.llm.common import keep, load
    from gaugeloom.llm.templates import find_leaks

    docs = whole = load(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = keep(stage(spark, docs, SF), name)
        assert docs.columns == whole.columns and docs.join(before.select("doc_id"), "doc_id", "left_anti").isEmpty()
    assert find_leaks(docs, load(spark, SF, "benchmark")).isEmpty()
    pieces = entry.queries()["pipeline"](spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
