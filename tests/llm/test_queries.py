"""Registered queries against their SQL texts, and the pipeline's stages."""

import pytest
from compare import differences, run_sql

import __spark_entry__ as registered
import corpus_pipeline
from shelfrank.llm.common import table, written
from shelfrank.llm.queries import ORACLES, QUERIES


def test_one_query_per_operator():
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), run_sql(small, ORACLES[name])) is None


def test_pipeline(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), name)
        counts.append(docs.count())
        if name != "bpe":
            assert docs.columns == columns
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] and counts[4] == counts[5]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "bpe"]
    assert corpus_pipeline.run(spark, small).count() == counts[5]
