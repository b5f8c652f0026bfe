"""Exact deduplication against grouping in Python, also with digests that collide."""

import hashlib
import re
from collections import Counter

import pytest
from llm_helpers import no_documents, odd_documents, rows

from shelfrank.llm.exact_dedup import exact_dedup, without_copies


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(table):
    groups: dict[str, list[int]] = {}
    for doc_id, text, _ in table:
        groups.setdefault(normal(text), []).append(doc_id)
    return Counter((d, min(groups[normal(t)]), len(groups[normal(t)])) for d, t, _ in table)


@pytest.mark.parametrize("bits", [256, 8])
def test_groups(spark, bits):
    docs = odd_documents(spark)
    # With 8-bit digests, many different texts meet: only the full bytes tell them apart.
    more = spark.createDataFrame([(100 + i, f"text {i % 350}", "s") for i in range(700)], docs.schema)
    both = docs.unionByName(more)
    found = exact_dedup(both, digest_bits=bits)
    table = [tuple(r) for r in both.collect()]
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found.collect()) == expected(table)
    assert found.where("kept").count() == len({normal(t) for _, t, _ in table})
    if bits == 256:
        assert {r.digest.hex() for r in found.collect()} == {hashlib.sha256(normal(t).encode()).hexdigest() for _, t, _ in table}


def test_kept_documents_keep_their_columns(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS keep", "'z' AS digest")
    left = without_copies(docs)
    assert left.columns == docs.columns
    assert [r[0] for r in rows(left)] == [1, 3, 4, 5, 6, 7, 8]


def test_empty_table(spark):
    assert exact_dedup(no_documents(spark)).count() == 0


def test_null_ids_come_last(spark):
    docs = spark.createDataFrame([(None, "same", "a"), (9, "same", "a"), (None, "alone", "a")], odd_documents(spark).schema)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert got == {(None, 9, 2, False), (9, 9, 2, True), (None, None, 1, True)}


@pytest.mark.parametrize("in_files", [True, False])
def test_clashing_names(spark, tmp_path, in_files):
    docs = odd_documents(spark).selectExpr(
        "*", "1 AS __row", "2 AS __file", "'m' AS _metadata", "4 AS doc", "5 AS `a.b`", "6 AS norm", "7 AS copies"
    )
    if in_files:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    assert [r.doc_id for r in exact_dedup(docs).where("kept").orderBy("doc_id").collect()] == [1, 3, 4, 5, 6, 7, 8]
    left = without_copies(docs)
    assert left.columns == docs.columns
    assert [r[0] for r in rows(left)] == [1, 3, 4, 5, 6, 7, 8]
    assert {tuple(r)[3:] for r in left.collect()} == {(1, 2, "m", 4, 5, 6, 7)}
