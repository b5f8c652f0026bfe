"""Licence scans against a word-by-word search."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import no_documents, odd_documents

from shelfrank.llm.common import ALNUM_WORDS, Words
from shelfrank.llm.licenses import BASE_PHRASES, NOTICES, RareWordIndex, license_scan, op6_license_scan, scan

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def expected(text):
    words = words_of(text)
    places = []
    for phrase, label in BASE_PHRASES:
        parts = phrase.encode().split()
        places += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def base_part(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in op6_license_scan(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        got = found[r.doc_id]
        assert base_part(got) == expected(r.text)
        assert set(filter(None, got.base_labels.split(","))) <= set(filter(None, got.labels.split(",")))
        assert 0 <= got.score <= 1 and (got.score == 1) >= (got.n_base > 0)


def test_random_word_salad(spark):
    rng = random.Random(2)
    pool = [w for text, *_ in (*BASE_PHRASES, *NOTICES) for w in text.split()] + ["x", "é", "2"]
    phrases = [p for p, _ in BASE_PHRASES]
    data = [(i, " ".join(rng.choice(phrases if rng.random() < 0.2 else pool) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert all(base_part(r) == expected(r.text) for r in license_scan(docs).collect())


@pytest.mark.parametrize("seed", range(5))
def test_notices_with_changed_words(seed):
    """A notice counts exactly when enough of its words stand in place and its key phrase is whole."""
    rng = random.Random(seed)
    index = RareWordIndex()
    idf = np.array([rng.random() for _ in index.names])
    for text, label, phrase in NOTICES:
        words = text.split()
        for _ in range(6):
            changed = [w if rng.random() < 0.88 else "zzz" for w in words]
            same = sum(a == b for a, b in zip(words, changed, strict=True)) / len(words)
            whole = f" {phrase} " in f" {' '.join(changed)} "
            got = scan(Words(pa.array(["pre " + " ".join(changed) + " post"], pa.large_string()), ALNUM_WORDS), index, idf)
            if same >= 0.8 and whole:
                assert label in got["labels"][0].split(",") and got["score"][0] >= same - 1e-9


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS words")
    found = license_scan(docs).collect()
    assert [base_part(r) for r in found] == [expected(r.text) for r in docs.collect()]
    assert all(r.labels == "" and r.score == 0 for r in found)
    assert license_scan(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        license_scan(docs.withColumnRenamed("words", "labels"))
