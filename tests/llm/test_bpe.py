"""BPE against the tokenizers library, merge by merge and on whole tables."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from shelfrank.llm.bpe import Coder, bpe_decode, bpe_encode, op5_bpe, read_vocabulary, tokenizer_path

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODER = Coder(read_vocabulary(tokenizer_path()))
PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "é", "é", "'s", "'LL", "12", "½",
    ".", "!!", "<|endoftext|>", "<|endo", "中文", "😀", "ing", "the", "\x00", "²", "　", "﻿",
]


def same(text):
    ids, counts = CODER.encode([text])
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    raw, _ = CODER.decode_bytes(ids)
    return ids.tolist() == want and counts.tolist() == [len(want)] and raw.tobytes().decode() == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert same(text)


@pytest.mark.parametrize("seed", range(300))
def test_mixed_parts(seed):
    rng = random.Random(seed)
    assert same("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))))


@pytest.mark.parametrize("text", ["x" * 5000, "ab" * 4000, " " * 300, "\n" * 50 + " a", "é" * 3000])
def test_long_pieces(text):
    assert same(text)


def test_invalid_bytes_become_the_replacement_character(spark):
    # One byte of a character of three.
    lone = LIBRARY.encode("中", add_special_tokens=False).ids[:1]
    tokens = spark.createDataFrame([(1, lone), (2, None), (3, [])], "n int, ids array<int>")
    got = {r.n: r.decoded for r in bpe_decode(tokens, tokenizer_path()).collect()}
    assert got == {1: LIBRARY.decode(lone), 2: "", 3: ""}


def test_query(spark, small):
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        digits = ",".join(map(str, ids))
        want[r.doc_id] = (len(ids), hashlib.sha256(digits.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert {r[0]: tuple(r[1:]) for r in op5_bpe(spark, small).collect()} == want


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "3 AS size")
    found = bpe_encode(docs, tokenizer_path())
    assert found.columns == [*docs.columns, "ids"]
    for r in found.collect():
        assert r.ids == LIBRARY.encode(r.text or "", add_special_tokens=False).ids
    assert bpe_encode(no_documents(spark), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        bpe_encode(docs.withColumnRenamed("size", "ids"), tokenizer_path())
