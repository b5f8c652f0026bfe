"""Elias-Fano codes and token files: round trips, and ids against the tokenizers library."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from shelfrank.llm import token_files
from shelfrank.llm.token_files import EliasFano, WordCoder, op2_token_files, token_table, tokenizer_path, write_token_files

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**45), min_size=1, max_size=600), st.integers(1, 2**20))
def test_elias_fano(values, narrow):
    for rising in (sorted(values), sorted(v % narrow for v in values)):
        code = EliasFano.of(np.array(rising, np.int64))
        read, end = EliasFano.read(memoryview(code.to_bytes() + b"rest"), 0, len(code.high))
        assert end == len(code.to_bytes())
        assert read.select(np.arange(len(rising))).tolist() == rising


def test_space_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000))
    assert len(EliasFano.of(ends).to_bytes()) < 1.6 * len(ends)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_words_as_the_library(texts):
    coder = WordCoder(open(tokenizer_path(), encoding="utf-8").read())
    ids, counts = coder.table.tokens([t.encode().split() for t in texts])
    ends = np.concatenate(([0], np.cumsum(counts)))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def expected(table):
    out, at = [], 0
    for doc_id, text in table:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("segment", [50, 4_000_000])
def test_query(spark, small, segment, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    table = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    assert sorted(tuple(r) for r in op2_token_files(spark, small).collect()) == expected(table)


def test_odd_rows(spark, tmp_path):
    docs = odd_documents(spark).selectExpr("doc_id", "text", "1 AS start").unionByName(
        spark.createDataFrame([(None, "no id", 1), (-5, "below", 1)], "doc_id long, text string, start int")
    )
    write_token_files(docs, tokenizer_path(), str(tmp_path / "t"))
    got = sorted((tuple(r) for r in token_table(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    table = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert got == expected(table)
    write_token_files(no_documents(spark), tokenizer_path(), str(tmp_path / "none"))
    assert token_table(spark, str(tmp_path / "none")).count() == 0


def test_pieces_of_known_words_are_not_encoded_again():
    with open(token_files.tokenizer_path(), encoding="utf-8") as file:
        coder = token_files.WordCoder(file.read())
    plain, asked = coder.tokenizer.encode, []
    encode = coder._ids
    coder._ids = lambda texts: asked.append(texts) or encode(texts)
    for text in ("Word stone", "word, STONE. word stone", "stone,"):
        ids, counts = coder.table.tokens([text.encode().split()])
        assert ids.tolist() == plain(text, add_special_tokens=False).ids and counts.sum() == len(ids)
    assert " ".join(t for texts in asked for t in texts).split().count("stone") == 1
