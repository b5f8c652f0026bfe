"""Token alignment against sets of byte offsets of whole-text encodings."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from shelfrank.llm import alignment as module
from shelfrank.llm.alignment import align_tokens, op13_token_alignment
from shelfrank.llm.bpe import byte_letters

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BYTES = {letter: bytes([i]) for i, letter in enumerate(byte_letters())}


def ends(names):
    total, out = 0, []
    for name in names:
        total += len(name)
        out.append(total)
    return out


def aligned(text):
    """Ids of both sides and their linked places, from whole texts."""
    whole = (" " + (text or "")).encode()
    a = A.encode(" " + (text or ""), add_special_tokens=False).ids
    b = B.encode(text or "")
    a_names = [b"".join(BYTES[c] for c in A.id_to_token(i)) for i in a]
    names = [B.id_to_piece(i) for i in b]
    b_names = [bytes([int(n[3:5], 16)]) if B.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names, strict=True)]
    if not text or b"".join(a_names) != whole or b"".join(b_names) != whole:
        return [], [], [], []
    a_ends, b_ends = ends(a_names), ends(b_names)
    place = {e: j for j, e in enumerate(b_ends)}
    links = [(i, place[e]) for i, e in enumerate(a_ends) if e in place]
    return a, b, links, [a_ends[i] for i, _ in links]


def expected(rows):
    found = [(i, *aligned(t)[:3]) for i, t in rows]
    count = Counter((a[x], b[y]) for _, a, b, links in found for x, y in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for i, a, b, links in found:
        groups, x0, y0 = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, a[x0 : x + 1])) + "|" + ",".join(map(str, b[y0 : y + 1])))
            x0, y0 = x + 1, y + 1
        ns = [count[a[x], b[y]] for x, y in links]
        best = sum(n == most[b[y]] for n, (_, y) in zip(ns, links, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(links), len(links), best, sum(ns), digest))
    return Counter(out)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.selectExpr("*", "1 AS row", "2 AS pairs", "3 AS times", "4 AS `a.b`").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return Counter(map(tuple, op13_token_alignment(spark, str(tmp_path)).select(*COLUMNS).collect()))


def hostile(seed, n):
    rng = random.Random(seed)
    parts = ["the", "Hello", " ", "  ", "\n", "\t", " \n ", " ", "　", "▁", "a▁b", "é", "é", "日本語", "😀", "'s", "n't", "12345",
             "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "\x00", "\x1f", ".", "...", "!?", "ﬁ", "Ж", " word", "word ", "﻿", "​"]
    return [(i, "".join(rng.choices(parts, k=rng.randrange(1, 30)))) for i in range(n)]


@pytest.mark.parametrize("stretch", [1, 64])
def test_hostile_texts(spark, tmp_path, stretch, monkeypatch):
    monkeypatch.setattr(module, "STRETCH", stretch)
    rows = hostile(stretch, 600) + [(1000, None), (1001, ""), (1002, " "), (None, "no id"), (1003, "a b c " * 9000), (1004, "x" * 20_000)]
    rows += rows[:5]
    want = expected(rows)
    assert sum(r[1] > 0 for r in want) > 200 and any(r[1] == 0 and r[0] and r[0] < 600 for r in want)
    assert run(spark, tmp_path, rows) == want


def test_counts_by_shuffle_and_forgetting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "LISTED", 0)
    monkeypatch.setattr(module, "REMEMBERED", 10)
    rows = hostile(3, 200) + [(5000 + i, "the same words again") for i in range(300)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_places_and_cuts(spark):
    rows = hostile(4, 120)
    got = {r["doc_id"]: r for r in align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect()}
    for i, text in rows:
        a, b, links, cuts = aligned(text)
        r = got[i]
        assert (r["a_ids"], r["b_ids"], r["cuts"]) == (a, b, cuts)
        assert list(zip(r["a_last"], r["b_last"], strict=True)) == links


def test_odd_and_empty_tables(spark):
    found = align_tokens(odd_documents(spark), *PATHS).collect()
    assert len(found) == 9 and sum(not r["a_ids"] for r in found) == 2
    assert align_tokens(no_documents(spark), *PATHS).count() == 0
