"""SpotSigs fingerprints against plain loops over words."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from llm_helpers import no_documents, odd_documents, rows
from pyspark.sql import functions as F

from shelfrank.llm import spots as module
from shelfrank.llm.spots import common_words, edited_fingerprints, near_fingerprints, op12_spots, signatures

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def anchors_of(texts, hash_of, most=64):
    df = Counter(w for t in texts for w in set(words(t or "")))
    ranked = sorted(df, key=lambda w: (-df[w], hash_of[w]))
    return set(ranked[: min(most, max(1, len(df) // 4))])


def spots_of(text, anchors):
    found = words(text)
    content = [(i, w) for i, w in enumerate(found) if w not in anchors]
    out = set()
    for i, w in enumerate(found):
        chain = [x for j, x in content if j > i][:2]
        if w in anchors and len(chain) == 2:
            out.add((w, *chain))
    return out or {(w,) for w in found} or ({text} if text else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "und", "la"] + [f"w{i}" for i in range(60)] + ["Été", "日本"]
    weights = [30, 25, 15, 15] + [2] * 62
    out = [", ".join(" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 12))) for _ in range(n)]
    return out + [out[0], out[1] + ".", out[2].replace("w3", "w4"), "!!!", "the of the", "The", "x"]


@pytest.fixture(scope="module")
def corpus(spark):
    data = list(enumerate(prose(5, 120))) + [(900, None), (901, "")]
    every = sorted({w for _, t in data for w in words(t or "")})
    hashes = spark.createDataFrame([(w,) for w in every], "w string").select("w", F.xxhash64("w")).collect()
    anchors = anchors_of([t for _, t in data], dict(map(tuple, hashes)))
    return data, anchors


def test_query(spark, tmp_path, corpus):
    data, anchors = corpus
    frame = spark.createDataFrame(random.Random(1).sample(data, len(data)), SCHEMA).selectExpr("*", "1 AS key", "2 AS spots", "3 AS `a.b`", "4 AS edited")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op12_spots(spark, str(tmp_path)).collect()}
    data = [(i, t or "") for i, t in sorted(data)]
    assert set(got) == {i for i, _ in data}
    for (i, text), (_, after) in zip(data, data[1:] + data[:1], strict=True):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        a, b, c = (spots_of(t, anchors) for t in (text, edited, after))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["near_edited"], r["near_next"]) == (jaccard(a, b), jaccard(a, c))
        assert (len(r["fingerprint"].split()), len(r["edited_fingerprint"].split())) == (len(a), len(b))
    assert got[0]["fingerprint"] == got[120]["fingerprint"]


def test_no_python_in_the_plan(spark, corpus):
    docs = spark.createDataFrame(corpus[0], SCHEMA)
    plan = edited_fingerprints(docs, common_words(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_odd_rows_ties_and_ranges(spark):
    odd = odd_documents(spark)
    found = rows(edited_fingerprints(odd, common_words(odd)).select("doc_id", "text", "edited", F.size("spots")))
    assert [r[0] for r in found] == [1, 2, 3, 4, 4, 5, 6, 7, 8] and found[3] == found[4]
    assert [r for r in found if r[0] == 8][0][2] == "One two three four"[:-4]  # the first document is empty
    assert [r for r in found if r[0] == 6][0][2] == "x" * 22_500 + "word " * 1_500
    assert edited_fingerprints(no_documents(spark), [1]).count() == 0 and common_words(no_documents(spark)) == []
    one = spark.createDataFrame([(None, "abcdefgh")], SCHEMA)
    assert rows(edited_fingerprints(one, common_words(one)).select("doc_id", "edited")) == [(None, "abcdefab")]
    wide = spark.range(500).selectExpr("id % 7 AS doc_id", "'same' || (id % 50) AS text")
    assert edited_fingerprints(wide, [1]).count() == 500


def test_anchor_slots(spark):
    frame = spark.createDataFrame([(i, f"w{i} a b c") for i in range(300)], SCHEMA)
    hashes = {r[0]: r[1] for r in frame.select(F.split("text", " ")[0].alias("w")).select("w", F.xxhash64("w")).collect()}
    chosen = [hashes[f"w{i}"] for i in range(0, 300, 3)]
    got = signatures(frame, chosen, F.col("text"), "s").select("doc_id", F.size("s")).collect()
    # One chain for an anchor at the head; four words where there is none.
    assert all(n == (1 if i % 3 == 0 else 4) for i, n in got)


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_pairs_against_all_pairs(spark, threshold):
    rng = random.Random(9)
    texts = prose(6, 60)
    for i in range(60):  # copies with a few words changed
        parts = texts[i].split(" ")
        for _ in range(rng.randrange(1, 4)):
            parts[rng.randrange(len(parts))] = f"v{rng.randrange(30)}"
        texts.append(" ".join(parts))
    data = list(enumerate(texts)) + [(900, None), (3, texts[3])]
    docs = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS class", "2 AS spot", "3 AS part")
    pairs, members = near_fingerprints(docs, threshold)
    members = members.collect()
    assert sorted(r["doc_id"] for r in members) == sorted(i for i, _ in data)
    frame = signatures(docs.select("doc_id", "text"), common_words(docs), F.col("text"), "s")
    sets = {r["doc_id"]: frozenset(r["s"]) for r in frame.collect()}
    of = {r["class"]: sets[r["doc_id"]] for r in members}
    want = {frozenset((x, y)): jaccard(of[x], of[y]) for x, y in combinations(of, 2) if of[x] and of[y] and jaccard(of[x], of[y]) >= threshold}
    got = {frozenset((r["a"], r["b"])): r["likeness"] for r in pairs.collect()}
    assert len(want) > 5 and got == want
    assert near_fingerprints(no_documents(spark))[0].count() == 0
