"""Near duplicates against all pairs in Python, with groups of near copies that differ everywhere."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import ascii_words, no_documents, odd_documents
from pyspark.sql import functions as F

from shelfrank.llm import near_dedup
from shelfrank.llm.common import components
from shelfrank.llm.near_dedup import near_duplicates, without_near_duplicates


def shingles(text, words):
    w = ascii_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) or frozenset([tuple(w)])


def expected(table, words, percent):
    sets = [(d, shingles(t, words)) for d, t in table]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(sets):
        smallest[find(i)] = min(d, smallest.get(find(i), d))
    return sorted((d, len(s), smallest[find(i)], d == smallest[find(i)]) for i, (d, s) in enumerate(sets))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_random_texts_and_a_large_group(spark, words, percent):
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(300)]
    table = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        table += [" ".join(base)] + [edited(rng, base, rng.randint(0, 6)) for _ in range(rng.randint(0, 4))]
    base = [rng.choice(vocabulary) for _ in range(100)]
    table += [edited(rng, base, rng.randint(1, 3)) for _ in range(120)]
    table = list(enumerate(table))
    rng.shuffle(table)
    docs = spark.createDataFrame(table, "doc_id long, text string")
    got = sorted(tuple(r) for r in near_duplicates(docs, words, percent).collect())
    assert got == expected(table, words, percent)


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS node", "2 AS kept")
    table = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in near_duplicates(docs).collect())
    assert got == expected(table, 5, 80)
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 4, 6, 7, 8]
    assert near_duplicates(no_documents(spark)).count() == 0


def test_sketches_tell_similarity():
    rng = np.random.default_rng(1)
    for share in (1.0, 0.95, 0.85):
        a = rng.integers(0, 2**63, 4000).astype(np.uint64)
        b = a.copy()
        changed = round(len(a) * (1 - share) / (1 + share))
        b[:changed] = rng.integers(0, 2**63, changed).astype(np.uint64)
        both = np.concatenate([np.unique(a), np.unique(b)])
        samples = near_dedup.min_hashes(both, np.array([len(np.unique(a)), len(np.unique(b))]))
        x, y = near_dedup.odd_sketches(samples)
        bits = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert bits <= near_dedup.sketch_limit(share)
        assert abs(1 - bits / (2 * near_dedup.SAMPLES) - share) < 0.15


def test_short_texts_are_one_shingle():
    values, sizes = near_dedup.shingle_sets(pa.array(["a b", None, "a b c d", "A B", " "]), 3)
    assert sizes.tolist() == [1, 0, 2, 1, 0] and values[0] == values[3]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
    assert len(found) == 63


def test_only_the_rows_of_near_copies_go(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    other = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3)]
    data = [
        (1, " ".join(base)), (None, edited(rng, base, 1)), (None, other[0]), (None, other[1]), (None, None),
        (5, edited(rng, base, 1)), (5, other[2]), (5, other[2]),
    ]
    left = without_near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, [data[i] for i in (0, 2, 3, 4, 6, 7)]))


def test_clashing_names(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS id", "2 AS mark", "3 AS __gone", "4 AS `a.b`", "5 AS doc", "6 AS kept")
    found = without_near_duplicates(docs)
    assert found.columns == docs.columns
    assert {tuple(r)[3:] for r in found.collect()} == {(1, 2, 3, 4, 5, 6)}
    plain = without_near_duplicates(odd_documents(spark))
    assert sorted(map(repr, found.select("doc_id", "text", "source").collect())) == sorted(map(repr, plain.collect()))


def test_rounds_by_sketch_part_the_pairs(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    table = [(i, edited(rng, base, rng.randint(2, 12))) for i in range(60)]
    job = near_dedup.NearDuplicates(spark.createDataFrame(table, "doc_id long, text string"), 3, 85, "doc_id", "text")
    shared = job.nodes.select("node", F.explode("bands").alias("bucket"))
    none = job.nodes.select("node", F.col("node").alias("root")).limit(0)
    tight, full = near_dedup.sketch_limit(0.85, 0.0), near_dedup.sketch_limit(0.85)

    def pairs(above, limit):
        return {frozenset((bytes(r.a), bytes(r.b))) for r in job.rest(shared, none, above, limit).collect()}

    first, last = pairs(-1, tight), pairs(tight, full)
    assert tight < full and first and last and not first & last
    assert first | last == pairs(-1, full)


def test_long_buckets_with_and_without_blocks(spark, monkeypatch):
    """Variants around the threshold of one text: no link is lost, and few pairs are compared."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    table = [(i, edited(rng, base, rng.randint(1, 7))) for i in range(240)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    seen = []
    confirmed = near_dedup.NearDuplicates.confirmed

    def counted(self, pairs):
        seen.append(pairs.count())
        return confirmed(self, pairs)

    monkeypatch.setattr(near_dedup.NearDuplicates, "confirmed", counted)
    want = expected(table, 3, 85)
    assert sorted(tuple(r) for r in near_duplicates(docs, 3, 85).collect()) == want
    assert len(seen) == 3  # best hubs, middles, the rest
    apart = len({r[2] for r in want})
    # Every variant that is linked with none may meet all others, but most that differ too much do not.
    assert seen[-1] < 0.5 * apart * len(table)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    assert sorted(tuple(r) for r in near_duplicates(docs, 3, 85).collect()) == want


def test_blocks_give_the_pairs_of_the_join(spark, monkeypatch):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    table = [(i, edited(rng, base, rng.randint(2, 12))) for i in range(90)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    full = near_dedup.sketch_limit(0.85)

    def pairs(long, exact):
        monkeypatch.setattr(near_dedup, "LONG", long)
        monkeypatch.setattr(near_dedup, "BLOCK", 20)
        job = near_dedup.NearDuplicates(docs, 3, 85, "doc_id", "text")
        shared = job.nodes.select("node", F.explode("bands").alias("bucket"))
        none = job.nodes.select("node", F.col("node").alias("root")).limit(0)
        job.lone = job.lone_shingles(shared, none)
        assert (job.lone is not None) == (long < 90)
        found = job.rest(shared, none, -1, full)
        if exact:
            job.add_sets(found)
            found = job.confirmed(found)
        return [frozenset((bytes(r.a), bytes(r.b))) for r in found.collect()]

    by_join, by_block = pairs(1000, False), pairs(10, False)
    assert len(by_block) == len(set(by_block)) < len(by_join) and set(by_block) < set(by_join)
    assert set(pairs(1000, True)) == set(pairs(10, True)) != set()
