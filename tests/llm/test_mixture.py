"""Targets against step-by-step resharing; repetitions against the rules of the mix."""

import random

import pytest
from llm_helpers import no_documents, odd_documents, rows

from shelfrank.llm.mixture import mix, mixed_documents, water_fill


def reshared(sizes, weights, most):
    """Share by weight, clamp what is above its maximum, share the rest again until none is above."""
    total, clamped = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in clamped]
        left = total - sum(clamped.values())
        shares = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        above = {i: most * sizes[i] for i in free if shares[i] > most * sizes[i]}
        if not above:
            return [clamped.get(i, shares.get(i)) for i in range(len(sizes))]
        clamped |= above


@pytest.mark.parametrize("seed", range(6))
def test_water_filling(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 3000]) for _ in range(rng.randint(1, 12))]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    table = spark.createDataFrame(list(zip(map(str, range(len(sizes))), sizes, weights)), "source string, source_size long, weight int")
    got = {int(r.source): r.target for r in water_fill(table).collect()}
    want = reshared(sizes, weights, 3)
    assert all(abs(got[i] - want[i]) < 1e-6 * max(1, want[i]) for i in range(len(sizes)))


def test_mix_of_random_documents(spark):
    rng = random.Random(5)
    data = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = mix(docs, buckets=16).collect()
    assert sorted(r.doc_id for r in found) == list(range(400))
    by_source = {}
    for r in found:
        size = len(data[r.doc_id][1].split())
        assert r.size == size and r.taken == r.repeats * size and r.repeats <= 3
        by_source.setdefault(data[r.doc_id][2], []).append(r)
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by_source[s]) for s in order]
    targets = reshared(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))], 3)
    for source, size, target in zip(order, sizes, targets, strict=True):
        group = by_source[source]
        assert {r.source_size for r in group} == {size}
        assert all(abs(r.target - target) < 1e-6 for r in group)
        assert target - 60 < sum(r.taken for r in group) <= target + 1e-6
        assert len({r.repeats for r in group if r.size}) <= 2
    assert rows(mix(docs.repartition(7), buckets=16).drop("x")) == rows(mix(docs, buckets=16))


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'q' AS size", "2 AS target")
    found = mixed_documents(docs)
    assert found.columns == docs.columns
    taken = mix(docs).collect()
    assert len(taken) == docs.count()
    assert {r.doc_id for r in taken if r.size == 0} == {1, 2, 3}
    assert mix(no_documents(spark)).count() == 0


def test_main_path_has_no_python(spark):
    plan = mix(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_long_documents_do_not_end_a_draw(spark, seed):
    """No document left out fits into what a source misses."""
    rng = random.Random(seed)
    sizes = [(s, rng.randint(5, 40)) for s in "abc" for _ in range(150)] + [(s, rng.randint(900, 1500)) for s in "abc" for _ in range(4)]
    data = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    groups = {}
    for r in mix(docs, seed=seed, buckets=16).collect():
        groups.setdefault(data[r.doc_id][2], []).append(r)
    for group in groups.values():
        whole = min(r.repeats for r in group)
        missing = group[0].target - sum(r.taken for r in group)
        left = [r.size for r in group if r.repeats == whole and whole < 3]
        assert missing > -1e-6 and (not left or missing < min(left))


def test_clashing_names(spark):
    docs = odd_documents(spark).selectExpr(
        "*", "1 AS `a.b`", "2 AS __doc", "3 AS __row", "4 AS __once", "5 AS size", "6 AS repeats", "7 AS target", "8 AS __copy"
    )
    found = mixed_documents(docs)
    assert found.columns == docs.columns
    assert {tuple(r)[3:] for r in found.collect()} == {(1, 2, 3, 4, 5, 6, 7, 8)}
    plain = mixed_documents(odd_documents(spark))
    assert rows(found.select("doc_id", "text", "source")) == rows(plain)
