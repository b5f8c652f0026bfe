"""Nearest neighbours against all products."""

import numpy as np
import pytest

from shelfrank.llm import nearest as module
from shelfrank.llm.nearest import exact_products, nearest

SCHEMA = "vec_id long, embedding array<float>"


def expected(queries, candidates, k):
    out = []
    for q, x in queries:
        scored = [(-float(exact_products(np.array([x], float), np.array([y], float))[0]), c) for c, y in candidates if c != q]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_random_vectors_with_ties(spark, block, monkeypatch):
    monkeypatch.setattr(module, "QUERY_BLOCK", block)
    monkeypatch.setattr(module, "CANDIDATE_BLOCK", block)
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in np.round(rng.normal(size=8) * 4) / 4]) for i in range(150)]
    data += [(1000 + i, data[i % 5][1]) for i in range(40)]  # many equal vectors
    usable = [(i, v) for i, v in data if any(v)]
    table = spark.createDataFrame(data, SCHEMA)
    got = sorted(tuple(r) for r in nearest(table.where("vec_id % 5 = 0"), table, 6).collect())
    assert got == expected([(i, v) for i, v in usable if i % 5 == 0], usable, 6)


def test_scales_far_apart(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(np.float32(v)) for v in rng.normal(size=4) * 10.0 ** rng.integers(-6, 6)]) for i in range(120)]
    table = spark.createDataFrame(data, SCHEMA)
    assert sorted(tuple(r) for r in nearest(table, table, 5).collect()) == expected(data, data, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [1.0, 2.0, 3.0]), (10, [1.0, 0.0]),
    ]
    table = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS rank", "2 AS dim", "3 AS qb")
    got = sorted(tuple(r) for r in nearest(table, table, 20).collect())
    assert got == [
        (1, 1, 10, 1.0), (1, 2, 8, 0.5), (1, 3, 8, 0.5), (8, 1, 1, 0.5), (8, 2, 10, 0.5),
        (10, 1, 1, 1.0), (10, 2, 8, 0.5), (10, 3, 8, 0.5),
    ]
    assert nearest(table.limit(0), table, 3).count() == 0
    assert nearest(table, table.limit(0), 3).count() == 0


def test_components_near_the_ends_of_the_range(spark):
    rng = np.random.default_rng(6)
    data = [(i, [float(v) for v in rng.normal(size=4) * 10.0 ** rng.choice([-200, -160, 0, 100, 150])]) for i in range(90)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in nearest(table, table, 5).collect()) == expected(data, data, 5)


def test_products_beyond_the_range(spark):
    data = [(1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [1e200, 0.0]), (4, [-1e200, 0.0]), (5, [1.0, 1.0]), (6, [5e-324, 0.0])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, repr(r.score)) for r in nearest(table, table, 5).collect()}
    assert len(got) == 30
    assert [got[1, n] for n in range(1, 6)] == [(2, "nan"), (3, "inf"), (5, "2e+200"), (6, repr(5e-324 * 1e200)), (4, "-inf")]
    assert got[5, 1] == (1, "2e+200") and got[6, 5] == (4, repr(-5e-324 * 1e200))
