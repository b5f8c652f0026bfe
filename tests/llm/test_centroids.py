"""Centroid clustering against plain loops over whole numbers."""

import hashlib
from collections import Counter
from itertools import pairwise, product
from math import floor

import numpy as np
import pytest

from shelfrank.llm import centroids as module
from shelfrank.llm.centroids import candidates, cluster_vectors, hilbert_keys, limbs, op11_centroids

SCHEMA = "vec_id long, embedding array<double>"


def expected(data, k, rounds, dims, scale=256):
    """Rows and centroids by comparing every vector with every centroid."""
    fine = lambda v: v is not None and len(v) == dims and all(x is not None and abs(x) < float("inf") for x in v)
    kept = [(i, [floor(scale * x) for x in v]) for i, v in data if fine(v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(rounds + 1):
        found = [min((square(v, c), n) for n, c in enumerate(centres)) for _, v in kept]
        if step == rounds:
            break
        for n in range(len(centres)):
            mine = [v for (_, v), (_, m) in zip(kept, found, strict=True) if m == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    return Counter((i, n, min(d, 2**63 - 1)) for (i, _), (d, n) in zip(kept, found, strict=True)), centres


def got(spark, data, **how):
    rows, centres = cluster_vectors(spark.createDataFrame(data, SCHEMA), **how)
    return Counter(map(tuple, rows.collect())), centres


@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 1), (2, 4), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(product(range(2**bits), repeat=dims)))
    order = cells[np.argsort([k.tobytes() for k in hilbert_keys(cells, bits)])]
    assert len({k.tobytes() for k in hilbert_keys(cells, bits)}) == len(cells)
    assert all(np.abs(a - b).sum() == 1 for a, b in pairwise(order))


def test_box_bounds_keep_every_nearest():
    rng = np.random.default_rng(1)
    dropped = 0
    for _ in range(60):
        x = np.floor(rng.normal(size=(20, 3)) * 9 + rng.normal(size=3) * 40)
        centres = np.floor(rng.normal(size=(12, 3)) * 40)
        near = set(candidates(x.min(0), x.max(0), centres).tolist())
        square = ((x[:, None] - centres) ** 2).sum(2)
        assert {n for row in square for n in np.flatnonzero(row == row.min())} <= near
        dropped += 12 - len(near)
    assert dropped > 200


@pytest.mark.parametrize("block", [3, 256])
def test_random_vectors_with_ties_and_repeats(spark, block, monkeypatch):
    monkeypatch.setattr(module.hilbert_blocks, "__defaults__", (block,))
    rng = np.random.default_rng(2)
    data = [(i, [float(v) for v in rng.integers(-3, 4, 4)]) for i in range(150)]
    data += [(500 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(120)] + data[:7]
    assert got(spark, data, k=9, rounds=4, dims=4) == expected(data, 9, 4, 4)


def test_negative_fractions_and_means(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(80)]
    assert got(spark, data, k=5, rounds=5, dims=3) == expected(data, 5, 5, 3)


def test_very_large_components(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(v) * 10.0 ** int(rng.integers(0, 30)) for v in rng.normal(size=3)]) for i in range(60)]
    data += [(100, [1e200, -1e200, 1e250])]
    assert got(spark, data, k=6, rounds=3, dims=3) == expected(data, 6, 3, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]),
        (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [1.0, 2.0, 3.0]), (10, [1.0, 0.0]),
    ]
    assert got(spark, data, k=40, rounds=2, dims=2) == expected(data, 40, 2, 2)
    wide = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS cluster", "'a' AS vector", "2 AS `key`", "3 AS at")
    assert Counter(map(tuple, cluster_vectors(wide, 40, 2, 2)[0].collect())) == expected(data, 40, 2, 2)[0]
    assert got(spark, [], k=3, rounds=2, dims=2) == (Counter(), [])


def test_limbs():
    for value in (0, 1, -1, 2**40, -(2**95) + 12345, 2**700 + 3):
        assert sum(v << module.LIMB * e for e, v in limbs(value)) == value


def test_query_on_odd_table(spark, tmp_path):
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64), (3, None)], "vec_id long, embedding array<float>").write.parquet(path)
    found = op11_centroids(spark, str(tmp_path)).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["distance"], r["cluster_inertia"], r["inertia"]) for r in found] == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert found[0]["centroid_sha256"] == hashlib.sha256(",".join(["128"] * 64).encode()).hexdigest()
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.mode("overwrite").parquet(path)
    assert op11_centroids(spark, str(tmp_path)).count() == 0
