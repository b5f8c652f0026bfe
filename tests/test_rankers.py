"""Rankers against scoring every pair with the fitted pipeline."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfrank.plans.rankers import LogisticRanker, SvmRanker, TreeRanker, additive_top_k, exact_relevance, short_list

SEGMENTS, CATEGORIES = ["budget", "mainstream", "premium"], ["books", "clothing", "home"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    users = [(u, rng.choice(SEGMENTS), *(rng.gauss(0, 1) for _ in range(3))) for u in range(200)]
    items = [(i, rng.choice(CATEGORIES), rng.uniform(1, 600), *(rng.gauss(0, 1) for _ in range(3))) for i in range(300)]
    log = []
    for u in users:
        for i in rng.sample(items, rng.randint(0, 12)):
            likes = u[2] + i[3] + (u[1] == "premium") + (i[1] == "books") - i[2] / 400 + rng.gauss(0, 1)
            log.append((u[0], i[0], int(likes > 0)))
    return (
        spark.createDataFrame(log, "user_idx long, item_idx long, response int"),
        spark.createDataFrame(users, "user_idx long, segment string, user_attr_0 double, user_attr_1 double, user_attr_7 double"),
        spark.createDataFrame(
            items, "item_idx long, category string, price double, item_attr_0 double, item_attr_1 double, item_attr_2 double"
        ),
    )


@pytest.mark.parametrize("kind", [LogisticRanker, SvmRanker, TreeRanker])
def test_every_pair(tables, kind):
    log, users, items = (t.cache() for t in tables)
    ranker = kind().fit(log, users, items)
    pairs = users.crossJoin(items).join(log, ["user_idx", "item_idx"], "left_anti")
    p = F.round(vector_to_array("probability")[1], 9)
    scored = ranker.model.transform(pairs).select(
        "user_idx", "item_idx", p.alias("p"), exact_relevance(ranker, p, F.col("price")).alias("relevance")
    )
    all_pairs = scored.toPandas()
    got = ranker.predict(log, 5, users, items).toPandas()
    assert len(got) == 200 * 5
    for user, theirs in all_pairs.groupby("user_idx"):
        mine = got[got.user_idx == user].sort_values("rank")
        best = theirs.sort_values(["relevance", "item_idx"], ascending=[False, True]).head(5)
        assert np.allclose(mine.relevance, best.relevance, rtol=1e-6, atol=1e-5)
        known = theirs.set_index("item_idx").loc[mine.item_idx]
        assert np.allclose(known.p, mine.probability, atol=1e-6)
        assert np.allclose(known.relevance, mine.relevance, rtol=1e-6, atol=1e-5)
    # Users of one segment with other attribute values have other lists.
    assert len({tuple(g.sort_values("rank").item_idx) for _, g in got.groupby("user_idx")}) > 5


def test_short_list_with_negative_factors_and_ties(spark):
    rng = random.Random(4)
    users = [(u, rng.choice([-2.0, 0.0, 1.5])) for u in range(12)]
    items = [(i, float(rng.randint(-3, 3)), float(rng.randint(-4, 2))) for i in range(80)]
    seen = [(u, i) for u, _ in users for i in rng.sample(range(80), rng.randint(0, 70))]
    got = additive_top_k(
        spark.createDataFrame(users, "user_idx long, a double"),
        spark.createDataFrame(items, "item_idx long, b double, g double").repartition(5),
        spark.createDataFrame(seen, "user_idx long, item_idx long"),
        4,
    ).collect()
    for u, a in users:
        scores = sorted((-round(g / (1 + np.exp(-(a + b))), 9), i) for i, b, g in items if (u, i) not in set(seen))[:4]
        assert [r.item_idx for r in sorted(got, key=lambda r: r["rank"]) if r.user_idx == u] == [i for _, i in scores]


def test_short_list_keeps_all_that_fewer_beat(spark):
    rng = random.Random(9)
    items = [(i, round(rng.gauss(0, 1), 2), float(rng.choice([3.0, rng.randint(0, 40), rng.uniform(0, 40)]))) for i in range(3000)]
    sizes = []
    kept = {r.item_idx for r in short_list(spark.createDataFrame(items, "item_idx long, b double, g double"), 20, sizes).collect()}
    b, g = np.array([x[1] for x in items]), np.array([x[2] for x in items])
    beaten = ((b[None, :] > b[:, None]) & (g[None, :] > g[:, None])).sum(1)
    assert {i for i in range(3000) if beaten[i] < 20} <= kept
    assert sizes[0] == 3000 and sizes[-1] == len(kept) < 900


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_one_long_history_lengthens_no_other_list(spark, sign):
    """User 0 has seen nearly the whole catalogue; the others still meet a short list."""
    rng = random.Random(6)
    users = [(u, rng.gauss(0, 1)) for u in range(8)]
    items = [(i, rng.gauss(0, 1), sign * rng.uniform(1, 9)) for i in range(1500)]
    seen = [(0, i) for i in range(1500) if i % 300] + [(u, i) for u in range(1, 7) for i in rng.sample(range(1500), 3 * u)]
    sizes = []
    got = additive_top_k(
        spark.createDataFrame(users, "user_idx long, a double"),
        spark.createDataFrame(items + [(9999, None, 5.0), (9998, 1.0, float("nan"))], "item_idx long, b double, g double"),
        spark.createDataFrame(seen, "user_idx long, item_idx long"),
        3,
        tier=32,
        work=sizes,
    ).collect()
    for u, a in users:
        scores = sorted((-round(g / (1 + np.exp(-(a + b))), 9), i) for i, b, g in items if (u, i) not in set(seen))[:3]
        assert [r.item_idx for r in sorted(got, key=lambda r: r["rank"]) if r.user_idx == u] == [i for _, i in scores]
    assert 1500 in sizes and sizes[-1] < 700


def test_rankers_with_nobody_or_nothing(spark):
    users, items = spark.createDataFrame([(1, 0.5)], "user_idx long, a double"), spark.createDataFrame([(1, 0.5, 2.0)], "item_idx long, b double, g double")
    seen = spark.createDataFrame([(1, 1)], "user_idx long, item_idx long")
    assert additive_top_k(users, items, seen, 2).isEmpty()
    assert additive_top_k(users.limit(0), items, seen, 2).isEmpty()
    assert additive_top_k(users, items.limit(0), seen, 2).isEmpty()
    assert additive_top_k(users, items, None, 2).count() == 1


def test_tree_is_taken_apart_into_paths_of_users_and_leaves_of_items(tables):
    log, users, items = (t.cache() for t in tables)
    ranker = TreeRanker().fit(log, users, items)
    follow, offer = (t.toPandas() for t in ranker.paths(users, items))
    leaves = ranker.leaves()
    tree = ranker.model.stages[-1]
    assert len(leaves) == (tree.numNodes + 1) // 2
    # For every pair exactly one path is followed and offered.
    for theirs in offer.leaves[:40]:
        for mine in follow.paths:
            assert len(set(mine) & {leaf["path"] for leaf in theirs}) == 1
    assert sum(len(x) for x in offer.leaves) <= len(leaves) * 300
    rows = ranker.model.transform(users.crossJoin(items.limit(7)))
    p = {(r.user_idx, r.item_idx): float(r.probability[1]) for r in rows.select("user_idx", "item_idx", "probability").collect()}
    paths, offered = dict(zip(follow.user_idx, follow.paths)), dict(zip(offer.item_idx, offer.leaves))
    for (u, i), expected in p.items():
        (found,) = [leaf["probability"] for leaf in offered[i] if leaf["path"] in set(paths[u])]
        assert found == pytest.approx(expected, abs=1e-9)


def test_tree_with_missing_values_and_unknown_labels(spark, tables):
    log, users, items = tables
    ranker = TreeRanker().fit(log, users, items)
    odd = spark.createDataFrame(
        [(900, None, None, 0.1, 0.2), (901, "other", float("nan"), None, 0.0)], users.schema
    )
    got = ranker.predict(log, 4, users.unionByName(odd), items, True)
    assert got.where("user_idx >= 900").count() == 8
    assert ranker.predict(log.limit(0), 4, odd, items.limit(0), True).isEmpty()
