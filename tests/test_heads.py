"""Lists from the head of a ranking: as much of it as some user needs, and the same rows as whole rankings give."""

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import metrics, unseen
from shelfrank.operators.ordinal import ranked_head
from shelfrank.plans.recommenders import UCB, Popularity


def head_of(items):
    return lambda n: ranked_head(items, [], "score", [F.col("item_idx")], F.floor(F.col("item_idx") / 4), n, at_most=200)


@pytest.fixture
def catalogue(spark):
    rows = [(i, float(i % 7) if i % 11 else None) for i in range(200)]
    return spark.createDataFrame(rows, "item_idx long, score double")


@pytest.mark.parametrize("first,limit,lengths", [(8, 1_000_000, [8, 128]), (8, 20, [8, 128]), (1000, 1_000_000, [200])])
def test_first_unseen_reads_a_head_and_equals_brute_force(spark, catalogue, monkeypatch, first, limit, lengths):
    from shelfrank.operators import ordinal

    monkeypatch.setattr(unseen, "FIRST", first)
    monkeypatch.setattr(ordinal, "ROWS_PER_TASK", limit)
    score = {r.item_idx: r.score for r in catalogue.collect()}
    order = sorted(score, key=lambda i: (score[i] is None, -(score[i] or 0.0), i))
    # User 1 has seen the first 20, twice; user 2 every other item; user 3 nothing.
    held = {1: order[:20] * 2, 2: order[::2], 3: []}
    seen = spark.createDataFrame([(u, i) for u, items in held.items() for i in items] + [(None, order[0])], "user_idx long, item_idx long")
    users = spark.createDataFrame([(u,) for u in held], "user_idx long")
    work = []
    got = unseen.first_unseen(users, head_of(catalogue), seen, 3, 200, work=work)
    want = {(u, n + 1, i) for u, items in held.items() for n, i in enumerate([x for x in order if x not in set(items)][:3])}
    assert {(r.user_idx, r.nth, r.item_idx) for r in got.collect()} == want
    assert work == lengths


@pytest.mark.parametrize("model", [Popularity, UCB])
def test_lists_bring_no_whole_log_to_a_shuffle(spark, monkeypatch, model):
    """Rows of items behind the head go by a broadcast join; with short heads as with long ones the lists are the same."""
    items = spark.range(300).select(F.col("id").alias("item_idx"), (F.col("id") + 1.0).alias("price"))
    users = spark.range(40).select(F.col("id").alias("user_idx"))
    log = spark.range(4000).select(
        (F.col("id") % 40).alias("user_idx"), (F.xxhash64("id") % 300).alias("item_idx"), (F.col("id") % 3 % 2).alias("relevance")
    )
    recs = model().fit(log).predict(log, 5, users, items)
    whole = sorted(map(tuple, recs.collect()))
    monkeypatch.setattr(unseen, "FIRST", 12)
    short = model().fit(log).predict(log, 5, users, items)
    assert sorted(map(tuple, short.collect())) == whole
    assert len(whole) == 200


def test_ranking_metrics_read_their_rows_once(spark):
    """The label join of a replay is not planned twice; positions count present rows, unknown responses come last."""
    rows = [(1, 1, 0, 0.0), (1, 3, 1, 5.0), (1, 9, 1, 2.0), (2, 1, None, None), (2, 2, 1, 3.0), (3, 9, 1, 1.0)]
    judged = spark.createDataFrame(rows, "user_idx long, rank int, response int, revenue double")
    marked = judged.groupBy("user_idx", "rank").agg(F.max("response").alias("response"), F.max("revenue").alias("revenue"))
    found = metrics.ranking_metrics(marked, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    row = found.first()
    second = 0.6309297535714575
    assert row.ndcg_at_k == pytest.approx((second + second) / 2)
    assert row.precision_at_k == pytest.approx((0.5 + 1.0) / 2)
    assert row.discounted_revenue == pytest.approx(5.0 / 2 + 3.0 * second)
    assert row.revenue == pytest.approx(11.0)


@pytest.mark.parametrize("shared,copied", [(2, 32 * 3 + 3), (100, 6)])
def test_only_shared_rankings_are_copied(spark, monkeypatch, shared, copied):
    """Users 0 to 4 ask ranking a, user 5 ranking b; copies change the work, not the lists."""
    monkeypatch.setattr(unseen, "SHARED", shared)
    users = spark.createDataFrame([(u, "a") for u in range(5)] + [(5, "b")], "user_idx long, ctx string")
    ranked = spark.createDataFrame([(c, i, n + 1) for c in "ab" for n, i in enumerate((7, 8, 9))], "ctx string, item_idx long, rank long")
    seen = spark.createDataFrame([(0, 7), (5, 8), (5, 7)], "user_idx long, item_idx long")
    rows, plain = [], unseen._spread_lookup

    def watched(picked, ranked, keys, by, hot):
        flagged = ranked.join(hot, by, "left")
        rows.append(flagged.agg(F.sum(F.when(F.col("__hot"), 32).otherwise(1))).first()[0])
        return plain(picked, ranked, keys, by, hot)

    monkeypatch.setattr(unseen, "_spread_lookup", watched)
    got = unseen.unseen_at(users, ranked, seen, 2, by=["ctx"], catalogue=3)
    want = {(0, 1, 8), (0, 2, 9), (5, 1, 9)} | {(u, n, 6 + n) for u in range(1, 5) for n in (1, 2)}
    assert {(r.user_idx, r.nth, r.item_idx) for r in got.collect()} == want
    assert rows == [copied]
