"""Oversized groups: the split form equals the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.operators import sequences
from shelfrank.operators.metrics import auc_roc, rank_all
from shelfrank.operators.ordinal import (
    cut_along,
    global_rank,
    rank_by_score,
    running_sums,
    sliding_context,
    split_ordinal,
)
from shelfrank.operators.unseen import unseen_at


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def log(spark, small):
    return views.priced_log(spark, small).persist()


def test_interaction_order(log, tiny_limit):
    key = ["user_idx", *views.SEQUENCE_KEY]
    window = Window.partitionBy("user_idx").orderBy(*views.SEQUENCE_KEY)
    plain = log.select(*key, (F.row_number().over(window) - 1).cast("long").alias("ordinal"))
    assert rows(sequences.interaction_order(log).select(*key, "ordinal")) == rows(plain)


def test_rank_all(log, tiny_limit):
    ties = [F.col(c) for c in ("item_idx", "ts", "order_id", "line_no", "paid")]
    scored = log.withColumn("relevance", F.col("price"))
    window = Window.partitionBy("user_idx").orderBy(F.col("relevance").desc(), *ties)
    plain = scored.select("user_idx", "order_id", "line_no", "paid", F.row_number().over(window).cast("long"))
    split = rank_all(scored, "relevance", ties).select("user_idx", "order_id", "line_no", "paid", "rank")
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("tie_desc", [False, True])
def test_global_rank_with_one_dominating_score(spark, tiny_limit, tie_desc):
    table = spark.range(200).select(
        F.col("id").alias("item_idx"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") % 17) / 16.0).alias("s"),
    )
    tie = F.col("item_idx").desc() if tie_desc else F.col("item_idx")
    plain = table.withColumn("rank", F.row_number().over(Window.orderBy(F.col("s").desc(), tie)))
    assert rows(global_rank(table, "s", "item_idx", tie_desc=tie_desc)) == rows(plain)


def test_only_some_groups_are_large(spark, tiny_limit):
    table = spark.range(50).select(
        F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("g"), (F.col("id") * 7 % 50).alias("x")
    )
    split = split_ordinal(table, ["g"], [F.col("x")], [F.floor(F.col("x") / 10)], "n")
    plain = table.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("x")))
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    table = spark.range(1, 101).select(F.col("id").cast("double").alias("x"), (F.col("id") % 5).alias("n"))
    split = running_sums(table, "x", ["n"], descending, limit=7)
    plain = running_sums(table, "x", ["n"], descending)
    assert rows(split) == rows(plain)
    assert max(r.cum_n for r in plain.collect()) == 200


def test_auc_split_equals_plain(spark, log, monkeypatch):
    from shelfrank.operators import ordinal

    scored = log.select((F.col("paid") % 97).alias("score"), "response")
    plain = auc_roc(scored, "score", "response").first()[0]
    monkeypatch.setattr(ordinal, "ROWS_PER_TASK", 5)
    assert auc_roc(scored, "score", "response").first()[0] == pytest.approx(plain, abs=1e-12)


def test_sliding_context_crosses_stretches(spark):
    table = spark.range(1, 31).select(F.lit(1).alias("u"), F.col("id").alias("n"), (F.col("id") * 10).alias("v"))
    got = sliding_context(table, "u", "n", "v", 3, stretch=5)
    expected = [(n, [(n - 3) * 10, (n - 2) * 10, (n - 1) * 10]) for n in range(4, 31)]
    assert sorted((r.n, r.context) for r in got.collect()) == expected


@pytest.mark.parametrize("k", [1, 3, 8])
def test_unseen_equals_brute_force(spark, log, small, tiny_limit, k):
    """Small catalogue, so that some users have seen nearly all of it."""
    items = spark.range(12).select(F.col("id").alias("item_idx"))
    seen = log.select("user_idx", (F.col("item_idx") % 12).alias("item_idx"))
    users = views.users(spark, small).select("user_idx")
    ranked = items.withColumn("rank", ((F.col("item_idx") * 5) % 12 + 1).cast("long"))
    got = unseen_at(users, ranked, seen, k).select("user_idx", "item_idx", "nth")
    free = users.join(ranked, how="cross").join(seen.distinct(), ["user_idx", "item_idx"], "left_anti")
    place = Window.partitionBy("user_idx").orderBy("rank")
    plain = free.withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= k)
    assert rows(got) == rows(plain.select("user_idx", "item_idx", "nth"))


@pytest.mark.parametrize("falling", [False, True])
def test_a_group_is_cut_evenly_along_its_own_values(spark, falling):
    """One group of scores within a thousandth, with nulls and NaN, next to a group of wide range."""
    narrow = spark.range(3000).select(
        F.lit("narrow").alias("g"), "id",
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 97 == 0, F.lit(float("nan"))).otherwise(0.5 + F.col("id") / 3e6).alias("s"),
    )
    wide = spark.range(3000).select(F.lit(None).cast("string").alias("g"), "id", (F.col("id") * 1e6).alias("s"))
    table = narrow.unionByName(wide)
    cut = cut_along(table, table.select("g").distinct(), ["g"], "s", 100, falling)
    pieces = cut.groupBy("g", "__piece").agg(
        F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"), F.max("__long").alias("long")
    )
    for row in pieces.collect():
        assert row.n <= 100 or row.long and row.low == row.high, row
    assert pieces.where("g = 'narrow'").count() >= 27
    order = F.col("s").desc() if falling else F.col("s").asc()
    by_value = Window.partitionBy("g").orderBy(order, "id")
    by_piece = Window.partitionBy("g").orderBy("__piece", order, "id")
    wrong = cut.withColumn("a", F.row_number().over(by_value)).withColumn("b", F.row_number().over(by_piece))
    assert wrong.where("a <> b").count() == 0


def test_rank_with_null_groups_scores_and_one_heavy_value(spark):
    n = F.col("id")
    table = spark.range(4000).select(
        F.when(n % 4 == 0, None).otherwise(n % 4).alias("user_idx"), n.alias("item_idx"),
        F.when(n % 5 == 0, None).when(n % 7 == 0, F.lit(float("nan"))).when(n % 2 == 0, 1.0).otherwise(n / 4000).alias("s"),
    )
    order = [F.col("s").desc(), F.col("item_idx")]
    plain = table.withColumn("rank", F.row_number().over(Window.partitionBy("user_idx").orderBy(*order)))
    split = rank_by_score(table, ["user_idx"], "s", tie_block=F.floor(F.col("item_idx") / 64), limit=50)
    assert split.exceptAll(plain.withColumn("rank", F.col("rank").cast("long"))).count() == 0 and split.count() == 4000


def test_large_pieces_are_cut_again(spark, monkeypatch):
    from shelfrank.operators import ordinal

    monkeypatch.setattr(ordinal, "PIECES", 4)
    table = spark.range(500).select(F.lit(1).alias("g"), (F.col("id") * F.col("id")).alias("x"))
    cut = cut_along(table, table.select("g").limit(1), ["g"], "x", 10)
    assert cut.groupBy("__piece").count().agg(F.max("count")).first()[0] <= 10
    assert cut.where("__long").isEmpty()
