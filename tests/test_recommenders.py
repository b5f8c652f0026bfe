"""Properties of the recommenders, their edge cases, and independence of partitioning."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.config import NotFittedError
from shelfrank.operators.blocks import block_top_k
from shelfrank.operators.weighted import weighted_choice
from shelfrank.plans import recommenders as r
from shelfrank.plans.replay import compare, leaderboard, run_iterations
from shelfrank.sources.tables import IterationLog


@pytest.fixture(scope="module")
def world(spark, small):
    log = views.interactions(spark, small).where(F.col("iter_no") <= 3).persist()
    return log, views.users(spark, small), views.items(spark, small)


def recs_of(made):
    return sorted((x.user_idx, x["rank"], x.item_idx, round(x.relevance, 6)) for x in made.collect())


MODELS = {
    "random": lambda: r.Random(),
    "popularity": lambda: r.Popularity(),
    "ucb": lambda: r.UCB(),
    "knn_pattern": lambda: r.SequenceKnn("pattern"),
    "ngram_1": lambda: r.Ngram(1),
    "ngram_3": lambda: r.Ngram(3),
    "als": lambda: r.Als(),
}


@pytest.mark.parametrize("name", sorted(MODELS))
def test_at_most_k_unseen_items_in_order(world, name):
    log, users, items = world
    made = MODELS[name]().fit(log, users, items).predict(log, 4, users, items).persist()
    assert made.columns == r.RECS
    assert made.join(log, ["user_idx", "item_idx"], "left_semi").count() == 0
    per_user = made.groupBy("user_idx").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.countDistinct("item_idx").alias("d")
    )
    assert per_user.count() == users.count()
    assert per_user.where("n > 4 OR n <> last OR d <> n").count() == 0


@pytest.mark.parametrize("name", ["random", "popularity"])
def test_same_rows_for_any_partitioning(spark, world, name):
    log, users, items = world
    first = recs_of(MODELS[name]().fit(log).predict(log, 3, users, items))
    spread = log.repartition(13, "item_idx")
    assert recs_of(MODELS[name]().fit(spread).predict(spread, 3, users.repartition(5), items)) == first


def test_k_above_the_catalogue_gives_all_unseen_items(spark, world):
    log, users, items = world
    few = items.where(F.col("item_idx") < 6)
    some = log.where(F.col("item_idx") < 6).select("user_idx", "item_idx", "relevance")
    seen = some.distinct().groupBy("user_idx").agg(F.countDistinct("item_idx").alias("n"))
    expected = users.count() * 6 - (seen.agg(F.sum("n")).first()[0] or 0)
    for model in (r.Popularity(), r.Random()):
        made = model.fit(some).predict(some, 9, users, few)
        assert made.count() == expected


def test_cold_user_gets_popular_items(spark, world):
    log, users, items = world
    stranger = spark.createDataFrame([(10**6, "BUILDING", 0.0, 1)], users.schema)
    both = users.limit(3).unionByName(stranger)
    made = r.Ngram(2).fit(log).predict(log, 3, both, items)
    popular = r.Popularity().fit(log).predict(log, 3, both, items)
    mine = [x for x in recs_of(made) if x[0] == 10**6]
    assert mine == [x for x in recs_of(popular) if x[0] == 10**6] and len(mine) == 3


def test_unfitted(world):
    log, users, items = world
    for model in (r.UCB(), r.Ngram(), r.Als(), r.WalkEmbedding()):
        with pytest.raises(NotFittedError):
            model.predict(log, 3, users, items)
    assert {x.relevance for x in r.Popularity().predict(None, 2, users, items).collect()} == {0.5}


def test_ties_go_to_the_smaller_item(world):
    log, users, items = world
    made = r.Popularity().predict(None, 2, users, items)
    assert {(x["rank"], x.item_idx) for x in made.collect()} == {(1, 0), (2, 1)}


def test_random_is_uniform(spark):
    users = spark.range(4000).select(F.col("id").alias("user_idx"))
    items = spark.range(10).select(F.col("id").alias("item_idx"), F.lit(1.0).alias("price"))
    seen = users.select("user_idx", F.lit(9).cast("long").alias("item_idx"))
    made = r.Random(seed=5).predict(seen, 3, users, items)
    counts = {x.item_idx: x["count"] for x in made.groupBy("item_idx").count().collect()}
    assert 9 not in counts and sum(counts.values()) == 12000
    expected = 12000 / 9
    assert sum((n - expected) ** 2 / expected for n in counts.values()) < 26  # 8 degrees of freedom


@pytest.mark.parametrize("block", [7, 1000])
def test_block_top_k_equals_brute_force(spark, block):
    users = spark.range(23).select(
        F.col("id").alias("user_idx"), F.array(F.sin("id"), F.cos(F.col("id") * 2)).alias("vec")
    )
    items = spark.range(31).select(
        F.col("id").alias("item_idx"),
        F.array(F.cos("id"), F.sin(F.col("id") * 3)).alias("vec"),
        (F.col("id") % 4 + 1.0).alias("price"),
    )
    seen = users.select("user_idx", F.explode(F.array(F.col("user_idx") % 31, F.lit(999).cast("long"))).alias("item_idx"))
    got = block_top_k(users, items, seen, 4, "sigmoid_dot_price", block=block)
    product = F.expr("aggregate(zip_with(u.vec, i.vec, (x, y) -> x * y), 0D, (t, x) -> t + x)")
    score = F.round(F.expr("price") / (1 + F.exp(-product)), 9)
    pairs = users.alias("u").join(items.alias("i"), how="cross").select("user_idx", "item_idx", score.alias("s"))
    free = pairs.join(seen, ["user_idx", "item_idx"], "left_anti")
    place = Window.partitionBy("user_idx").orderBy(F.col("s").desc(), "item_idx")
    plain = free.withColumn("rank", F.row_number().over(place)).where("rank <= 4")
    want = sorted((x.user_idx, x["rank"], x.item_idx, round(x.s, 6)) for x in plain.collect())
    assert recs_of(got) == want


def test_weighted_choice(spark):
    weights = spark.range(8).select(F.col("id").alias("item_idx"), (F.col("id") + 1.0).alias("weight"))
    wanted = spark.range(3000).select(
        F.col("id").alias("user_idx"), F.when(F.col("id") < 2000, 2).otherwise(7).cast("long").alias("cnt")
    )
    made = weighted_choice(wanted, weights, 3).persist()
    sizes = made.groupBy("user_idx").agg(F.count("*").alias("n"), F.countDistinct("item_idx").alias("d"))
    assert sizes.join(wanted, "user_idx").where("n <> cnt OR d <> cnt").count() == 0
    for light in (True, False):
        first = made.where((F.col("user_idx") < 2000) == light).where("turn = 1")
        total = first.count()
        counts = {x.item_idx: x["count"] for x in first.groupBy("item_idx").count().collect()}
        spread = sum((counts.get(i, 0) - total * (i + 1) / 36) ** 2 / (total * (i + 1) / 36) for i in range(8))
        assert spread < 25  # 7 degrees of freedom


def test_ngram_equals_brute_force_for_every_user(world):
    log, users, items = world
    model = r.Ngram(1).fit(log)
    made = {(x.user_idx, x["rank"]): x.item_idx for x in model.predict(log, 5, users, items).collect()}
    rows = model.model.recent.collect()
    counts, price = {}, {x.item_idx: x.price for x in items.collect()}
    for x in rows:
        counts[x.item_idx] = counts.get(x.item_idx, 0) + 1
    size, total = len(counts), len(rows)
    seen = {}
    for x in log.select("user_idx", "item_idx").collect():
        seen.setdefault(x.user_idx, set()).add(x.item_idx)
    for x in users.select("user_idx").collect():
        free = [i for i in counts if i not in seen.get(x.user_idx, set())]
        best = sorted(free, key=lambda i: (-round((counts[i] + 1) / (total + size) * price[i], 9), i))[:5]
        assert [made[(x.user_idx, n)] for n in range(1, 6)] == best


def test_walks_follow_edges(spark, world):
    from shelfrank.operators import graph

    log, *_ = world
    edges = graph.edges(log.limit(300)).persist()
    have = {(x.src, x.dst) for x in edges.collect()}
    walks = graph.random_walks(edges, 5, 2, 1).collect()
    assert len(walks) == 2 * len({a for a, _ in have})
    assert all(step in have for w in walks for step in zip(w.path, w.path[1:]))


def test_iteration_run_and_comparison(spark, small, world, tmp_path):
    _, users, items = world
    log = views.interactions(spark, small)
    store = IterationLog(spark, str(tmp_path / "log"))
    measured = run_iterations(r.Popularity(), store, log, users, items, 3, [(1, "train_0"), (2, "train_1")])
    assert {x.iter for x in measured.collect()} == {"train_0", "train_1"}
    assert store.read(["train_1"]).count() == users.count() * 3
    table = compare({"popularity": r.Popularity(), "ucb": r.UCB()}, log, users, items, 3, 3, 6)
    board = leaderboard(table).orderBy("place").collect()
    assert [x.place for x in board] == [1, 2] and board[0].total_revenue >= board[1].total_revenue
    assert all(math.isfinite(x.value) for x in table.collect())
