"""Hand-worked answers on tiny tables, and edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from shelfrank.functions import scalars
from shelfrank.operators import graph, metrics, ngram
from shelfrank.operators.distances import kl_divergence, ks_statistic
from shelfrank.plans.recommenders import UCB, Popularity


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(1, 1, 0, 10.0), (1, 2, 1, 20.0), (2, 1, 0, 5.0)]
    return spark.createDataFrame(rows, "user_idx long, rank int, response int, price double").withColumn(
        "revenue", F.col("response") * F.col("price")
    )


def one(df):
    return df.first()[0]


def test_ranking_metrics(judged):
    assert one(metrics.precision_at_k(judged, 2)) == pytest.approx(0.25)
    assert one(metrics.precision_at_k(judged, 2, "k")) == pytest.approx(0.25)
    assert one(metrics.hit_rate(judged, 2)) == pytest.approx(0.5)
    assert one(metrics.mrr(judged)) == pytest.approx(0.25)
    assert one(metrics.ndcg_at_k(judged, 2)) == pytest.approx(1 / math.log2(3))
    assert one(metrics.discounted_revenue(judged, 2)) == pytest.approx(20 / math.log2(3))
    assert one(metrics.recall_at_k(judged, 2)) == pytest.approx(1.0)


def test_all_at_once_agrees(judged):
    row = metrics.ranking_metrics(judged, 2).first().asDict()
    assert row["precision_at_k"] == pytest.approx(0.25)
    assert row["ndcg_at_k"] == pytest.approx(1 / math.log2(3))
    assert row["mrr"] == pytest.approx(0.25)
    assert row["hit_rate"] == pytest.approx(0.5)
    assert row["discounted_revenue"] == pytest.approx(20 / math.log2(3))
    assert row["conversion_rate"] == pytest.approx(1 / 3)


def test_no_response_gives_zeros(judged):
    none = judged.withColumns({"response": F.lit(0), "revenue": F.lit(0.0)})
    row = metrics.ranking_metrics(none, 2).first().asDict()
    assert set(row.values()) == {0.0}
    assert one(metrics.ndcg_at_k(none, 2)) == 0.0


def test_rank_is_added_when_missing(judged):
    scored = judged.drop("rank").withColumns({"relevance": F.col("price"), "item_idx": F.col("price").cast("long")})
    assert metrics.ranking_metrics(scored, 2).first().mrr == pytest.approx(0.5)


def test_geometric_dcg(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (1, 3, 1.0)], "user_idx long, rank int, relevance double")
    assert one(metrics.geometric_dcg(rows, 2, 0.85)) == pytest.approx(1.85)


@pytest.fixture(scope="module")
def tiny_log(spark):
    return spark.createDataFrame(
        [(1, 1, 1), (2, 1, 1), (3, 1, 0), (1, 2, 0)], "user_idx long, item_idx long, relevance int"
    )


def test_popularity_and_ucb(spark, tiny_log):
    items = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0)], "item_idx long, price double")
    popular = {r.item_idx: r.relevance for r in Popularity(1.0).fit(tiny_log).ranked(items).collect()}
    assert popular == pytest.approx({1: 0.6, 2: 1 / 3, 3: 0.5}, abs=1e-8)
    bandit = {r.item_idx: r.relevance for r in UCB(2.0).fit(tiny_log).scores(items).collect()}
    assert bandit == pytest.approx({1: 1.49922, 2: 1.44203, 3: 2.44203}, abs=1e-5)


def test_ngram_probabilities(spark):
    rows = [(1, item, pos) for pos, item in enumerate("abab")] + [(2, item, pos) for pos, item in enumerate("ac")]
    ids = {"a": 1, "b": 2, "c": 3}
    log = spark.createDataFrame([(u, ids[i], p) for u, i, p in rows], "user_idx long, item_idx long, line_no int")
    log = log.withColumns(
        {"response": F.lit(1), "ts": F.lit(0), "order_id": F.lit(0), "paid": F.lit(0.0), "iter_no": F.lit(0)}
    )
    model = ngram.fit(log, 2, 1.0)
    seen = {(r.ctx, r.next_item): r.probability for r in ngram.observed_probabilities(model).collect()}
    assert seen[("1", 2)] == pytest.approx(0.5)
    assert seen[("1", 3)] == pytest.approx(1 / 3)
    contexts = spark.createDataFrame([(9, "1")], "user_idx long, ctx string")
    assert ngram.unobserved_probability(model, contexts).first().unseen_probability == pytest.approx(1 / 6)


@pytest.mark.parametrize("order, clamped", [(0, 1), (1, 1), (3, 3), (7, 3)])
def test_ngram_order_is_clamped(order, clamped):
    assert ngram.clamp_order(order) == clamped


def test_cosine_and_angular(spark):
    pairs = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    got = pairs.select(scalars.cosine("a", "b"), scalars.angular("a", "b")).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.5), (0.0, 0.0)]


def test_missing_vector_has_cosine_zero(spark):
    one_row = spark.createDataFrame([([1.0],)], "a array<double>").withColumn("b", F.lit(None).cast("array<double>"))
    assert one_row.select(scalars.cosine("a", "b")).first()[0] == 0.0


def test_edge_weight(spark):
    edges = spark.createDataFrame([(1, 10), (10, 1), (2, 10), (10, 2)], "src long, dst long")
    weights = {(r.src, r.dst): r.weight for r in graph.normalised_edges(edges).collect()}
    assert weights[(1, 10)] == pytest.approx(1 / math.sqrt(6))
    assert weights[(1, 1)] == pytest.approx(0.5)


def test_ks(spark):
    table = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)], "p double, y double")
    assert one(ks_statistic(table, "p", "y")) == pytest.approx(1 / 3)


def test_kl_of_equal_columns_is_one(spark):
    table = spark.range(50).select(F.col("id").cast("double").alias("p"), F.col("id").cast("double").alias("y"))
    assert one(kl_divergence(table, "p", "y")) == pytest.approx(1.0)


def test_iteration_ordinals(spark):
    labels = spark.createDataFrame([("start",), ("train_0",), ("train_10",), ("test_2",), ("7",), ("odd",)], "l string")
    got = {r.l: r.o for r in labels.withColumn("o", scalars.iteration_ordinal("l")).collect()}
    assert got == {"start": 0, "train_0": 1, "train_10": 11, "test_2": 102, "7": 7, "odd": 0}


def test_evaluators_of_mllib_agree(spark):
    from pyspark.ml.evaluation import (
        BinaryClassificationEvaluator,
        MulticlassClassificationEvaluator,
        RegressionEvaluator,
    )

    table = spark.range(300).select(
        ((F.col("id") * 37 % 100) / 100.0).alias("p"),
        (F.col("id") * 53 % 7 % 2).cast("double").alias("y"),
    )
    table = table.withColumn("said", F.when(F.col("p") > 0.4, 1.0).otherwise(0.0))
    row = metrics.regression_metrics(table, "p", "y").first()
    for name in ("rmse", "mse", "r2", "mae", "var"):
        theirs = RegressionEvaluator(predictionCol="p", labelCol="y", metricName=name).evaluate(table)
        assert row[name] == pytest.approx(theirs, abs=1e-9)
    binary = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert one(metrics.auc_roc(table, "p", "y")) == pytest.approx(
        binary.setMetricName("areaUnderROC").evaluate(table)
    )
    assert one(metrics.auc_pr(table, "p", "y")) == pytest.approx(binary.setMetricName("areaUnderPR").evaluate(table))
    row = metrics.multiclass_metrics(table, "said", "y").first()
    theirs = MulticlassClassificationEvaluator(predictionCol="said", labelCol="y", metricLabel=0.0)
    for name, ours in metrics.MULTICLASS.items():
        if name != "logLoss":
            assert row[ours] == pytest.approx(theirs.setMetricName(name).evaluate(table), abs=1e-9), name


def test_unknown_metric(judged):
    with pytest.raises(ValueError):
        metrics.evaluate(judged, ["speed"])


def test_evaluate_many(judged):
    scored = judged.withColumn("relevance", F.col("rank").cast("double"))
    wanted = ["rmse", "areaUnderROC", "areaUnderPR", "accuracy", "f1", "mae"]
    got = {r.metric: r.value for r in metrics.evaluate(scored, wanted).collect()}
    assert set(got) == set(wanted)
    assert got["mae"] == pytest.approx(1.0) and got["areaUnderROC"] == pytest.approx(1.0)
    assert metrics.evaluate(scored, []).count() == 0
