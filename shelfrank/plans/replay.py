"""Offline evaluation: recommendations replayed against later iterations of the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.operators.explore import correlations
from shelfrank.operators.metrics import ranking_metrics
from shelfrank.operators.ordinal import ranked_head
from shelfrank.operators.unseen import first_unseen
from shelfrank.plans.recommenders import Recommender
from shelfrank.session import cut_lineage

METRICS = [
    "precision_at_k",
    "ndcg_at_k",
    "mrr",
    "hit_rate",
    "discounted_revenue",
    "revenue",
    "conversion_rate",
]


def bought_pairs(log: DataFrame) -> DataFrame:
    """(user, item) pairs with a positive response."""
    return log.where(F.col("response") > 0).select("user_idx", "item_idx").distinct()


def label(recs: DataFrame, bought: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``response`` (1 when the pair was bought) and ``revenue``."""
    marked = bought.withColumn("__hit", F.lit(1))
    return (
        recs.join(marked, keys, "left")
        .withColumn("response", F.coalesce(F.col("__hit"), F.lit(0)))
        .withColumn("revenue", F.col("response") * F.col("price"))
        .drop("__hit")
    )


def enrich(recs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Recommendations with user and item features; each feature column appears once."""
    user_part = users.select("user_idx", *[c for c in users.columns if c not in recs.columns])
    taken = set(recs.columns) | set(user_part.columns)
    item_part = items.select("item_idx", *[c for c in items.columns if c not in taken])
    return recs.join(user_part, "user_idx", "left").join(item_part, "item_idx", "left")


def replay_step(
    recommender: Recommender, log: DataFrame, users: DataFrame, items: DataFrame, k: int, last_train: int
) -> DataFrame:
    """Fit up to an iteration, recommend, label by what was bought later; one metrics row."""
    train = log.where(F.col("iter_no") <= last_train)
    later = log.where(F.col("iter_no") > last_train)
    recs = recommender.fit(train, users, items).predict(train, k, users, items)
    return ranking_metrics(label(recs, bought_pairs(later), ["user_idx", "item_idx"]), k)


def prequential_popularity(
    log: DataFrame,
    users: DataFrame,
    items: DataFrame,
    k: int,
    alpha: float,
    iterations: int,
    frozen_from: int | None = None,
) -> DataFrame:
    """Metrics per iteration of a popularity model fitted on all earlier ones.

    All iterations form one plan: the log is counted once per (item, iteration) and each
    iteration's model is the sum of the earlier counts. From ``frozen_from`` on the model is no
    longer refitted; the seen filter still grows.
    """
    log = cut_lineage(log.select("user_idx", "item_idx", "relevance", "response", "iter_no"))
    rounds = F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("round")
    counts = log.groupBy("item_idx", "iter_no").agg(
        F.sum("relevance").alias("pos"), F.count(F.lit(1)).alias("total")
    )
    model_of = F.col("round") if frozen_from is None else F.least("round", F.lit(frozen_from))
    earlier = (
        counts.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(iterations))))
        .where(F.col("iter_no") < model_of)
        .groupBy("round", "item_idx")
        .agg(((F.sum("pos") + alpha) / (F.sum("total") + 2 * alpha)).alias("relevance"))
    )
    scored = (
        items.select("item_idx", "price", rounds)
        .join(earlier, ["round", "item_idx"], "left")
        .withColumn("relevance", F.round(F.coalesce(F.col("relevance"), F.lit(0.5)), 9))
    )
    size = items.count()

    def head_of(n: int) -> DataFrame:
        block = F.floor(F.col("item_idx") / 4096)
        return ranked_head(scored, ["round"], "relevance", [F.col("item_idx")], block, n, at_most=size)

    # Repeated for the rounds row by row; what is not in the heads goes before any shuffle.
    seen = log.where(F.col("iter_no") < iterations).select(
        "user_idx",
        "item_idx",
        F.explode(F.sequence(F.col("iter_no") + 1, F.lit(iterations))).alias("round"),
    )
    asked = users.select("user_idx", rounds)
    recs = first_unseen(asked, head_of, seen, k, size, by=["round"], who=["round", "user_idx"])
    bought = (
        log.where(F.col("response") > 0)
        .select("user_idx", "item_idx", F.col("iter_no").alias("round"))
        .distinct()
    )
    labelled = label(recs.withColumnRenamed("nth", "rank"), bought, ["round", "user_idx", "item_idx"])
    return ranking_metrics(labelled, k, ["round"])


def phase_of(iter_no: Column, last_train: int) -> Column:
    return F.when(iter_no <= last_train, F.lit("train")).otherwise(F.lit("test"))


def schedule(last_train: int, iterations: int, refit: bool) -> list[tuple[str, int, int, int]]:
    """``(phase, fitted until, first and last iteration judged)`` of every fit.

    With ``refit`` each training iteration is judged by models that know all iterations before it."""
    test = ("test", last_train, last_train + 1, iterations)
    if refit:
        return [*(("train", i - 1, i, i) for i in range(1, last_train + 1)), test]
    return [("train", 0, 1, last_train), test]


def compare(
    recommenders: dict[str, Recommender],
    log: DataFrame,
    users: DataFrame,
    items: DataFrame,
    k: int,
    last_train: int,
    iterations: int,
    refit: bool = False,
) -> DataFrame:
    """Long table (name, phase, iter_no, metric, value).

    Train phase: fitted on the start iteration, judged on the training ones; with ``refit`` fitted anew before
    each of them on all rows so far. Test phase: fitted
    on all training iterations, judged on the later ones. The name is a column of the
    recommendations, and one aggregation evaluates all of them.
    """
    log = cut_lineage(log.select("user_idx", "item_idx", "relevance", "response", "iter_no"))
    tagged = None
    for phase, fitted_until, first, last in schedule(last_train, iterations, refit):
        known = log.where(F.col("iter_no") <= fitted_until)
        for name, recommender in recommenders.items():
            recs = (
                recommender.fit(known, users, items)
                .predict(known, k, users, items)
                .select(
                    F.lit(name).alias("name"),
                    F.lit(phase).alias("phase"),
                    "user_idx",
                    "item_idx",
                    "price",
                    "rank",
                    F.lit(first).alias("first"),
                    F.lit(last).alias("last"),
                )
            )
            tagged = recs if tagged is None else tagged.unionByName(recs)
    # The metrics read the lists twice: write them once, before they are repeated for every iteration.
    every = F.explode(F.sequence("first", "last")).alias("iter_no")
    tagged = cut_lineage(tagged).select("name", "phase", "user_idx", "item_idx", "price", "rank", every)
    bought = log.where(F.col("response") > 0).select("user_idx", "item_idx", "iter_no").distinct()
    labelled = label(tagged, bought, ["user_idx", "item_idx", "iter_no"])
    wide = ranking_metrics(labelled, k, ["name", "phase", "iter_no"])
    return wide.unpivot(["name", "phase", "iter_no"], METRICS, "metric", "value")


def phase_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("name", "phase", "metric").agg(
        F.avg("value").alias("mean_value"), F.sum("value").alias("total_value")
    )


def performance_change(metrics: DataFrame) -> DataFrame:
    """Percent change of the mean test revenue over the mean train revenue."""
    revenue = metrics.where(F.col("metric") == "revenue")

    def mean_of(phase: str) -> Column:
        return F.avg(F.when(F.col("phase") == phase, F.col("value")))

    means = revenue.groupBy("name").agg(mean_of("train").alias("train_mean"), mean_of("test").alias("test_mean"))
    change = (F.col("test_mean") - F.col("train_mean")) / F.col("train_mean") * 100.0
    return means.withColumn("change_pct", F.when(F.col("train_mean") > 0, change).otherwise(0.0))


def metric_correlation(metrics: DataFrame) -> DataFrame:
    """Correlation of every pair of metrics over (name, phase, iteration)."""
    wide = metrics.groupBy("name", "phase", "iter_no").pivot("metric", METRICS).agg(F.first("value"))
    return correlations(wide, METRICS)


def revenue_trajectory(metrics: DataFrame) -> DataFrame:
    """Revenue per iteration with its running total, per recommender."""
    # One row per iteration: the window holds as many rows as there are iterations.
    so_far = Window.partitionBy("name").orderBy("iter_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        metrics.where(F.col("metric") == "revenue")
        .select("name", "phase", "iter_no", F.col("value").alias("revenue"))
        .withColumn("cumulative_revenue", F.sum("revenue").over(so_far))
    )


def leaderboard(metrics: DataFrame, phase: str = "test") -> DataFrame:
    """Recommenders by falling total revenue of a phase."""
    totals = (
        metrics.where((F.col("metric") == "revenue") & (F.col("phase") == phase))
        .groupBy("name")
        .agg(F.round(F.sum("value"), 6).alias("total_revenue"))
    )
    # One row per recommender reaches this window.
    place = Window.orderBy(F.col("total_revenue").desc(), F.col("name"))
    return totals.withColumn("place", F.row_number().over(place))


def best_recommender(metrics: DataFrame, phase: str = "test") -> DataFrame:
    board = leaderboard(metrics, phase)
    return board.where(F.col("place") == 1).select("name", "total_revenue")


def run_iterations(
    recommender: Recommender,
    log_store,
    log: DataFrame,
    users: DataFrame,
    items: DataFrame,
    k: int,
    iterations: list[tuple[int, str]],
    retrain: bool = True,
) -> DataFrame:
    """Iteration loop over a stored log: refit on the earlier iterations, recommend, label,
    append the labelled recommendations under the iteration's label, measure.

    Each iteration is a set of Spark jobs; only the metrics rows are gathered into one table.
    """
    measured = None
    fitted = False
    for number, name in iterations:
        known = log.where(F.col("iter_no") < number)
        if retrain or not fitted:
            recommender.fit(known, users, items)
            fitted = True
        recs = recommender.predict(known, k, users, items)
        bought = bought_pairs(log.where(F.col("iter_no") == number))
        labelled = cut_lineage(label(recs, bought, ["user_idx", "item_idx"]))
        log_store.replace(
            labelled.select(
                "user_idx",
                "item_idx",
                F.col("relevance").cast("double").alias("relevance"),
                F.col("response").cast("int").alias("response"),
                F.col("price").cast("double").alias("price"),
                F.col("revenue").cast("double").alias("revenue"),
                F.lit(number).cast("int").alias("iter_no"),
                F.lit(name).alias("iter"),
            )
        )
        row = ranking_metrics(labelled, k).withColumn("iter", F.lit(name))
        measured = row if measured is None else measured.unionByName(row)
    return measured

