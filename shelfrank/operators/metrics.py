"""Ranking, revenue and classification metrics as one- or two-level aggregations.

Input of the ranking metrics: one row per recommended item with ``user_idx``, ``rank`` (1 is
best), ``response``, ``revenue``. Every metric returns a one-row DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.scalars import rank_discount
from shelfrank.operators.ordinal import rank_by_score, running_sums


def rank_all(df: DataFrame, score: str = "relevance", ties: list[Column] | None = None) -> DataFrame:
    """Rank every row of a user by falling score; long histories are cut by score range."""
    return rank_by_score(df, ["user_idx"], score, ties)


def _user_heads(df: DataFrame, k: int, user: list[str]) -> DataFrame:
    """Per user what the metrics at ``k`` need; at most ``k`` rows per user are ordered.

    Positions count the rows that are present, so a gap in the ranks does not matter.
    """
    by_rank = Window.partitionBy(*user).orderBy("rank")
    by_response = Window.partitionBy(*user).orderBy(F.col("response").desc(), "rank")
    placed = df.where(F.col("rank") <= k).withColumns(
        {"pos": F.row_number().over(by_rank), "ideal_pos": F.row_number().over(by_response)}
    )
    return placed.groupBy(*user).agg(
        F.avg("response").alias("p"),
        F.max(F.when(F.col("response") > 0, 1.0).otherwise(0.0)).alias("hit"),
        F.sum(F.col("response") * rank_discount("pos")).alias("dcg"),
        F.sum(F.col("response") * rank_discount("ideal_pos")).alias("idcg"),
        F.sum(F.col("revenue") * rank_discount("rank")).alias("disc"),
    )


def precision_at_k(df: DataFrame, k: int, denominator: str = "present") -> DataFrame:
    """Mean over users of the mean response in the first k (or of the sum divided by k)."""
    kept = df.where(F.col("rank") <= k)
    value = F.avg("response") if denominator == "present" else F.sum("response") / F.lit(k)
    users = kept.groupBy("user_idx").agg(value.alias("p"))
    return users.agg(F.coalesce(F.avg("p"), F.lit(0.0)).alias("precision_at_k"))


def ndcg_at_k(df: DataFrame, k: int) -> DataFrame:
    """Mean NDCG over users with any response in the first k; 0 when there are none."""
    users = _user_heads(df, k, ["user_idx"]).where(F.col("idcg") > 0)
    return users.agg(F.coalesce(F.avg(F.col("dcg") / F.col("idcg")), F.lit(0.0)).alias("ndcg_at_k"))


def mrr(df: DataFrame) -> DataFrame:
    users = df.groupBy("user_idx").agg(F.min(F.when(F.col("response") > 0, F.col("rank"))).alias("first"))
    return users.agg(F.coalesce(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))), F.lit(0.0)).alias("mrr"))


def hit_rate(df: DataFrame, k: int) -> DataFrame:
    hit = F.max(F.when(F.col("response") > 0, 1.0).otherwise(0.0))
    users = df.where(F.col("rank") <= k).groupBy("user_idx").agg(hit.alias("hit"))
    return users.agg(F.coalesce(F.avg("hit"), F.lit(0.0)).alias("hit_rate"))


def discounted_revenue(df: DataFrame, k: int) -> DataFrame:
    kept = df.where(F.col("rank") <= k)
    return kept.agg(
        F.coalesce(F.sum(F.col("revenue") * rank_discount("rank")), F.lit(0.0)).alias("discounted_revenue")
    )


def total_revenue(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"))


def conversion_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("response").alias("conversion_rate"))


def recall_at_k(df: DataFrame, k: int, relevant: DataFrame | None = None) -> DataFrame:
    """Hits in the first k divided by the user's relevant items, averaged over users with any.

    ``relevant`` (user_idx, n) defaults to the positive rows of ``df`` itself.
    """
    if relevant is None:
        relevant = df.groupBy("user_idx").agg(F.sum(F.when(F.col("response") > 0, 1).otherwise(0)).alias("n"))
    hits = (
        df.where((F.col("rank") <= k) & (F.col("response") > 0))
        .groupBy("user_idx")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    rated = relevant.where(F.col("n") > 0).join(hits, "user_idx", "left")
    return rated.agg(F.avg(F.coalesce(F.col("hits"), F.lit(0)) / F.col("n")).alias("recall_at_k"))


def ranking_metrics(df: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """All ranking metrics at once, as one row (or one row per ``by`` group)."""
    if "rank" not in df.columns:
        df = rank_all(df)
    groups = by or []
    user = [*groups, "user_idx"]
    # One pass: only the first k rows of a user are kept, as an array that is ordered in place. A user or group
    # without a name has no positions.
    inside = reduce(Column.__and__, [F.col(c).isNotNull() for c in user], F.col("rank") <= k)
    row = F.struct("rank", "response", F.col("response").isNull().alias("none"))
    every = df.groupBy(*user).agg(
        F.avg(F.when(inside, F.col("response"))).alias("p"),
        F.max(F.when(inside, F.when(F.col("response") > 0, 1.0).otherwise(0.0))).alias("hit"),
        F.sum(F.when(inside, F.col("revenue") * rank_discount("rank"))).alias("disc"),
        F.collect_list(F.when(inside, row)).alias("head"),
        F.min(F.when(F.col("response") > 0, F.col("rank"))).alias("first"),
        F.sum("revenue").alias("rev"),
        F.sum("response").alias("resp"),
        F.count(F.lit(1)).alias("rows"),
    )
    by_response = F.transform("head", lambda x: F.struct(x["none"], -x["response"], x["rank"], x["response"].alias("response")))

    def gain(rows: Column) -> Column:
        parts = F.transform(F.array_sort(rows), lambda x, at: F.coalesce(x["response"] * rank_discount(at + 1), F.lit(0.0)))
        return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)

    return (
        every.withColumns({"dcg": gain(F.col("head")), "idcg": gain(by_response)})
        .groupBy(*groups)
        .agg(
            F.coalesce(F.avg("p"), F.lit(0.0)).alias("precision_at_k"),
            F.coalesce(F.avg(F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg"))), F.lit(0.0)).alias(
                "ndcg_at_k"
            ),
            F.coalesce(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))), F.lit(0.0)).alias("mrr"),
            F.coalesce(F.avg("hit"), F.lit(0.0)).alias("hit_rate"),
            F.coalesce(F.sum("disc"), F.lit(0.0)).alias("discounted_revenue"),
            F.coalesce(F.sum("rev"), F.lit(0.0)).alias("revenue"),
            (F.sum("resp") / F.sum("rows")).alias("conversion_rate"),
        )
    )


def geometric_dcg(df: DataFrame, k: int, gamma: float) -> DataFrame:
    """Mean over users of the sum of relevance times ``gamma ** (position - 1)``."""
    window = Window.partitionBy("user_idx").orderBy("rank")
    first = df.withColumn("pos", F.row_number().over(window)).where(F.col("pos") <= k)
    users = first.groupBy("user_idx").agg(
        F.sum(F.col("relevance") * F.pow(F.lit(gamma), F.col("pos") - 1)).alias("dcg")
    )
    return users.agg(F.avg("dcg").alias("geometric_dcg"))


def regression_metrics(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """rmse, mse, r2, mae and explained variance in one scan plus one scalar mean."""
    mean = df.agg(F.avg(label).alias("m")).scalar()
    error = F.col(label) - F.col(prediction)
    centred = df.select(
        (error * error).alias("sq"),
        F.abs(error).alias("ab"),
        F.pow(F.col(label) - mean, F.lit(2.0)).alias("tot"),
        F.pow(F.col(prediction) - mean, F.lit(2.0)).alias("expl"),
    )
    return centred.agg(
        F.sqrt(F.avg("sq")).alias("rmse"),
        F.avg("sq").alias("mse"),
        (1 - F.sum("sq") / F.sum("tot")).alias("r2"),
        F.avg("ab").alias("mae"),
        F.avg("expl").alias("var"),
    )


def _curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Cumulative positives and negatives per distinct score, best score first."""
    groups = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).alias("neg"),
    )
    return running_sums(groups, "score", ["pos", "neg"], descending=True)


def auc_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve: each score group adds a trapezoid."""
    curve = _curve(df, score, label)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    return curve.agg((area / (F.sum("pos") * F.sum("neg"))).alias("auc_roc"))


def auc_pr(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under precision-recall, trapezoids from the point (0, first precision)."""
    curve = _curve(df, score, label)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    prev_pos = F.col("cum_pos") - F.col("pos")
    prev_all = prev_pos + F.col("cum_neg") - F.col("neg")
    prev_prec = F.when(prev_all > 0, prev_pos / prev_all).otherwise(prec)
    area = F.sum(F.col("pos") * (prec + prev_prec) / 2)
    return curve.agg((area / F.sum("pos")).alias("auc_pr"))


def multiclass_metrics(
    df: DataFrame, prediction: str, label: str, probability: str | None = None, metric_label: float = 0.0
) -> DataFrame:
    """The fourteen multiclass metrics from one confusion table.

    ``probability`` is the predicted probability of the true class (for the log loss).
    """
    cells = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    both = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("said")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("said")),
            )
        ).alias("m"),
        F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("right"),
        "y",
        "p",
    )
    classes = both.groupBy(F.col("m.c").alias("c")).agg(
        F.sum("m.actual").alias("actual"),
        F.sum("m.said").alias("said"),
        F.sum(F.when(F.col("y") == F.col("p"), F.col("right")).otherwise(0) / 2).alias("tp"),
    )
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    rates = classes.withColumns(
        {
            "total": total,
            "precision": F.when(F.col("said") > 0, F.col("tp") / F.col("said")).otherwise(0.0),
            "recall": F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0),
        }
    ).withColumns(
        {
            "fpr": F.when(
                F.col("total") > F.col("actual"),
                (F.col("said") - F.col("tp")) / (F.col("total") - F.col("actual")),
            ).otherwise(0.0),
            "f": F.when(
                F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
            ).otherwise(0.0),
            "w": F.col("actual") / F.col("total"),
        }
    )

    def weighted(name: str) -> Column:
        return F.sum(F.col("w") * F.col(name))

    def at_label(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("c") == metric_label, F.col(name))), F.lit(0.0))

    accuracy = F.sum("tp") / F.max("total")
    if probability is None:
        loss = F.lit(None).cast("double")
    else:
        floor = F.lit(1e-15)
        clipped = F.greatest(floor, F.least(1 - floor, F.col(probability)))
        loss = df.agg(F.avg(-F.log(clipped)).alias("loss")).scalar()
    row = rates.agg(
        weighted("f").alias("f1"),
        accuracy.alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("recall").alias("weighted_tpr"),
        weighted("fpr").alias("weighted_fpr"),
        weighted("f").alias("weighted_f_measure"),
        at_label("recall").alias("tpr_by_label"),
        at_label("fpr").alias("fpr_by_label"),
        at_label("precision").alias("precision_by_label"),
        at_label("recall").alias("recall_by_label"),
        at_label("f").alias("f_measure_by_label"),
        (1 - accuracy).alias("hamming_loss"),
    )
    return row.withColumn("log_loss", loss)


# Names a caller may pass to ``evaluate``.
REGRESSION = ("rmse", "mse", "r2", "mae", "var")
BINARY = ("areaUnderROC", "areaUnderPR")
MULTICLASS = {
    "f1": "f1",
    "accuracy": "accuracy",
    "weightedPrecision": "weighted_precision",
    "weightedRecall": "weighted_recall",
    "weightedTruePositiveRate": "weighted_tpr",
    "weightedFalsePositiveRate": "weighted_fpr",
    "weightedFMeasure": "weighted_f_measure",
    "truePositiveRateByLabel": "tpr_by_label",
    "falsePositiveRateByLabel": "fpr_by_label",
    "precisionByLabel": "precision_by_label",
    "recallByLabel": "recall_by_label",
    "fMeasureByLabel": "f_measure_by_label",
    "logLoss": "log_loss",
    "hammingLoss": "hamming_loss",
}


def evaluate(
    df: DataFrame,
    names: list[str],
    prediction: str = "relevance",
    label: str = "response",
    probability: str | None = None,
) -> DataFrame:
    """Long table (metric, value) of the named metrics; one job per family, not per metric."""
    known = {*REGRESSION, *BINARY, *MULTICLASS}
    for name in names:
        if name not in known:
            raise ValueError(f"unknown metric {name}")
    if not names:
        return df.sparkSession.createDataFrame([], "metric string, value double")
    families: list[tuple[DataFrame, dict[str, str]]] = []
    regression = {name: name for name in names if name in REGRESSION}
    if regression:
        families.append((regression_metrics(df, prediction, label), regression))
    if "areaUnderROC" in names:
        families.append((auc_roc(df, prediction, label), {"areaUnderROC": "auc_roc"}))
    if "areaUnderPR" in names:
        families.append((auc_pr(df, prediction, label), {"areaUnderPR": "auc_pr"}))
    multiclass = {name: MULTICLASS[name] for name in names if name in MULTICLASS}
    if multiclass:
        families.append((multiclass_metrics(df, prediction, label, probability), multiclass))
    result = None
    for row, columns in families:
        values = F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))
                for name, column in columns.items()
            ]
        )
        long = row.select(F.inline(values))
        result = long if result is None else result.unionByName(long)
    return result
