"""Additive-smoothed n-gram model over purchase sequences, as long tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.operators.ordinal import top_ranked
from shelfrank.operators.sequences import last_n
from shelfrank.session import cut_lineage


def clamp_order(order: int) -> int:
    return max(1, min(3, order))


@dataclass
class NgramModel:
    """``counts`` (ctx, next_item, cnt), ``totals`` (ctx, ctx_total), ``vocabulary`` (item_idx)."""

    order: int
    alpha: float
    counts: DataFrame
    totals: DataFrame
    vocabulary: DataFrame
    recent: DataFrame

    def vocabulary_size(self) -> Column:
        return self.vocabulary.agg(F.count(F.lit(1)).alias("n")).scalar()


def _context_key(steps: list[Column]) -> Column:
    return F.concat_ws(",", *[s.cast("string") for s in steps]) if steps else F.lit("")


def purchases(log: DataFrame, max_len: int) -> DataFrame:
    return last_n(log.where(F.col("response") > 0), max_len)


def fit(log: DataFrame, order: int = 2, alpha: float = 1.0, max_len: int = 50) -> NgramModel:
    order = clamp_order(order)
    # Read by the counts, the vocabulary and the contexts, so written out once.
    recent = cut_lineage(purchases(log, max_len).select("user_idx", "item_idx", "pos"))
    by_user = Window.partitionBy("user_idx").orderBy("pos")
    steps = [F.lag("item_idx", back).over(by_user) for back in range(order - 1, 0, -1)]
    oldest = F.lag("item_idx", order - 1).over(by_user) if order > 1 else F.lit(0)
    grams = recent.select(
        _context_key(steps).alias("ctx"), F.col("item_idx").alias("next_item"), oldest.alias("oldest")
    ).where(F.col("oldest").isNotNull())
    counts = grams.groupBy("ctx", "next_item").agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy("ctx").agg(F.sum("cnt").alias("ctx_total"))
    vocabulary = recent.select("item_idx").distinct()
    return NgramModel(order, alpha, counts, totals, vocabulary, recent)


def user_contexts(model: NgramModel, users: DataFrame) -> DataFrame:
    """(user_idx, ctx) for users whose history is long enough for the model's order."""
    if model.order == 1:
        return users.select("user_idx", F.lit("").alias("ctx"))
    needed = model.order - 1
    tail = top_ranked(model.recent, "user_idx", [F.col("pos").desc()], needed, "from_end")
    ordered = tail.groupBy("user_idx").agg(
        F.array_sort(F.collect_list(F.struct("pos", "item_idx"))).alias("tail")
    )
    known = ordered.join(users.select("user_idx"), "user_idx", "left_semi")
    return known.where(F.size("tail") == needed).select(
        "user_idx", F.array_join(F.transform("tail", lambda e: e.item_idx.cast("string")), ",").alias("ctx")
    )


def observed_probabilities(model: NgramModel) -> DataFrame:
    """Smoothed probability of every observed (context, next item)."""
    size = model.vocabulary_size()
    joined = model.counts.join(model.totals, "ctx")
    return joined.withColumn(
        "probability",
        (F.col("cnt") + model.alpha) / (F.col("ctx_total") + F.lit(model.alpha) * size),
    )


def unobserved_probability(model: NgramModel, contexts: DataFrame) -> DataFrame:
    """Probability each context gives to an item that never followed it."""
    size = model.vocabulary_size()
    return contexts.join(model.totals, "ctx", "left").withColumn(
        "unseen_probability",
        F.lit(model.alpha) / (F.coalesce(F.col("ctx_total"), F.lit(0)) + F.lit(model.alpha) * size),
    )
