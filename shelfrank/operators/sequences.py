"""Ordered user histories: truncation, padding, windows, transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.operators.ordinal import sliding_context, split_ordinal, top_ranked
from shelfrank.views import SEQUENCE_KEY


def _order(descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in SEQUENCE_KEY]


def interaction_order(log: DataFrame) -> DataFrame:
    """0-based position of every interaction in its user's history."""
    numbered = split_ordinal(
        log,
        ["user_idx"],
        _order(),
        [F.to_date("ts"), F.floor(F.col("order_id") / 4096)],
        "ordinal",
    )
    return numbered.withColumn("ordinal", F.col("ordinal") - 1)


def last_n(log: DataFrame, n: int) -> DataFrame:
    """Most recent ``n`` rows of each user; ``pos`` counts 1.. from the oldest kept row.

    Map tasks drop everything but their own last ``n`` per user before the shuffle.
    """
    recent = top_ranked(log, "user_idx", _order(descending=True), n, "back")
    oldest_first = Window.partitionBy("user_idx").orderBy(F.col("back").desc())
    return recent.withColumn("pos", F.row_number().over(oldest_first))


def user_sequences(log: DataFrame, n: int) -> DataFrame:
    """The last ``n`` interactions of each user as one ordered array of structs."""
    entry = F.struct("pos", "item_idx", "response", "iter_no")
    return (
        last_n(log, n)
        .groupBy("user_idx")
        .agg(F.array_sort(F.collect_list(entry)).alias("events"))
        .withColumn("items", F.transform("events", lambda e: e.item_idx))
    )


def padded_sequences(log: DataFrame, n: int) -> DataFrame:
    """Item ids of the last ``n`` interactions, zeros in front of short histories."""
    sequences = user_sequences(log, n)
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(n) - F.size("items"))
    return sequences.select("user_idx", F.concat(padding, "items").alias("items"))


def sequence_windows(log: DataFrame, context: int) -> DataFrame:
    """Training rows (``context`` items in order, next item) over whole histories."""
    numbered = interaction_order(log).withColumn("ordinal", F.col("ordinal") + 1)
    rows = sliding_context(
        numbered.select("user_idx", "ordinal", "item_idx"), "user_idx", "ordinal", "item_idx", context
    )
    return rows.select("user_idx", "ordinal", "context", F.col("item_idx").alias("next_item"))


def transitions(recent: DataFrame) -> DataFrame:
    """Counts of (from, to) item pairs in each user's truncated history."""
    by_user = Window.partitionBy("user_idx").orderBy("pos")
    stepped = recent.select(
        "user_idx",
        F.col("item_idx").alias("from_item"),
        F.lead("item_idx").over(by_user).alias("to_item"),
    ).where(F.col("to_item").isNotNull())
    return stepped.groupBy("user_idx", "from_item", "to_item").agg(F.count(F.lit(1)).alias("cnt"))


def item_last_price(log: DataFrame) -> DataFrame:
    """Price of the latest interaction per item."""
    key = F.struct("ts", "order_id", "line_no", "user_idx", "paid")
    return log.groupBy("item_idx").agg(F.max_by("paid", key).alias("last_price"))
