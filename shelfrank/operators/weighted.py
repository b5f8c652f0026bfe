"""Weighted sampling of items per user without replacement, on whole tables.

Drawing with replacement and skipping repeats is the same as drawing without replacement.
Draws look their item up through an equi-join on slices of the cumulated weights, so no user is
paired with the catalogue. Users who want a large part of the catalogue get
exponential keys for all items instead; that costs at most a few times their own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import chance
from shelfrank.operators.ordinal import rank_by_score, running_sums, split_ordinal
from shelfrank.session import cut_lineage

HEAVY_SHARE = 4  # wanting more than a quarter of the catalogue counts as heavy


def _slices(weights: DataFrame, slices: int) -> DataFrame:
    """Items with their interval of the cumulated probability, one row per slice it touches."""
    total = weights.agg(F.sum("weight").alias("s")).scalar()
    ends = running_sums(weights.select("item_idx", "weight"), "item_idx", ["weight"])
    bounds = ends.select(
        "item_idx",
        "weight",
        ((F.col("cum_weight") - F.col("weight")) / total).alias("lo"),
        (F.col("cum_weight") / total).alias("hi"),
    )
    first = F.floor(F.col("lo") * slices)
    last = F.least(F.floor(F.col("hi") * slices), F.lit(slices - 1))
    return bounds.withColumn("slice", F.explode(F.sequence(first, F.greatest(first, last))))


def weighted_choice(wanted: DataFrame, weights: DataFrame, seed: int) -> DataFrame:
    """``wanted`` has ``user_idx, cnt``; ``weights`` has ``item_idx, weight`` (positive).

    Returns ``user_idx, item_idx, turn``: distinct items in the order they were drawn.
    """
    n_items = weights.count()
    wanted = cut_lineage(wanted.withColumn("cnt", F.least(F.col("cnt"), F.lit(n_items))))
    heavy = wanted.where(F.col("cnt") * HEAVY_SHARE > n_items)
    open_users = wanted.where(F.col("cnt") * HEAVY_SHARE <= n_items).withColumn("done", F.lit(0).cast("long"))
    table = cut_lineage(_slices(weights, n_items))

    draws = None
    while not open_users.isEmpty():
        # Every round at least doubles the draws of the users still short, and only theirs.
        until = 2 * F.col("done") + 2 * F.col("cnt") + 8
        batch = open_users.select(
            "user_idx", F.explode(F.sequence(F.col("done") + 1, until)).alias("draw")
        ).withColumn("u", chance.fine_uniform(seed, "user_idx", "draw"))
        hit = (
            batch.withColumn("slice", F.floor(F.col("u") * n_items))
            .join(table, "slice")
            .where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
            .select("user_idx", "item_idx", "draw")
        )
        draws = hit if draws is None else draws.unionByName(hit)
        draws = cut_lineage(draws.groupBy("user_idx", "item_idx").agg(F.min("draw").alias("draw")))
        found = draws.groupBy("user_idx").agg(F.count(F.lit(1)).alias("found"))
        open_users = cut_lineage(
            open_users.join(found, "user_idx")
            .where(F.col("found") < F.col("cnt"))
            .select("user_idx", "cnt", until.alias("done"))
        )
    light = None
    if draws is not None:
        light = split_ordinal(
            draws, ["user_idx"], [F.col("draw")], [F.floor(F.col("draw") / 4096)], "turn"
        ).select("user_idx", "item_idx", "turn")
    if heavy.isEmpty():
        return light.join(wanted, "user_idx").where(F.col("turn") <= F.col("cnt")).drop("cnt")

    # Items meet the heavy users slice by slice; cnt > n/4 bounds the rows by 4 x output.
    pieces = max(64, n_items // 1024)
    spread = heavy.select(
        "user_idx", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece")
    )
    keyed = (
        weights.withColumn("piece", F.pmod(F.xxhash64("item_idx"), F.lit(pieces)).cast("int"))
        .join(spread, "piece")
        .withColumn("key", F.log(chance.fine_open_uniform(f"{seed}h", "user_idx", "item_idx")) / F.col("weight"))
    )
    ranked = rank_by_score(keyed.select("user_idx", "item_idx", "key"), ["user_idx"], "key", out="turn").select(
        "user_idx", "item_idx", "turn"
    )
    every = ranked if light is None else light.unionByName(ranked)
    return every.join(wanted, "user_idx").where(F.col("turn") <= F.col("cnt")).drop("cnt")
