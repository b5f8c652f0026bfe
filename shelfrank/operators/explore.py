"""Descriptive tables over users, items and interactions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_share(df: DataFrame, column: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("percentage", F.col("count") * 100.0 / total)


def interaction_density(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row of sizes, coverage and density."""
    n_users = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_items = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    # Two plain aggregations instead of one with two count(distinct): no row expansion.
    active_users = log.select("user_idx").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    active_items = log.select("item_idx").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    sizes = log.agg(F.count(F.lit(1)).alias("n_interactions")).withColumns(
        {"n_users": n_users, "n_items": n_items, "active_users": active_users, "active_items": active_items}
    )
    return sizes.withColumns(
        {
            "density": F.col("n_interactions") / (F.col("n_users").cast("double") * F.col("n_items")),
            "active_user_pct": F.col("active_users") * 100.0 / F.col("n_users"),
            "active_item_pct": F.col("active_items") * 100.0 / F.col("n_items"),
        }
    )


def candidate_counts(users: DataFrame, items: DataFrame, log: DataFrame) -> DataFrame:
    """Items each user has not met; users with no candidate are left out."""
    total = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    known = log.select("user_idx", "item_idx").distinct().join(items.select("item_idx"), "item_idx", "left_semi")
    met = known.groupBy("user_idx").agg(F.count(F.lit(1)).alias("met"))
    return (
        users.select("user_idx")
        .join(met, "user_idx", "left")
        .select("user_idx", (total - F.coalesce(F.col("met"), F.lit(0))).alias("candidates"))
        .where(F.col("candidates") > 0)
    )


def counts_per(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("interactions"))


def value_distribution(log: DataFrame, column: str) -> DataFrame:
    return log.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def segment_category_pivot(
    log: DataFrame, users: DataFrame, items: DataFrame, categories: list[str]
) -> DataFrame:
    """Interactions per user segment and item category.

    Both dimensions are joined first; each task then sends one row per (segment, category).
    """
    joined = (
        log.select("user_idx", "item_idx")
        .join(items.select("item_idx", "category"), "item_idx")
        .join(users.select("user_idx", "segment"), "user_idx")
    )
    return joined.groupBy("segment").pivot("category", categories).agg(F.count(F.lit(1))).fillna(0)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lower triangle of the correlation matrix in long form, from one scan."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.inline(entries))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts in equal-width bins over the column's whole range (last bin right-closed)."""
    # Both ends from one scan.
    ends = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("ends")).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    ranged = df.select(*([by] if by else []), F.col(column).alias("x"), lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.least(F.lit(bins - 1).cast("long"), F.floor((F.col("x") - F.col("lo")) / width))
    keys = [by] if by else []
    return ranged.groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
