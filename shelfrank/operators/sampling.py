"""Samples that depend on row keys only, and table synthesis as Spark jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import chance
from shelfrank.functions.scalars import dot
from shelfrank.operators.ordinal import split_ordinal


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    return df.where(chance.uniform(seed, key) < fraction)


SMALL_SAMPLE = 10_000
DRAW_BUCKETS = 65_536


def sample_exact(df: DataFrame, n: int, seed: int, key: str, small: int = SMALL_SAMPLE) -> DataFrame:
    """The ``n`` rows with the smallest draws.

    A small sample keeps n rows per task and merges them. A large one counts the draws in
    equal slices of [0, 1) first: the slices before the n-th draw are taken whole, only the one
    that holds it is ordered.
    """
    drawn = df.withColumn("__u", chance.uniform(seed, key))
    if n <= small:
        return drawn.orderBy("__u", key).limit(n).drop("__u")
    drawn = drawn.withColumn("__slice", F.floor(F.col("__u") * DRAW_BUCKETS).cast("int"))
    # At most DRAW_BUCKETS counts reach the driver.
    counts = drawn.groupBy("__slice").agg(F.count(F.lit(1)).alias("n")).orderBy("__slice").collect()
    taken, last = 0, DRAW_BUCKETS
    for row in counts:
        if taken + row.n > n:
            last = row["__slice"]
            break
        taken += row.n
    whole = drawn.where(F.col("__slice") < last)
    part = drawn.where(F.col("__slice") == last).orderBy("__u", key).limit(n - taken)
    return whole.unionByName(part).drop("__u", "__slice")


def sample_by_stratum(
    df: DataFrame,
    stratum: str,
    fraction: float,
    seed: int,
    key: str,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Sample whose strata are represented by ``weights`` (their own shares by default).

    The rate of a stratum is ``int(total * fraction * weight) / size``.
    """
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("__size"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    if weights is None:
        weight = F.col("__size") / total
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col(stratum) == name, F.lit(float(share))).otherwise(weight)
    wanted = F.floor(total * F.lit(fraction) * weight + F.lit(1e-9))
    rates = sizes.select(
        stratum,
        F.when(wanted > F.col("__size"), F.raise_error(F.concat(F.lit("too few rows in "), stratum)))
        .otherwise(wanted / F.col("__size"))
        .alias("__rate"),
    )
    return df.join(rates, stratum).where(chance.uniform(seed, key) < F.col("__rate")).drop("__rate")


def label_ids(df: DataFrame, label: str, key: str) -> Column:
    return F.concat(F.lit(f"{label}_"), F.col(key).cast("string"))


def pooled(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of one shape as one table; ``origin`` names the table of each row."""
    tagged = [df.withColumn("origin", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def draw_per_origin(pool: DataFrame, quotas: dict[str, int], seed: int, key: str) -> DataFrame:
    """Exactly ``quotas[origin]`` rows of each origin, those with its smallest draws, in one pass over the pool.

    Origins without a quota give none. Too few rows of an origin are an error when the result is read.
    """
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])[F.col("origin")]
    asked = pool.where(F.col("origin").isin(list(quotas))).withColumn("__u", chance.uniform(seed, "origin", key))
    slices = F.floor(F.col("__u") * DRAW_BUCKETS)
    placed = split_ordinal(asked, ["origin"], [F.col("__u"), F.col(key)], [slices], "__place")
    sizes = pool.groupBy("origin").agg(F.count(F.lit(1)).alias("__size"))
    short = F.concat(F.lit("too few rows in "), F.col("origin"))
    checked = sizes.withColumn("__quota", F.when(quota > F.col("__size"), F.raise_error(short)).otherwise(quota))
    return placed.join(checked, "origin").where(F.col("__place") <= F.col("__quota")).select(pool.columns)


def random_catalogue_head(items: DataFrame, k: int, seed: int) -> DataFrame:
    """``k`` random items, the same for all users."""
    return sample_exact(items, k, seed, "item_idx")


def users_with_random_items(users: DataFrame, items: DataFrame, k: int, seed: int) -> DataFrame:
    """Every user with the same ``k`` random items (``k`` bounds the one gathered row)."""
    if "user_idx" not in users.columns or "item_idx" not in items.columns:
        raise ValueError("users need user_idx and items need item_idx")
    head = random_catalogue_head(items.select("item_idx"), k, seed)
    chosen = head.agg(F.sort_array(F.collect_list("item_idx")).alias("ids")).scalar()
    return users.withColumn("item_idx", F.explode(chosen))


def item_slots(items: DataFrame) -> DataFrame:
    """Items numbered 0 .. n-1 in the order of their id."""
    numbered = split_ordinal(
        items.select("item_idx"),
        [],
        [F.col("item_idx")],
        [F.floor(F.col("item_idx") / 65536)],
        "slot",
        at_most=items.count(),
    )
    return numbered.withColumn("slot", F.col("slot") - 1)


def negative_samples(log: DataFrame, items: DataFrame, seed: int) -> DataFrame:
    """One uniformly drawn item for each row of the log, kept when the user has no such pair."""
    slots = item_slots(items)
    how_many = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    draw = chance.uniform(seed, "user_idx", "item_idx", "order_id", "line_no")
    drawn = log.select(
        "user_idx",
        F.col("item_idx").alias("positive"),
        F.floor(draw * how_many).alias("slot"),
    )
    negatives = drawn.join(slots, "slot").select("user_idx", "positive", "item_idx")
    return negatives.join(
        log.select("user_idx", "item_idx").distinct(), ["user_idx", "item_idx"], "left_anti"
    )


def synthetic_items(items: DataFrame, seed: int) -> DataFrame:
    """One invented item per real item: its category is kept, the attribute is normal
    around the category's mean, the price a gamma draw (shape 5, scale 10)."""
    means = items.groupBy("category").agg(
        F.avg("item_attr_0").alias("centre"), F.stddev_pop("item_attr_0").alias("spread")
    )
    return items.join(means, "category").select(
        "item_idx",
        "category",
        (F.col("centre") + F.col("spread") * chance.normal(f"{seed}a", "item_idx")).alias("item_attr_0"),
        chance.gamma_whole_shape(f"{seed}p", 5, 10.0, "item_idx").alias("price"),
    )


def synthetic_history(log: DataFrame, users: DataFrame, items: DataFrame, seed: int) -> DataFrame:
    """As many random (user, item) pairs as the log has rows, labelled by the sign of the
    product of the user's and the item's standardised attribute, without duplicates.

    Needs dense ids from 0, which both id columns are.
    """
    n_users = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_items = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    keys = ("order_id", "line_no", "user_idx", "item_idx")
    pairs = log.select(
        F.floor(chance.uniform(f"{seed}u", *keys) * n_users).alias("user_idx"),
        F.floor(chance.uniform(f"{seed}i", *keys) * n_items).alias("item_idx"),
    ).distinct()
    user_mid = users.agg(F.avg("user_attr_0").alias("m")).scalar()
    item_mid = items.agg(F.avg("item_attr_0").alias("m")).scalar()
    user_vec = users.select("user_idx", F.array(F.col("user_attr_0") - user_mid).alias("u"))
    item_vec = items.select("item_idx", F.array(F.col("item_attr_0") - item_mid).alias("v"))
    joined = pairs.join(user_vec, "user_idx").join(item_vec, "item_idx")
    return joined.select("user_idx", "item_idx", F.when(dot("u", "v") > 0, 1).otherwise(0).alias("relevance"))
