"""Canonical recommendation tables on top of the star-schema Parquet files.

Every view projects the few columns it needs, so the Parquet scans read only those.
``interactions`` drops full-row duplicates of its lines only when asked: that is a shuffle of the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR = 1995
# Columns that order one user's interactions without ties.
SEQUENCE_KEY = ("ts", "order_id", "line_no", "item_idx", "paid")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_idx"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("user_attr_0"),
        F.col("c_nationkey").alias("nation"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_idx"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("item_attr_0"),
        F.col("p_brand").alias("brand"),
    )


def interactions(spark: SparkSession, folder: str, deduplicate: bool = False) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag"
    )
    if deduplicate:
        # Before the join: equal lines belong to one order.
        lines = lines.distinct()
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    bought = F.when(F.col("l_returnflag") != "R", 1).otherwise(0)
    year_no = F.year("o_orderdate") - F.lit(FIRST_YEAR)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_idx"),
        F.col("l_partkey").alias("item_idx"),
        bought.alias("response"),
        bought.alias("relevance"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("paid"),
        year_no.alias("iter_no"),
        iteration_label(year_no).alias("iter"),
    )


def iteration_label(iter_no: Column) -> Column:
    """``start`` for the first year, then three training years, then test years."""
    return (
        F.when(iter_no == 0, F.lit("start"))
        .when(iter_no <= 3, F.concat(F.lit("train_"), (iter_no - 1).cast("string")))
        .otherwise(F.concat(F.lit("test_"), (iter_no - 4).cast("string")))
    )


def priced_log(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions with the item's list price and the revenue of the response."""
    prices = items(spark, folder).select("item_idx", "price")
    return (
        interactions(spark, folder)
        .join(prices, "item_idx")
        .withColumn("revenue", F.col("response") * F.col("price"))
    )


def item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Item features: each part takes the embedding at its key modulo their number."""
    vectors = table(spark, folder, "embeddings")
    how_many = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    keyed = items(spark, folder).select(
        "item_idx", "price", F.pmod(F.col("item_idx"), how_many).alias("vec_id")
    )
    as_double = F.col("embedding").cast("array<double>").alias("vec")
    return keyed.join(vectors.select("vec_id", as_double), "vec_id").select("item_idx", "price", "vec")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value"
    )
