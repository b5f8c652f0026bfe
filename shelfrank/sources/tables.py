"""Parquet tables, the iteration-partitioned log, and saved model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.sources.schema import LOG_SCHEMA, check_conforms


def save_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def save_model(tables: dict[str, DataFrame], parameters: dict, folder: str) -> None:
    """A fitted model is its tables plus a one-row table of parameters."""
    save_tables(tables, folder)
    some = next(iter(tables.values())).sparkSession
    row = some.range(1).select(*[F.lit(value).alias(name) for name, value in parameters.items()])
    row.write.mode("overwrite").parquet(f"{folder}/parameters")


def load_model(spark: SparkSession, folder: str, names: list[str]) -> tuple[dict[str, DataFrame], dict]:
    parameters = spark.read.parquet(f"{folder}/parameters").first().asDict()
    return load_tables(spark, folder, names), parameters


class IterationLog:
    """Append-only log, one partition directory per iteration label.

    The schema is declared, so the label stays a string whatever the directories are called.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType = LOG_SCHEMA):
        self.spark, self.folder, self.schema = spark, folder, schema

    def append(self, df: DataFrame) -> None:
        """Add rows; their ``iter`` column names the partition.

        Rows are gathered by label first, so a write makes few files per partition; what a
        label holds beyond one file's size is split over tasks by size.
        """
        check_conforms(df, self.schema)
        df.hint("rebalance", "iter").write.mode("append").partitionBy("iter").parquet(self.folder)

    def replace(self, df: DataFrame) -> None:
        """Overwrite only the partitions present in ``df``; safe to repeat after a failure."""
        check_conforms(df, self.schema)
        (
            df.hint("rebalance", "iter")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("iter")
            .parquet(self.folder)
        )

    def clear(self) -> None:
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.folder)

    def read(self, labels: list[str] | None = None) -> DataFrame:
        df = self.spark.read.schema(self.schema).parquet(self.folder)
        return df.where(F.col("iter").isin(labels)) if labels is not None else df

    def for_users(self, users: DataFrame) -> DataFrame:
        return self.read().join(users.select("user_idx"), "user_idx", "left_semi")


def normalise_log(log: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """One layout for full, relevance-only and bare logs.

    Missing columns get their defaults (response 1, price 10, iteration ``start``); a given
    item table supplies the real price instead.
    """
    have = set(log.columns)
    if "response" in have:
        response = F.col("response")
    elif "relevance" in have:
        response = F.col("relevance")
    else:
        response = F.lit(1)
    label = F.col("iter") if "iter" in have else F.lit("start")
    price = F.col("price") if "price" in have else F.lit(10.0)
    flat = log.select(
        "user_idx", "item_idx", price.alias("price"), response.cast("int").alias("response"), label.alias("iter")
    )
    if "price" in have or items is None:
        return flat
    return flat.drop("price").join(items.select("item_idx", "price"), "item_idx", "left").select(
        "user_idx", "item_idx", F.coalesce("price", F.lit(10.0)).alias("price"), "response", "iter"
    )
