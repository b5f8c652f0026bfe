"""Schemas and schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.config import EmptyDataFrameError

REC_SCHEMA = T.StructType(
    [
        T.StructField("user_idx", T.LongType()),
        T.StructField("item_idx", T.LongType()),
        T.StructField("relevance", T.DoubleType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("user_idx", T.LongType()),
        T.StructField("item_idx", T.LongType()),
        T.StructField("relevance", T.DoubleType()),
        T.StructField("response", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("iter_no", T.IntegerType()),
        T.StructField("iter", T.StringType()),
    ]
)


def interaction_schema(
    query_column: str = "user_idx",
    item_column: str = "item_idx",
    timestamp_column: str = "timestamp",
    rating_column: str = "relevance",
    has_timestamp: bool = True,
    has_rating: bool = True,
) -> T.StructType:
    """Schema of an interaction table under the caller's column names."""
    schema = T.StructType().add(query_column, T.IntegerType()).add(item_column, T.IntegerType())
    if has_timestamp:
        schema = schema.add(timestamp_column, T.TimestampType())
    if has_rating:
        schema = schema.add(rating_column, T.DoubleType())
    return schema


def check_conforms(df: DataFrame, schema: T.StructType) -> None:
    """Compare names and types as sets; order and nullability do not count."""
    have = {(f.name, f.dataType) for f in df.schema.fields}
    want = {(f.name, f.dataType) for f in schema.fields}
    if have != want:
        odd = sorted(f"{name}: {kind.simpleString()}" for name, kind in have ^ want)
        raise ValueError(f"schemas differ in {odd}")


def local_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """Small parameter table from rows held by the caller."""
    if not rows:
        raise EmptyDataFrameError("no rows")
    return spark.createDataFrame(rows, schema)


def label_violations(log: DataFrame) -> DataFrame:
    """Rows whose relevance is neither 0 nor 1."""
    return log.where(~F.col("relevance").isin(0, 1) | F.col("relevance").isNull())


def check_binary_labels(log: DataFrame) -> None:
    if not label_violations(log.select("relevance")).isEmpty():
        raise ValueError("relevance must be 0 or 1")


def without_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    seen: dict[str, int] = {}
    unique, first = [], []
    for name in df.columns:
        count = seen.get(name, 0)
        seen[name] = count + 1
        unique.append(name if count == 0 else f"{name}__{count}")
        if count == 0:
            first.append(name)
    return df.toDF(*unique).select(*first)
