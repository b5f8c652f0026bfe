"""Column expressions. All of them stay inside the JVM; none needs a Python worker."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def feature_columns(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that carry features, found by their prefix."""
    return [name for name in df.columns if name.startswith(prefix)]


def dot(left: Column | str, right: Column | str) -> Column:
    products = F.zip_with(_as_col(left), _as_col(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def length(vector: Column | str) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine of two arrays; 0 when one is missing or has no length."""
    scale = length(left) * length(right)
    return F.coalesce(F.when(scale > 0, dot(left, right) / scale), F.lit(0.0))


def angular(left: Column | str, right: Column | str) -> Column:
    """One minus the angle between two arrays as a share of a half turn."""
    scale = length(left) * length(right)
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(left, right) / scale))
    return F.coalesce(F.when(scale > 0, 1 - F.acos(clamped) / F.lit(math.pi)), F.lit(0.0))


def l2_normalise(vector: Column | str) -> Column:
    size = length(vector)
    return F.when(size > 0, F.transform(_as_col(vector), lambda x: x / size)).otherwise(_as_col(vector))


def scale_array(vector: Column | str, factor: Column | str) -> Column:
    return F.transform(_as_col(vector), lambda x: x * _as_col(factor))


def array_or_zero(vector: Column | str, size: int) -> Column:
    """The array itself when it has the wanted size, else that many zeros."""
    arr = _as_col(vector)
    return F.when(F.size(arr) == size, arr).otherwise(F.array_repeat(F.lit(0.0), size))


def element(vector: Column | str, index: int) -> Column:
    return F.get(_as_col(vector), F.lit(index))


def sigmoid(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-_as_col(x)))


def binarise(df: DataFrame) -> Column:
    """1 for a positive outcome; reads ``response`` when the table has it."""
    source = "response" if "response" in df.columns else "relevance"
    return F.when(F.col(source) > 0, 1).otherwise(0)


def rank_discount(rank: Column | str) -> Column:
    return 1 / F.log2(_as_col(rank) + 1)


def price_response_relevance(probability: Column | str, price: Column | str) -> Column:
    """Non-linear relevance of a purchase probability at a price."""
    p, amount = _as_col(probability), _as_col(price)
    return (
        (F.sin(p) + 1)
        * F.exp(p - 1)
        * F.log1p(amount)
        * F.cos(amount / 100)
        * (1 + F.tan(p * F.lit(math.pi / 4)))
    )


def iteration_ordinal(label: Column | str) -> Column:
    """Order of an iteration label: start, then training, then test iterations."""
    text = _as_col(label).cast("string")
    digits = F.regexp_extract(text, r"(\d+)$", 1).try_cast("int")
    return (
        F.when(text.rlike(r"^train_\d+$"), digits + 1)
        .when(text.rlike(r"^test_\d+$"), digits + 100)
        .when(text.rlike(r"^\d+$"), digits)
        .otherwise(F.lit(0))
    )


def numeric_or_zero(value: Column | str) -> Column:
    return F.coalesce(_as_col(value).try_cast("double"), F.lit(0.0))


def price_like_column(df: DataFrame) -> str:
    """``price`` if present, else the first column whose name contains it."""
    if "price" in df.columns:
        return "price"
    for name in df.columns:
        if "price" in name.lower():
            return name
    raise ValueError("no price-like column in the table")


def one_hot(column: str, categories: list[str], prefix: str | None = None) -> list[Column]:
    """One 0/1 column per category of a fixed list, the list kept with the model."""
    stem = prefix or column
    return [
        F.when(F.col(column) == value, 1).otherwise(0).alias(f"{stem}_{value.lower()}")
        for value in categories
    ]


def decay_weight(decay: float, newest: Column | str, when: Column | str) -> Column:
    return F.pow(F.lit(decay), _as_col(newest) - _as_col(when))
