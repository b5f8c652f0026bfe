"""Brute-force versions and small tables for the tests of this folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Null, empty and white texts, repeats, ties, clashing names.
ODD_ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "One two three", "b"), (4, "One two three", "b"),
    (5, "one\ttwo \n three", "b"), (6, "x" * 30_000, None), (7, "word " * 8_000, "c"), (8, "One two three four", "b"),
]
SCHEMA = "doc_id long, text string, source string"


def odd_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def ascii_words(text: str | None) -> list[str]:
    return ASCII_WORD.findall(ascii_lower(text or ""))


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
