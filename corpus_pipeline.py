"""The corpus pipeline: toxicity, exact copies, near duplicates, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.bpe import bpe_encode, tokenizer_path
from shelfrank.llm.common import table, written
from shelfrank.llm.exact_dedup import without_copies
from shelfrank.llm.mixture import mixed_documents
from shelfrank.llm.near_dedup import without_near_duplicates
from shelfrank.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold. The model learns from the labelled documents."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return without_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every document of the mix."""
    kept = docs.select("doc_id", "text", "lang", "source")
    tokens = bpe_encode(kept, tokenizer_path()).drop("text")
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("bpe", encode),
]

# Trained scores and seeded draws are outside SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
