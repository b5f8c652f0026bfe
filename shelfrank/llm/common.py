"""Shared helpers: tables written between stages, Arrow batches, words and shingles as hashes.

Python functions are shipped to the workers by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text handled at once inside a task; a longer document is handled alone.
SLICE_BYTES = 1 << 21
# The same where a dozen arrays of eight bytes for each of text stand beside it, and rows of a batch of such texts.
SMALL_SLICE, SMALL_BATCH = 1 << 19, 1000
# Fixed odd multipliers of the hashes (arbitrary, but results of earlier runs depend on them).
_BASE = 0x9E3779B97F4A7C15
_MIX_1 = 0xBF58476D1CE4E5B9
_MIX_2 = 0x94D049BB133111EB
_STEP = 0xD6E8FEB86659FD93

ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: lost executors
    never make the steps before run again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int = SMALL_BATCH):
    """What is written inside goes to Python ``most`` rows at a time, if not fewer: a task then holds some MB of texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) < most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Rows of a two-column list up to which it is sent to all tasks (some MB); longer ones are shuffled.
LISTED = 300_000


def listed(df: DataFrame) -> DataFrame:
    """A short list of keys, marked for broadcast if a count of it allows that."""
    return F.broadcast(df) if df.count() <= LISTED else df


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null and empty texts have none.

    Deletes the inside of words instead of building the words.
    """
    starts = F.regexp_replace(F.coalesce(text, F.lit("")), WORD_PATTERN, "x")
    return F.length(F.regexp_replace(starts, r"[\x20\x09-\x0D]+", "")).cast("long")


def one_space(text: Column) -> Column:
    """Text (null: empty) with every run of ASCII white space turned into one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def worker_store(name: str, make):
    """An object kept for the life of a Python worker, across its tasks."""
    home = sys.modules.setdefault("shelfrank_worker_store", types.ModuleType("shelfrank_worker_store"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def text_slices(batches, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches at document borders into slices of about ``limit`` bytes of text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        sizes = np.asarray(column.cast(pa.large_string()).fill_null("").cast(pa.large_binary()).buffers()[1])
        ends = np.frombuffer(sizes, np.int64)[: len(column) + 1]
        start = 0
        while start < len(column):
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(len(column), max(start + 1, stop))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, laid end to end, and the offsets of its rows (null: empty)."""
    filled = column.cast(pa.large_string()).fill_null("")
    filled = pa.concat_arrays([filled])  # drops a slice's offset
    ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX_1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX_2)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverse modulo 2**64, for i up to n."""
    held = worker_store("powers", dict)
    if held.get("n", -1) < n:
        size = max(n, 2 * held.get("n", 0), SMALL_SLICE) + 1
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            held[key] = np.cumprod(steps, dtype=np.uint64)
        held["n"] = size - 1
    return held["up"], held["down"]


def byte_tables(word_bytes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and a 64-bit value per byte with A-Z equal to a-z."""
    is_word = np.zeros(256, bool)
    is_word[list(word_bytes)] = True
    folded = np.arange(256, dtype=np.uint64)
    folded[65:91] += np.uint64(32)
    return is_word, mixed(folded + np.uint64(_STEP))


SPACE_WORDS = bytes(b for b in range(256) if b not in ASCII_SPACE)
# 0-9, A-Z, a-z and every byte of a non-ASCII character.
ALNUM_WORDS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalnum() or b >= 0x80)


class Words:
    """Words of several texts as arrays: hash, first byte, end byte and row of each."""

    def __init__(self, column: pa.Array, word_bytes: bytes):
        raw, ends = text_bytes(column)
        is_word, value = byte_tables(word_bytes)
        n = len(raw)
        inside = is_word[raw]
        first = np.zeros(n + 1, bool)
        first[ends[:-1]] = True
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1] | first[1:n]
        last = inside.copy()
        if n:
            last[:-1] &= ~inside[1:] | first[1:n]
        self.start = np.flatnonzero(fresh)
        self.end = np.flatnonzero(last) + 1
        up, down = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value[raw] * up[:n], out=sums[1:])
        spread = (sums[self.end] - sums[self.start]) * down[self.start]
        self.hash = mixed(spread + (self.end - self.start).astype(np.uint64) * np.uint64(_STEP))
        self.row = np.searchsorted(ends, self.start, "right") - 1
        self.rows = len(column)
        self.counts = np.bincount(self.row, minlength=self.rows) if n else np.zeros(self.rows, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))  # per row, its first word
        self.raw, self.ends = raw, ends

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``size`` words from each word on, and whether they stay inside the row."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        whole = n - size + 1
        if whole > 0:
            out[:whole] = run_hash([self.hash[k : k + whole] for k in range(size)])
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return out, left >= size


def run_hash(columns) -> np.ndarray:
    """Order-dependent hash of several hash columns."""
    total = np.zeros_like(columns[0])
    for column in columns:
        total = total * np.uint64(_STEP) + column
    return mixed(total)


def word_hashes(words: list[str], word_bytes: bytes) -> np.ndarray:
    """Hashes of given words, equal to those that texts give."""
    found = Words(pa.array(words, pa.large_string()), word_bytes)
    if len(found.hash) != len(words):
        raise ValueError("each entry must be one word")
    return found.hash


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components: ``node, root`` with the smallest node reachable.

    Alternates the two star steps: every node's larger neighbours, then its smaller ones, hang on
    the smallest neighbour. Each round is written out; the edges stay spread over the cluster.
    """
    low, high = F.least(left, right), F.greatest(left, right)
    now = written(edges.where(F.col(left) != F.col(right)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        # Done when every node hangs once, on one that hangs on none.
        ends = now.select(F.col("u").alias("n"), F.lit(1).alias("up")).unionByName(now.select(F.col("v").alias("n"), F.lit(0).alias("up")))
        of = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
        if of.where("ups > 1 OR ups = 1 AND least = 0").isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
