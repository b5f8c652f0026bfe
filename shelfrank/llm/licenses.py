"""Licence scans by a positional index of rare words.

Licence notices and phrases are templates of words with postings: word, template, position. The document
frequencies of all their words are counted over the whole table. In a text, the words of a template that are
rarest (highest IDF) and present are looked up; each occurrence proposes the place where the
template would begin, and the proposals of several words meet by relative position. A place counts when
enough words of the template stand there and its mandatory key phrase stands there word by word.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ALNUM_WORDS, Words, table, text_slices, word_hashes
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the contract: phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Well-known notices, each with its label and the key phrase it must hold.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit", "permission is hereby granted free of charge"),
    ("released under the mit license", "mit", "mit license"),
    ("licensed under the apache license version 2 0", "apache", "apache license"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl", "gnu general public license"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3", "gnu general public license version 3"),
    ("licensed under the gnu general public license version 2", "gpl-2", "gnu general public license version 2"),
    ("gnu lesser general public license", "lgpl", "gnu lesser general public license"),
    ("gnu affero general public license", "agpl", "gnu affero general public license"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd"),
    ("creative commons attribution", "cc-by", "creative commons attribution"),
    ("cc0 1 0 universal", "cc0", "cc0 1 0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     "redistribution and use in source and binary forms"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc", "permission to use copy modify"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", "mozilla public license"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license",
     "epl", "eclipse public license"),
    ("this is free and unencumbered software released into the public domain", "unlicense",
     "free and unencumbered software"),
)
# Words of a template looked up in a text, and the share of its words that must stand there.
ANCHORS = 3
SHARE = 0.8


class Template:
    def __init__(self, text: str, label: str, phrase: str, vocabulary: dict[str, int], base: bool):
        self.label, self.base = label, base
        words, key = text.split(), phrase.split()
        self.words = np.array([vocabulary[w] for w in words])
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        self.key = np.arange(at, at + len(key))


class RareWordIndex:
    """Templates, their vocabulary, and the postings of each word."""

    def __init__(self, base=BASE_PHRASES, notices=NOTICES):
        entries = [(text, label, text, True) for text, label in base] + [(*n, False) for n in notices]
        names = sorted({w for text, *_ in entries for w in text.split()})
        vocabulary = {w: i for i, w in enumerate(names)}
        hashes = word_hashes(names, ALNUM_WORDS)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.names = names
        self.templates = [Template(t, label, phrase, vocabulary, is_base) for t, label, phrase, is_base in entries]

    def numbers(self, words: Words) -> np.ndarray:
        """Vocabulary number of every word, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words.hash, self.order[at], -1)

    def frequencies(self, words: Words) -> np.ndarray:
        """In how many of the texts each vocabulary word stands."""
        number = self.numbers(words)
        known = np.flatnonzero(number >= 0)
        pairs = np.unique(words.row[known].astype(np.int64) * len(self.names) + number[known])
        return np.bincount(pairs % len(self.names), minlength=len(self.names))

    def places(self, words: Words, idf: np.ndarray, share: float) -> list[tuple[Template, np.ndarray, np.ndarray]]:
        """Per template: first words of the places where it stands, and the share of its words there."""
        number = self.numbers(words)
        known = np.flatnonzero(number >= 0)
        by_word = known[np.argsort(number[known], kind="stable")]
        cuts = np.searchsorted(number[by_word], np.arange(len(self.names) + 1))
        # Words of the own text only.
        first = words.first[words.row]
        last = words.first[words.row + 1]
        out = []
        for template in self.templates:
            size = len(template.words)
            need = 1.0 if template.base else share
            # A base phrase needs its one rarest word; a notice is proposed by several, of which as many
            # may be missing as the share allows.
            anchors = np.argsort(-idf[template.words], kind="stable")
            anchors = anchors[: 1 if template.base else max(ANCHORS, size - int(np.ceil(need * size)) + 1)]
            proposed = []
            for anchor in anchors:
                word = template.words[anchor]
                at = by_word[cuts[word] : cuts[word + 1]]
                begin = at - anchor
                proposed.append(begin[(begin >= first[at]) & (begin + size <= last[at])])
            starts = np.unique(np.concatenate(proposed))
            if len(starts):
                there = number[starts[:, None] + np.arange(size)] == template.words
                matched = there.mean(1)
                good = (matched >= need) & there[:, template.key].all(1)
                starts, matched = starts[good], matched[good]
                out.append((template, starts, matched))
        return out


def _labels(rows: int, found: list[tuple[np.ndarray, str]]) -> list[str]:
    sets: list[set] = [set() for _ in range(rows)]
    for row_numbers, label in found:
        for row in np.unique(row_numbers).tolist():
            sets[row].add(label)
    return [",".join(sorted(s)) for s in sets]


def scan(words: Words, index: RareWordIndex, idf: np.ndarray, share: float = SHARE) -> dict[str, list | np.ndarray]:
    rows = words.rows
    n_base = np.zeros(rows, np.int64)
    first, last = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
    score = np.zeros(rows)
    base, every = [], []
    for template, starts, matched in index.places(words, idf, share):
        row = words.row[starts]
        np.maximum.at(score, row, matched)
        every.append((row, template.label))
        if template.base:
            base.append((row, template.label))
            n_base += np.bincount(row, minlength=rows)
            np.minimum.at(first, row, starts - words.first[row])
            np.maximum.at(last, row, starts - words.first[row])
    none = n_base == 0
    return {
        "n_words": words.counts.astype(np.int64),
        "n_base": n_base,
        "first_word": pa.array(first, mask=none),
        "last_word": pa.array(last, mask=none),
        "base_labels": _labels(rows, base),
        "labels": _labels(rows, every),
        "score": score,
    }


def word_idf(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """IDF of every vocabulary word over all texts; one count per word and task is shuffled."""
    index = RareWordIndex()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(index.names), np.int64), 0
        for part in text_slices(batches, text_col):
            total += index.frequencies(Words(part.column(0), ALNUM_WORDS))
            texts += part.num_rows
        numbers = np.arange(-1, len(total))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.concatenate(([texts], total)))], ["word", "n"])

    counts = docs.select(text_col).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held = {r.word: r.n for r in counts.collect()}  # one row per word of the templates
    return np.array([np.log((held.get(-1, 0) + 1) / (held.get(i, 0) + 1)) for i in range(len(index.names))])


_COLUMNS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
])


def license_scan(docs: DataFrame, text_col: str = "text", share: float = SHARE) -> DataFrame:
    """Add licence findings to every row: ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of the base phrases, ``labels`` holds theirs and the notices' labels, ``score`` is
    the largest share of a template's words found in place (0 without any). Null and empty texts have
    no words, no places and empty label lists. Other columns and repeated rows are kept; a column with one of the
    new names is an error.
    """
    clash = sorted({f.name for f in _COLUMNS}.intersection(docs.columns))
    if clash:
        raise ValueError(f"columns exist: {clash}")
    idf = word_idf(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareWordIndex()
        for part in text_slices(batches, text_col):
            words = Words(part.column(part.schema.get_field_index(text_col)), ALNUM_WORDS)
            found = scan(words, index, idf, share)
            arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in found.values()]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *found])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_COLUMNS.fields]))


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
