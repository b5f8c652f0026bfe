"""Alignment of two tokenizers' tokens of the same text by lockstep merging.

Both tokenizers give a text as tokens that tile the same bytes. One state vector holds a pointer into
the A tokens and one into the B tokens of every document of a batch; each step compares the ends of the tokens pointed
at, advances the pointer with the smaller end, or both where the ends are equal, which makes a link
and a cut. Finished documents leave the vector. A long document takes part as several stretches that
begin and end at blanks where both tokenizers must cut, so the vector stays full.

A chunk (a blank and what follows it up to the next such blank) has tokens that do not depend on its surroundings:
each worker encodes a chunk it has met before only once.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.bpe import read_vocabulary, tokenizer_path
from shelfrank.llm.chunks import spans
from shelfrank.llm.common import LISTED, table, text_slices, worker_store, written
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Chunks of a stretch of a document.
STRETCH = 64
# Chunks, and ids of them, that one worker remembers; bounds memory, not results.
REMEMBERED, REMEMBERED_IDS = 800_000, 32_000_000
# Copies of the table of counts when it is too long to broadcast.
SALTS = 16
BLANK = "▁"
# Before a blank between two characters other than white space (and the mark that stands for a blank).
CUT = re.compile(rf"(?<=[^\s{BLANK}])(?= \S)")
UNSAFE = re.compile(rf"[\s{BLANK}] | \s")


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def chunks_of(text: str) -> list[str]:
    """A blank and the text, cut at blanks where both tokenizers cut whatever stands around."""
    if not text:
        return []
    if text[0] == " " or UNSAFE.search(text) or text[-1] == " ":
        return CUT.split(" " + text)
    return [" " + part for part in text.split(" ")]


class Side:
    """Growing arrays: ids per chunk of one tokenizer."""

    def __init__(self) -> None:
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.lengths, self.chunks = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def add(self, rows: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.fromiter((i for row in rows for i in row), np.int32, int(lengths.sum()))
        for name, need in (("ids", self.used + len(ids)), ("starts", self.chunks + len(rows)), ("lengths", self.chunks + len(rows))):
            old = getattr(self, name)
            if need > len(old):
                wider = np.zeros(2 * need, old.dtype)
                wider[: len(old)] = old
                setattr(self, name, wider)
        self.ids[self.used : self.used + len(ids)] = ids
        new = slice(self.chunks, self.chunks + len(rows))
        self.lengths[new], self.starts[new] = lengths, self.used + offsets(lengths)[:-1]
        self.used, self.chunks = self.used + len(ids), self.chunks + len(rows)


class Pair:
    """Both tokenizers, the bytes of their tokens, and the chunks met so far."""

    def __init__(self, a_json: str, b_proto: bytes, a_bytes: bytes, a_starts: np.ndarray):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_proto)
        self.a_names = [a_bytes[x:y] for x, y in zip(a_starts[:-1].tolist(), a_starts[1:].tolist(), strict=True)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece goes on past a blank: texts cannot be cut there")
        self.b_names = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, n), np.int64, len(n)) for n in (self.a_names, self.b_names))
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.sides = Side(), Side()
        self.whole = np.zeros(0, bool)

    def _add(self, new: list[str]) -> None:
        a = [e.ids for e in self.a.encode_batch(new, add_special_tokens=False)]
        b = self.b.encode([c[1:] for c in new], num_threads=1)
        for side, rows in zip(self.sides, (a, b), strict=True):
            side.add(rows)
        raw = [c.encode() for c in new]
        good = [
            b"".join(map(self.a_names.__getitem__, x)) == r == b"".join(map(self.b_names.__getitem__, y))
            for x, y, r in zip(a, b, raw, strict=True)
        ]
        self.whole = np.concatenate((self.whole, np.array(good, bool)))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))

    def tokens(self, texts: list[str | None]) -> Aligned:
        if len(self.index) > REMEMBERED or max(s.used for s in self.sides) > REMEMBERED_IDS:
            self._clear()
        rows = [chunks_of(t or "") for t in texts]
        every = [c for row in rows for c in row]
        new = set(every).difference(self.index)
        if new:
            self._add(list(new))
        at = np.fromiter(map(self.index.__getitem__, every), np.int64, len(every))
        per_row = np.fromiter(map(len, rows), np.int64, len(rows))
        row = np.repeat(np.arange(len(rows)), per_row)
        # A text with bytes that a tokenizer does not give back has no tokens at all.
        bad = np.zeros(len(rows), bool)
        bad[row[~self.whole[at]]] = True
        at, row = at[~bad[row]], row[~bad[row]]
        # Stretches: every STRETCH-th chunk of a row opens one.
        place = np.arange(len(row)) - np.searchsorted(row, row)
        opens = np.flatnonzero(place % STRETCH == 0)
        out = []
        for side, sizes in zip(self.sides, (self.a_sizes, self.b_sizes), strict=True):
            lengths = side.lengths[at]
            ids = side.ids[spans(side.starts[at], lengths)]
            first = offsets(lengths)
            of_row = np.bincount(row, lengths, len(rows)).astype(np.int64)
            out.append((ids, np.cumsum(sizes[ids]), offsets(of_row), np.append(first[opens], first[-1])))
        return Aligned(*out)


class Aligned:
    """Ids, byte ends, rows and stretches of both sides; links after the lockstep merge."""

    def __init__(self, a, b):
        (self.a, self.a_ends, self.a_rows, a_cuts), (self.b, self.b_ends, self.b_rows, b_cuts) = a, b
        self.a_last, self.b_last = lockstep(self.a_ends, self.b_ends, a_cuts, b_cuts)
        # Links lie in the order of the tokens, so a row's are a range.
        self.rows = np.searchsorted(self.a_last, self.a_rows)

    def cuts(self) -> np.ndarray:
        """Byte offset in its own row (a blank and the text) where each group ends."""
        before = np.append(0, self.a_ends)[self.a_rows[:-1]]
        return self.a_ends[self.a_last] - np.repeat(before, np.diff(self.rows))

    def group_texts(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all rows, one after another, and the offsets of the rows."""
        n_a, n_b = len(self.a), len(self.b)
        # A group's B tokens come after its A tokens.
        a_at = np.arange(n_a) + np.append(-1, self.b_last)[np.searchsorted(self.a_last, np.arange(n_a))] + 1
        b_at = np.arange(n_b) + (self.a_last[np.searchsorted(self.b_last, np.arange(n_b))] + 1 if n_b else 0)
        ids, mark = np.zeros(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[a_at], ids[b_at] = self.a, self.b
        mark[a_at[self.a_last]], mark[b_at[self.b_last]] = ord("|"), ord(";")
        digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 10))
        ends = np.cumsum(digits + 1)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = mark
        rest, place = ids, ends - 2
        left = np.arange(len(ids))
        while len(left):
            out[place] = 48 + rest % 10
            more = rest >= 10
            rest, place, left = rest[more] // 10, place[more] - 1, left[more]
        return out.tobytes(), np.append(0, ends)[self.a_rows + self.b_rows]


def lockstep(a_ends, b_ends, a_cuts, b_cuts) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B tokens that end together, in order.

    ``a_cuts`` and ``b_cuts`` are the borders of the documents' tokens; all move on by one comparison a step.
    """
    a, stop = a_cuts[:-1][np.diff(a_cuts) > 0], a_cuts[1:][np.diff(a_cuts) > 0]
    b = b_cuts[:-1][np.diff(b_cuts) > 0]
    links: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a):
        x, y = a_ends[a], b_ends[b]
        same = x == y
        links.append((a[same], b[same]))
        a, b = a + (x <= y), b + (y <= x)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Both orders agree: links never cross.
    return np.sort(np.concatenate([p[0] for p in links])), np.sort(np.concatenate([p[1] for p in links]))


def _lists(values: np.ndarray, borders: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(values, kind))


def _aligned(docs: DataFrame, a_path: str, b_path: str, text_col: str, row_columns, schema: str) -> DataFrame:
    """Per slice of texts: the columns of ``row_columns(slice, alignment, first row)``."""
    vocabulary = read_vocabulary(a_path)
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        held = (a_file.read(), b_file.read(), vocabulary.token_bytes, vocabulary.token_starts)
    shared, name = docs.sparkSession.sparkContext.broadcast(held), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("token_pairs", dict)
        if name not in store:
            store.clear()
            store[name] = Pair(*shared.value)
        row = TaskContext.get().partitionId() << 33
        for part in text_slices(batches, text_col):
            aligned = store[name].tokens(part.column(part.schema.get_field_index(text_col)).to_pylist())
            columns = row_columns(part, aligned, row)
            row += part.num_rows
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, schema)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, a_last, b_last, cuts`` of every whole text.

    Group ``i`` ends at byte ``cuts[i]`` of the blank and the text, with A token ``a_last[i]`` and B token ``b_last[i]``
    (places from 0), which are linked. Null and empty texts, and texts that the tokens of A or B do not spell, have
    empty arrays. Repeated rows, ids and null ids each give a row; other columns play no part, whatever their
    names. A text of any length is held whole by its task; no row depends on another one.
    """

    def columns(part: pa.RecordBatch, x: Aligned, row: int) -> dict:
        place = lambda last, rows: last - np.repeat(rows[:-1], np.diff(x.rows))
        return {
            "doc_id": part.column(0),
            "a_ids": _lists(x.a, x.a_rows, pa.int32()), "b_ids": _lists(x.b, x.b_rows, pa.int32()),
            "a_last": _lists(place(x.a_last, x.a_rows), x.rows, pa.int32()),
            "b_last": _lists(place(x.b_last, x.b_rows), x.rows, pa.int32()),
            "cuts": _lists(x.cuts(), x.rows, pa.int64()),
        }

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>, cuts array<long>"
    return _aligned(_texts(docs, id_col, text_col), a_path, b_path, "text", columns, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the sizes of its alignment, a digest of its groups, and its id pairs with how often it links them.

    The same merge as ``align_tokens``, of which only these columns leave the task. ``row`` tells rows apart."""

    def columns(part: pa.RecordBatch, x: Aligned, row: int) -> dict:
        data, borders = x.group_texts()
        digests = [
            hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else ""
            for s, e in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)
        ]
        n = part.num_rows
        of = np.repeat(np.arange(n), np.diff(x.rows))
        keys = (of << 40) + (x.a[x.a_last].astype(np.int64) << 20) + x.b[x.b_last]
        keys, times = np.unique(keys, return_counts=True)
        borders = np.searchsorted(keys >> 40, np.arange(n + 1))
        count = lambda rows: pa.array(np.diff(rows), pa.int64())
        return {
            "row": pa.array(np.arange(row, row + n), pa.int64()), "doc_id": part.column(0),
            "n_a": count(x.a_rows), "n_b": count(x.b_rows), "n_groups": count(x.rows), "groups_sha256": pa.array(digests),
            "pairs": _lists(keys & (1 << 40) - 1, borders, pa.int64()), "times": _lists(times, borders, pa.int64()),
        }

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
    return _aligned(_texts(docs, id_col, text_col), a_path, b_path, "text", columns, schema)


def link_counts(links: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links hold each id pair, and whether no pair of its B id is held by more.

    ``pair`` is A's id times 2**20 plus B's; there are at most as many as pairs of vocabulary entries, whatever the
    number of documents. Counts are added up on the map side first."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("n"))
    b = F.col("pair").bitwiseAND((1 << 20) - 1)
    counts = written(counts.withColumn("b", b), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return written(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B)
    docs = written(alignment_counts(table(spark, folder, "documents"), *paths), "alignment")
    links = docs.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counts = link_counts(links)
    if counts.count() <= LISTED:
        found = links.join(F.broadcast(counts), "pair")
    else:
        # A pair that most documents hold is met in SALTS places.
        salted = links.withColumn("salt", F.pmod("row", F.lit(SALTS)))
        copies = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        found = salted.join(copies, ["pair", "salt"])
    sums = found.groupBy("row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    out = docs.select(*kept).join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256")
