"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, and decoding.

Every piece of text is a row of symbols. A segment tree over its adjacent pairs keeps the smallest
(rank, position) at the root: the leftmost lowest-rank merge. Applying it changes three leaves
(the pair itself, the one before, the one after), each updated along its path to the root, until no
mergeable pair is left. Pieces of similar length go through the tree together as arrays.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.chunks import ChunkTable, spans
from shelfrank.llm.common import table, text_slices, worker_store
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "byte_bpe_50k.json"
# Cells (rows x leaves) of one group of trees.
TREE_CELLS = 1 << 20
NONE = np.iinfo(np.int64).max
# Longest chunk worth remembering.
CHUNK_CHARS = 64

# The characters with the Unicode property White_Space, and the pattern that
# cuts a text into pieces before the merges of this family of vocabularies.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


@dataclass
class Vocabulary:
    """Tables of a byte-level BPE vocabulary; their size is that of the vocabulary file."""

    byte_ids: np.ndarray  # id of each single byte
    pairs: np.ndarray  # left id * size + right id, sorted
    pair_ranks: np.ndarray  # rank of each of these pairs
    merged: np.ndarray  # by rank: id of the merged symbol
    size: int
    token_bytes: bytes  # bytes of all ids, one after another
    token_starts: np.ndarray
    special: dict[str, int]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    """Read a ``tokenizers`` JSON file of a byte-level BPE without normaliser."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    odd += [t["content"] for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or odd:
        raise ValueError(f"not a plain byte-level BPE: {odd}")
    vocab: dict[str, int] = model["vocab"]
    size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    letters = byte_letters()
    back = {letter: bytes([b]) for b, letter in enumerate(letters)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = {i: b"".join(back[c] for c in name) for name, i in vocab.items()}
    names |= {i: name.encode() for name, i in special.items()}
    every = [names.get(i, b"") for i in range(size)]
    return Vocabulary(
        byte_ids=np.array([vocab[c] for c in letters], np.int64), pairs=keys[order], pair_ranks=order,
        merged=merged, size=size, token_bytes=b"".join(every),
        token_starts=np.cumsum([0, *map(len, every)]), special=special,
    )


class SegmentTreeBpe:
    """Merge pieces of bytes into ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where it does not merge (or an id is missing: -1)."""
        key = left * self.v.size + right
        at = np.minimum(np.searchsorted(self.v.pairs, key), len(self.v.pairs) - 1)
        found = (self.v.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.v.pair_ranks[at], NONE)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, one after another, and the number of ids of each."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        symbols = self.v.byte_ids[data]
        left = lengths.copy()
        kept = np.ones(len(data), bool)
        width = 2
        todo = lengths > 1
        while todo.any():
            group = np.flatnonzero(todo & (lengths <= width))
            todo[group] = False
            step = max(1, TREE_CELLS // width)
            for k in range(0, len(group), step):
                self._merge(symbols, kept, left, starts, lengths, group[k : k + step], width)
            width *= 2
        return symbols[kept].astype(np.int32), left

    def _merge(self, symbols, kept, left, starts, lengths, rows, width) -> None:
        n, m = len(rows), width
        cells = np.arange(m)
        used = cells < lengths[rows][:, None]
        sym = np.where(used, symbols[np.minimum(starts[rows][:, None] + cells, len(symbols) - 1)], -1).ravel()
        after = np.where(cells + 1 < lengths[rows][:, None], cells + 1, -1).ravel()
        before = np.broadcast_to(cells - 1, (n, m)).ravel().copy()
        live = used.ravel().copy()
        tree = np.full((n, 2 * m), NONE)
        grid = sym.reshape(n, m)
        rank = self.ranks(grid[:, :-1], grid[:, 1:])
        tree[:, m : 2 * m - 1] = np.where(rank < NONE, rank * m + cells[:-1], NONE)
        for node in range(m - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        tree = tree.ravel()

        def put(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            """Set one leaf per row and mend its path to the root."""
            base = row * (2 * m)
            node = at + m
            tree[base + node] = value
            while node[0] > 1:  # all leaves lie at one depth
                node = node >> 1
                tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])

        active = np.arange(n)
        while True:
            best = tree[active * (2 * m) + 1]
            go = best < NONE
            active, best = active[go], best[go]
            if not len(active):
                break
            at, offset = best % m, active * m
            gone = after[offset + at]
            then = after[offset + gone]
            sym[offset + at] = self.v.merged[best // m]
            live[offset + gone] = False
            after[offset + at] = then
            has_then = then >= 0
            before[offset[has_then] + then[has_then]] = at[has_then]
            put(active, gone, np.full(len(active), NONE))
            mine = sym[offset + at]
            rank = self.ranks(mine, np.where(has_then, sym[offset + np.maximum(then, 0)], -1))
            put(active, at, np.where(rank < NONE, rank * m + at, NONE))
            ahead = before[offset + at]
            has = ahead >= 0
            if has.any():
                rank = self.ranks(sym[offset[has] + ahead[has]], mine[has])
                put(active[has], ahead[has], np.where(rank < NONE, rank * m + ahead[has], NONE))
        target = (starts[rows][:, None] + cells)[used]
        symbols[target] = sym.reshape(n, m)[used]
        kept[target] = live.reshape(n, m)[used]
        left[rows] = live.reshape(n, m).sum(1)


class Coder:
    """Encode and decode whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tree = SegmentTreeBpe(vocabulary)
        self.pieces = regex.compile(PIECES)
        # A blank is a safe border unless white space stands before it.
        self.unsafe = regex.compile(f"[{WHITE}] ")
        self.slow_chunks = regex.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")")
            if vocabulary.special else None
        )
        self.table = ChunkTable(self.encode_chunks)

    def plain_chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if self.unsafe.search(text):
            return self.slow_chunks.findall(text)
        head, *rest = text.split(" ")
        return [*([head] if head else []), *[" " + x for x in rest]]

    def chunks(self, text: str) -> list:
        """Chunks of a text; a special token is the tuple of its id."""
        if self.special is None or "<" not in text and all("<" in s for s in self.v.special):
            return self.plain_chunks(text)
        out: list = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append((self.v.special[part],))
            else:
                out += self.plain_chunks(part)
        return out

    def encode_chunks(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        pieces = [[] if isinstance(c, tuple) else [p.encode() for p in self.pieces.findall(c)] for c in chunks]
        every = list({p for row in pieces for p in row})
        ids, counts = self.tree.encode(every)
        at = dict(zip(every, range(len(every)), strict=True))
        starts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64) if len(counts) else counts
        index = np.fromiter((at[p] for row in pieces for p in row), np.int64)
        lengths = counts[index]
        flat = ids[spans(starts[index], lengths)] if len(index) else np.zeros(0, np.int32)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        per_chunk = np.cumsum([0, *map(len, pieces)])
        sizes = ends[per_chunk[1:]] - ends[per_chunk[:-1]]
        for i in [i for i, c in enumerate(chunks) if isinstance(c, tuple)]:
            flat = np.insert(flat, int(sizes[:i].sum()), chunks[i][0])
            sizes[i] = 1
        return flat, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        return self.table.tokens([self.chunks(t) for t in texts])

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the number of bytes of each id."""
        starts = self.v.token_starts
        lengths = starts[ids.astype(np.int64) + 1] - starts[ids]
        return np.frombuffer(self.v.token_bytes, np.uint8)[spans(starts[ids], lengths)], lengths


def _text_column(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A string column over bytes; a byte sequence that is not UTF-8 becomes U+FFFD, as in ``bytes.decode``."""
    data = raw.tobytes()
    try:
        data.decode()
        whole = all(data[e] & 0xC0 != 0x80 for e in ends[:-1] if e < len(data))
    except UnicodeDecodeError:
        whole = False
    if whole:
        return pa.Array.from_buffers(
            pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)]
        )
    parts = [data[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return pa.array(parts, pa.large_string())


def _coder(shared) -> Coder:
    held = worker_store("coders", dict)
    if shared.id not in held:
        held.clear()
        held[shared.id] = Coder(shared.value)
    return held[shared.id]


class _Broadcast:
    """A Spark broadcast and the number that names it in the workers."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        from uuid import uuid4

        self.id = uuid4().hex
        # Plain arrays: workers need not have this class's module.
        self.held = spark.sparkContext.broadcast(vars(vocabulary))

    @property
    def value(self) -> Vocabulary:
        return Vocabulary(**self.held.value)


def _with_column(df: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    return T.StructType([*df.schema.fields, T.StructField(out, kind, True)])


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Add ``ids``: the BPE ids of every whole text (null: empty), special tokens' strings
    in a text becoming their ids. Other columns, repeated rows and order within a partition
    are kept; an empty text has no ids. An existing column ``out`` is an error."""
    shared = _Broadcast(docs.sparkSession, read_vocabulary(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for part in text_slices(batches, text_col):
            texts = [t or "" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
            ids, counts = coder.encode(texts)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, out])

    return docs.mapInArrow(encode, _with_column(docs, out, T.ArrayType(T.IntegerType())))


def bpe_decode(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of every array of ids, special tokens included (null: empty).
    Bytes that form no character become U+FFFD; an id outside the vocabulary is an error."""
    shared = _Broadcast(tokens.sparkSession, read_vocabulary(path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                column = part.column(part.schema.get_field_index(ids_col))
                counts = np.array([len(x) if x is not None else 0 for x in column.to_numpy(zero_copy_only=False)])
                ids = column.flatten().to_numpy()
                raw, sizes = coder.decode_bytes(ids)
                ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts))).astype(int)]
                text = _text_column(raw, ends).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, out])

    return tokens.mapInArrow(decode, _with_column(tokens, out, T.StringType()))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_bpe")
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path()
    encoded = bpe_encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    back = bpe_decode(encoded.drop("text"), path)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
