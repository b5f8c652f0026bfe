"""Token ids in binary files, with Elias-Fano coded document boundaries.

A segment holds the ids of consecutive documents as one array of small integers. Where each document
ends is a rising sequence, kept as Elias-Fano code: the low bits of every value as they are, the high
bits in unary. Samples of every ``SAMPLE``-th one bit let ``select`` find a boundary without a
table of 64-bit offsets. Document ids, rising as well, are coded the same way.

Spark's text sink writes the bytes of a row unchanged, so the files go to any storage Spark writes
to, one segment each; the binary file source reads them back.
"""

from __future__ import annotations

import struct
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.chunks import ChunkTable
from shelfrank.llm.common import table, text_slices, worker_store, written
from shelfrank.llm.registry import query
from shelfrank.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# A segment is closed once it holds this many ids.
SEGMENT_IDS = 4_000_000
SAMPLE = 256
MAGIC = b"SFTOKEN1"
# magic, shard, segment, documents, null ids, id bytes, first doc id, tokens
HEADER = "<8sIIIIIqQ"
# count, low bits, universe
CODE = "<IIQ"
# A word that stands between words in one call of the tokenizer.
MARK = "\x01"
# ASCII punctuation that often closes a word.
CLOSING = ".,;:!?|"
# Words, and pieces of them that outlast the words, that one worker remembers.
WORDS, PIECES = 500_000, 700_000


class EliasFano:
    """A rising sequence of integers from 0 on."""

    def __init__(self, count: int, low_bits: int, universe: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.universe = count, low_bits, universe
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        words = (int(ones[-1]) // 64 + 1) if n else 0
        spread = np.zeros(words * 64, np.uint8)
        spread[ones] = 1
        high = np.packbits(spread, bitorder="little").view(np.uint64)
        # Per SAMPLE-th one: the word it stands in and the ones before that word.
        at = ones[::SAMPLE] // 64
        before = np.searchsorted(ones, at * 64)
        samples = np.stack([at, before], 1).astype(np.uint32) if n else np.zeros((0, 2), np.uint32)
        return cls(n, low_bits, universe, low, high, samples)

    def select(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        index = np.asarray(index, np.int64)
        word = self.samples[index // SAMPLE, 0].astype(np.int64)
        left = index - self.samples[index // SAMPLE, 1]
        ones = np.bitwise_count(self.high[word]).astype(np.int64)
        moving = np.flatnonzero(left >= ones)
        while len(moving):
            left[moving] -= ones[moving]
            word[moving] += 1
            ones[moving] = np.bitwise_count(self.high[word[moving]])
            moving = moving[left[moving] >= ones[moving]]
        inside = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bit = np.argmax(np.cumsum(inside, axis=1, dtype=np.int16) == (left + 1)[:, None], axis=1)
        value = (word * 64 + bit - index) << self.low_bits
        for k in range(self.low_bits):
            place = index * self.low_bits + k
            value |= ((self.low[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(np.int64) << k
        return value

    def to_bytes(self) -> bytes:
        return struct.pack(CODE, self.count, self.low_bits, self.universe) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int, words: int) -> tuple[EliasFano, int]:
        count, low_bits, universe = struct.unpack_from(CODE, data, at)
        at += struct.calcsize(CODE)
        low_size, n_samples = (count * low_bits + 7) // 8, (count + SAMPLE - 1) // SAMPLE
        low = np.frombuffer(data, np.uint8, low_size, at)
        high = np.frombuffer(data, np.uint64, words, at + low_size)
        samples = np.frombuffer(data, np.uint32, 2 * n_samples, at + low_size + 8 * words).reshape(-1, 2)
        return cls(count, low_bits, universe, low, high, samples), at + low_size + 8 * words + 8 * n_samples


def pack_segment(shard: int, segment: int, doc_ids: list, ids: np.ndarray, ends: np.ndarray, id_bytes: int) -> bytes:
    """One segment; ``doc_ids`` rise, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    first = int(known[0]) if len(known) else 0
    names = EliasFano.of((known.astype(object) - first).astype(np.uint64) if len(known) else known)
    bounds = EliasFano.of(ends)
    head = struct.pack(HEADER, MAGIC, shard, segment, len(doc_ids), nulls, id_bytes, first, len(ids))
    sizes = struct.pack("<II", len(names.high), len(bounds.high))
    body = ids.astype(f"<u{id_bytes}").tobytes()
    return b"".join([head, sizes, names.to_bytes(), bounds.to_bytes(), body])


def unpack_segments(content: bytes):
    """Segments of a file: shard, segment, document ids, boundaries and ids."""
    data, at = memoryview(content), 0
    while at + struct.calcsize(HEADER) <= len(data):
        magic, shard, segment, docs, nulls, id_bytes, first, tokens = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at += struct.calcsize(HEADER)
        name_words, bound_words = struct.unpack_from("<II", data, at)
        names, at = EliasFano.read(data, at + 8, name_words)
        bounds, at = EliasFano.read(data, at, bound_words)
        ids = np.frombuffer(data, f"<u{id_bytes}", tokens, at)
        at += id_bytes * tokens + 1  # the sink ends every row with a line feed
        doc_ids = [None] * nulls
        doc_ids += [int(v) + first for v in names.select(np.arange(names.count))] if names.count else []
        yield shard, segment, doc_ids, bounds, ids


class WordCoder:
    """Ids of whole texts by the ``tokenizers`` library, which sees each different word once.

    Words are cut at ASCII white space, across which neither the normaliser nor the merges reach.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.mark = self._ids([MARK])[0]
        if len(self.mark) != 1:
            raise ValueError("the vocabulary has no single id for the mark")
        self.table = ChunkTable(self.encode_words, WORDS)
        self.pieces = ChunkTable(self.encode_pieces, PIECES)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words. Closing punctuation behind letters and digits is a piece of its own for the
        tokenizer too, and ASCII letters are lowered there: such words share their core."""
        rows = []
        for word in words:
            text = word.decode()
            core = text.rstrip(CLOSING)
            lowered = core.lower() if core.isascii() else unicodedata.normalize("NFC", core).lower()
            if lowered.isalnum():
                piece = lowered if core.isascii() else core
                rows.append([piece, text[len(core) :]] if len(core) < len(text) else [piece])
            else:
                rows.append([text])
        return self.pieces.tokens(rows)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(pieces)
        plain = [i for i, w in enumerate(pieces) if MARK not in w and "<|" not in w and len(w) < 1000]
        odd = sorted(set(range(len(pieces))).difference(plain))
        for i, ids in zip(odd, self._ids([pieces[i] for i in odd]), strict=True):
            out[i] = np.array(ids, np.int32)
        step = 256
        groups = [plain[k : k + step] for k in range(0, len(plain), step)]
        for k in range(0, len(groups), 64):
            part = groups[k : k + 64]
            texts = [f" {MARK} ".join([pieces[i] for i in group]) for group in part]
            for group, ids in zip(part, self._ids(texts), strict=True):
                flat = np.array(ids, np.int32)
                cuts = np.flatnonzero(flat == self.mark[0])
                if len(cuts) != len(group) - 1:
                    raise ValueError("a word holds the mark")
                starts, ends = [0, *(cuts + 1)], [*cuts, len(flat)]
                for i, a, b in zip(group, starts, ends, strict=True):
                    out[i] = flat[a:b]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return np.concatenate(out) if out else np.zeros(0, np.int32), lengths


def write_token_files(
    docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Write the ids of every text (null: empty; ``end_id`` after each) in ascending id order.

    Null ids come first, equal ids in text order. A range of ids is one shard, cut into segments.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    from uuid import uuid4

    name, held_spec = uuid4().hex, spark.sparkContext.broadcast(spec)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = worker_store("word_coders", dict)
        if name not in held:
            held.clear()
            held[name] = WordCoder(held_spec.value)
        coder = held[name]
        id_bytes = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        segment, doc_ids, parts, ends, used = 0, [], [], [], 0
        for part in text_slices(batches):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            ids, counts = coder.table.tokens([(t or b"").split() for t in texts])
            # The end id goes behind each document.
            ids = np.insert(ids, np.cumsum(counts), end_id)
            doc_ids += part.column("id").to_pylist()
            parts.append(ids)
            ends.append(used + np.cumsum(counts + 1))
            used += len(ids)
            if used >= SEGMENT_IDS:
                yield one(pack_segment(shard, segment, doc_ids, np.concatenate(parts), np.concatenate(ends), id_bytes))
                segment, doc_ids, parts, ends, used = segment + 1, [], [], [], 0
        if doc_ids:
            yield one(pack_segment(shard, segment, doc_ids, np.concatenate(parts), np.concatenate(ends), id_bytes))

    def one(payload: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["payload"])

    sorted_docs = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange("id").sortWithinPartitions("id", "text")
    )
    packed = sorted_docs.mapInArrow(encode, "payload binary")
    packed.select(F.col("payload").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: ``shard, segment, place, doc_id, start`` (within the segment),
    ``n_tokens, ids_crc32``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for shard, segment, doc_ids, bounds, ids in unpack_segments(content.as_py()):
                    n = len(doc_ids)
                    for k in range(0, n, 65536):
                        ends = bounds.select(np.arange(k, min(n, k + 65536)))
                        begin = int(bounds.select(np.array([k - 1]))[0]) if k else 0
                        starts = np.concatenate(([begin], ends[:-1]))
                        sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                        m = len(ends)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, shard, np.int64)), pa.array(np.full(m, segment, np.int64)),
                             pa.array(np.arange(k, k + m)), pa.array(doc_ids[k : k + m], pa.int64()),
                             pa.array(starts.astype(np.int64)), pa.array((ends - starts).astype(np.int64)),
                             pa.array(sums, pa.int64())],
                            ["shard", "segment", "place", "doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(
        parse, "shard long, segment long, place long, doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_table(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` with ``start`` counted over all files.

    The offset of a segment is a running sum over its shard's segments plus one over the shards.
    """
    rows = written(read_token_files(spark, folder), "token-rows")
    segments = rows.groupBy("shard", "segment").agg(F.sum("n_tokens").alias("n"))
    shards = segments.groupBy("shard").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = segments.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(shards, "shard")
    bases = bases.select("shard", "segment", (F.col("before") + F.col("base")).alias("base"))
    return rows.join(bases, ["shard", "segment"]).select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_files")
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = new_folder(spark, "tokens")
    write_token_files(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path(), out)
    return token_table(spark, out)
