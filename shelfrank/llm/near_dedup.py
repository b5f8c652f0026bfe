"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, components.

Every document's set of word shingles gives MinHash samples. Bands of samples put similar sets into common
buckets. The samples are also folded into an odd sketch, a bitmap in which each sample
flips one bit: the number of ones in the XOR of two sketches tells a high similarity precisely, so
pairs that are clearly too different go before any set is fetched. What is left is confirmed on
the full sets, and linked sets form components.

Nothing lists all pairs of a bucket. Equal sets are one node. Each node is first compared with its
most similar bucket hub, then with its other hubs, and last, where a bucket still holds several components,
the nodes outside its largest component are compared with the rest, sketch first. A pair is told in one of its buckets only.

In long buckets the shingles that one node alone has are counted before that. They are in no intersection, which bounds
the similarity of every pair from above: what cannot reach the threshold is not compared. The node with the smallest share
of them stands in the middle of its bucket and is one more hub. The rest of a long bucket is compared block by block.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import (
    SMALL_SLICE,
    SPACE_WORDS,
    Words,
    components,
    listed,
    mixed,
    run_hash,
    small_batches,
    table,
    text_slices,
    written,
)
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, BAND_ROWS = 32, 5
SAMPLES = 512
SKETCH_BITS = 2048
# Standard deviations of the samples below the threshold at which a sketch still passes.
MARGIN = 4.5
SEED = 20_24
# Nodes above which a bucket with several components is long.
LONG = 64
# About how many of its nodes are compared with as many others at once, pairs of such blocks that go to Python and pairs
# of nodes in one step there.
BLOCK, BLOCK_PAIRS, STEP = 128, 24, 1 << 13
# Shingles that go to Spark at a time.
VALUES = 1 << 16


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted, one row after another, and how many each has.

    Shorter texts have their whole sequence of words as their only shingle; texts without words none.
    """
    found = Words(column, SPACE_WORDS)
    every, whole = found.shingles(words)
    short = np.flatnonzero((found.counts > 0) & (found.counts < words))
    sets, sizes = [], np.zeros(found.rows, np.int64)
    single = dict.fromkeys(short.tolist())
    for row in range(found.rows):
        a, b = found.first[row], found.first[row + 1]
        if row in single:
            own = run_hash([found.hash[a + k : a + k + 1] for k in range(b - a)])
        else:
            own = np.unique(every[a : max(a, b - words + 1)])
        sizes[row] = len(own)
        sets.append(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), sizes


def min_hashes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``SAMPLES`` MinHash values of every set that isn't empty."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    filled = sizes[sizes > 0]
    starts = np.cumsum(filled) - filled
    out = np.empty((len(filled), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(short * factors[k] + shifts[k], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per row and band."""
    wide = samples[:, : BANDS * BAND_ROWS].astype(np.uint64).reshape(len(samples), BANDS, BAND_ROWS)
    keys = run_hash([wide[:, :, k] + np.uint64(k) for k in range(BAND_ROWS)])
    return mixed(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as 64-bit words."""
    n = len(samples)
    item = mixed(samples.astype(np.uint64) * np.uint64(SAMPLES) + np.arange(SAMPLES, dtype=np.uint64))
    bit = (item % np.uint64(SKETCH_BITS)).astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    odd = (np.bincount(bit.ravel(), minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def sketch_limit(similarity: float, margin: float = MARGIN) -> int:
    """Most differing bits of two sketches that may still reach the similarity; without a margin half of those that just do."""
    spread = math.sqrt(similarity * (1 - similarity) / SAMPLES)
    least = max(0.0, similarity - margin * spread)
    flips = 2 * SAMPLES * (1 - least)
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips)
    # Flips that meet in one bit undo each other; their number varies as well.
    return math.ceil(expected + 3 * margin / MARGIN * flips * math.sqrt(2 / SKETCH_BITS))


def _set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits that name each set that isn't empty."""
    filled = sizes[sizes > 0]
    starts = np.cumsum(filled) - filled
    one = np.add.reduceat(mixed(values + np.uint64(0x51ED270B)), starts)
    two = np.add.reduceat(mixed(values ^ np.uint64(0xA3B195354A39B70D)), starts) + filled.astype(np.uint64)
    return np.stack([mixed(one), mixed(two)], 1)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SMALL_SLICE):
            values, sizes = shingle_sets(part.column("text"), words)
            filled = sizes > 0
            n = int(filled.sum())
            nulls = ~filled
            if n:
                samples = min_hashes(values, sizes)
                keys, bands, sketches = _set_keys(values, sizes), band_keys(samples), odd_sketches(samples)
            place = np.cumsum(filled) - 1
            names = [None if nulls[i] else keys[place[i]].tobytes() for i in range(len(sizes))]
            band_rows = [None if nulls[i] else bands[place[i]] for i in range(len(sizes))]
            sketch_rows = [None if nulls[i] else sketches[place[i]] for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("mark"), pa.array(sizes), pa.array(names, pa.binary()),
                 pa.array(band_rows, pa.list_(pa.int64())), pa.array(sketch_rows, pa.list_(pa.int64()))],
                ["id", "mark", "n_shingles", "node", "bands", "sketch"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SMALL_SLICE):
            values, sizes = shingle_sets(part.column("text"), words)
            ends = np.cumsum(sizes)
            filled = np.flatnonzero(sizes)
            if len(filled):
                keys = _set_keys(values, sizes)
                rows = [values[ends[i] - sizes[i] : ends[i]].tobytes() for i in filled]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(rows, pa.binary())], ["node", "values"]
                )

    return run


def _each_value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, values in zip(batch.column("node"), batch.column("values"), strict=True):
            found = np.frombuffer(values.as_buffer(), np.int64)
            for k in range(0, len(found), VALUES):
                part = pa.array(found[k : k + VALUES])
                yield pa.RecordBatch.from_arrays([pa.repeat(node, len(part)), part], ["node", "value"])


def _confirm(percent: int):
    """Keep pairs with 100 * intersection >= percent * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left_values"), batch.column("right_values")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep[i] = 100 * shared >= percent * (len(a) + len(b) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _pairs_of(column: pa.Array) -> np.ndarray:
    """Names of nodes as two numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


class Block:
    """Nodes of one bucket as arrays."""

    def __init__(self, rows: pa.StructArray):
        self.node, root = rows.field("node"), rows.field("root")
        self.root = _pairs_of(root)
        self.size, self.own = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("n_shingles", "own"))
        sketch, bands = (rows.field(n).flatten().to_numpy(zero_copy_only=False) for n in ("sketch", "bands"))
        # Of a negative number, the ones of its absolute value would be counted.
        self.sketch, self.bands = sketch.view(np.uint64).reshape(len(rows), -1), bands.reshape(len(rows), -1)


def _close_blocks(percent: int, above: int, limit: int):
    """Pairs of two blocks of a bucket: of different components, not ruled out by their own shingles, with more than ``above`` and
    at most ``limit`` differing bits, and with no smaller bucket in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, left, right, same in zip(*(batch.column(n) for n in ("bucket", "x", "y", "same")), strict=True):
                x, y = Block(left.values), Block(right.values)
                able = (x.root[:, None] != y.root[None]).any(2)
                able &= (100 + percent) * np.minimum(x.own[:, None], y.own) >= percent * (x.size[:, None] + y.size)
                if same.as_py():  # each pair once
                    able = np.triu(able, 1)
                every_a, every_b = np.nonzero(able)
                for k in range(0, len(every_a), STEP):
                    a, b = every_a[k : k + STEP], every_b[k : k + STEP]
                    bits = np.bitwise_count(x.sketch[a] ^ y.sketch[b]).sum(1, dtype=np.int64)
                    keep = (bits > above) & (bits <= limit)
                    a, b = a[keep], b[keep]
                    shared = np.where(x.bands[a] == y.bands[b], x.bands[a], np.iinfo(np.int64).max)
                    keep = shared.min(1, initial=np.iinfo(np.int64).max) == bucket.as_py()
                    yield pa.RecordBatch.from_arrays([x.node.take(pa.array(a[keep])), y.node.take(pa.array(b[keep]))], ["a", "b"])

    return run


def differing_bits(left: Column, right: Column) -> Column:
    parts = [F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(SKETCH_BITS // 64)]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


class NearDuplicates:
    """Links between the shingle sets of a table of texts."""

    def __init__(self, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, mark: Column | None = None):
        self.percent, self.words, self.sets, self.lone = percent, words, None, None
        self.texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        id_type = self.texts.schema["id"].dataType.simpleString()
        # What tells rows of one id apart, where asked for.
        marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.lit(None).cast("binary") if mark is None else mark).alias("mark"))
        self.prints = written(
            marked.mapInArrow(
                _fingerprints(words),
                f"id {id_type}, mark binary, n_shingles long, node binary, bands array<long>, sketch array<long>",
            ),
            "prints",
        )
        limit = F.lit(sketch_limit(percent / 100))
        self.close = lambda left, right: differing_bits(left, right) <= limit
        # One row per set: equal sets have equal samples.
        filled = self.prints.where("node is not null")
        once = filled.groupBy("node").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")])
        self.nodes = written(once, "nodes")

    def components(self) -> DataFrame:
        """``node, root`` of all nodes with a link."""
        keyed = self.nodes.select("node", F.explode("bands").alias("bucket"))
        hubs = keyed.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub != last")
        shared = written(keyed.join(hubs.select("bucket", "hub"), "bucket"), "shared")
        edges = shared.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        edges = written(self.close_pairs(edges), "candidates")
        self.add_sets(edges)
        best = edges.groupBy("a").agg(F.min_by("b", F.struct("bits", "b")).alias("b"))
        links = written(self.confirmed(best), "links")
        roots = written(components(links), "roots")
        open_edges = self.apart(edges.select("a", "b"), roots)
        self.lone = self.lone_shingles(shared, roots)
        if self.lone is not None:
            middle = written(self.middles(shared, roots), "middles")
            self.add_sets(middle)
            links = links.unionByName(written(self.confirmed(middle), "links"))
            roots = written(components(links), "roots")
        limit = sketch_limit(self.percent / 100)
        rest = written(self.rest(shared, roots, -1, limit).unionByName(open_edges), "rest")
        self.add_sets(rest)
        links = links.unionByName(written(self.confirmed(rest), "links"))
        return written(components(links), "roots")

    def close_pairs(self, edges: DataFrame) -> DataFrame:
        """Pairs ``a, b`` whose sketches differ in few enough bits, with their number."""
        one = self.nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
        two = self.nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
        both = edges.join(one, "a").join(two, "b")
        return both.where(self.close(F.col("sa"), F.col("sb"))).select(
            "a", "b", differing_bits(F.col("sa"), F.col("sb")).alias("bits")
        )

    @staticmethod
    def labelled(df: DataFrame, roots: DataFrame, name: str, out: str) -> DataFrame:
        """Add the component of the node ``name``; a node without links is its own."""
        own = roots.select(F.col("node").alias(name), F.col("root").alias("__root"))
        return df.join(own, name, "left").withColumn(out, F.coalesce("__root", name)).drop("__root")

    def apart(self, edges: DataFrame, roots: DataFrame) -> DataFrame:
        """Edges between different components."""
        both = self.labelled(self.labelled(edges, roots, "a", "ra"), roots, "b", "rb")
        return both.where("ra != rb").select("a", "b")

    def mixed(self, shared: DataFrame, roots: DataFrame) -> DataFrame:
        """Rows of the buckets with several components: ``bucket, node, root, largest, n_rows``."""
        placed = self.labelled(shared.select("bucket", "node"), roots, "node", "root")
        counts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
        mixed_ones = (
            counts.groupBy("bucket")
            .agg(
                F.count(F.lit(1)).alias("roots"),
                F.max_by("root", F.struct("n", "root")).alias("largest"),
                F.sum("n").alias("n_rows"),
            )
            .where("roots > 1").select("bucket", "largest", "n_rows")
        )
        return placed.join(mixed_ones, "bucket")

    def lone_shingles(self, shared: DataFrame, roots: DataFrame) -> DataFrame | None:
        """``node, n_shingles, lone`` of the nodes in long buckets with several components: how many of a node's shingles no
        other such node has. None without such buckets. Links only make these buckets fewer, so the numbers stay bounds."""
        nodes = written(self.mixed(shared, roots).where(F.col("n_rows") > LONG).select("node").distinct(), "long")
        if nodes.isEmpty():
            return None
        self.add_sets(nodes.select(F.col("node").alias("a"), F.col("node").alias("b")))
        values = self.sets.join(nodes, "node", "left_semi").mapInArrow(_each_value, "node binary, value long")
        once = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
        lone = once.groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
        every = self.nodes.select("node", "n_shingles").join(nodes, "node", "left_semi").join(lone, "node", "left")
        return written(every.fillna(0, ["lone"]), "lone")

    def may_reach(self, own: Column, size: Column, own_2: Column, size_2: Column) -> Column:
        """Whether two sets of which no more than the ``own`` shingles are shared can be similar enough."""
        return (100 + self.percent) * F.least(own, own_2) >= self.percent * (size + size_2)

    def middles(self, shared: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of a node in a long bucket and the bucket's middle, if in different components and close."""
        rows = self.mixed(shared, roots).where(F.col("n_rows") > LONG).join(self.lone, "node")
        own = F.col("n_shingles") - F.col("lone")
        rows = rows.select("bucket", F.struct("node", "root", "n_shingles", own.alias("own")).alias("x"))
        share = F.struct((F.col("x.own") / F.col("x.n_shingles")).alias("share"), F.col("x.node").alias("node"))
        both = rows.join(rows.groupBy("bucket").agg(F.max_by("x", share).alias("y")), "bucket")
        able = self.may_reach(F.col("x.own"), F.col("x.n_shingles"), F.col("y.own"), F.col("y.n_shingles"))
        apart = both.where((F.col("x.root") != F.col("y.root")) & able)
        return self.close_pairs(apart.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()).select("a", "b")

    def rest(self, shared: DataFrame, roots: DataFrame, above: int, limit: int) -> DataFrame:
        """Pairs of one bucket and different components whose sizes are close and whose sketches differ in more than
        ``above``, at most ``limit`` bits. Pairs with fewer have been compared while their components were smaller.

        Sets this similar differ in size by at most the threshold: their size classes, in steps
        of it, are equal or neighbours. Nor is a pair listed whose lone shingles already rule it out.
        """
        size = F.floor(F.log("n_shingles") / math.log(100 / self.percent)).cast("int").alias("size")
        held = self.mixed(shared, roots).join(self.nodes.select("node", "n_shingles", size, "sketch", "bands"), "node")
        own = F.col("n_shingles")
        if self.lone is not None:
            held = held.join(self.lone.select("node", "lone"), "node", "left")
            # Outside long buckets other nodes may have these shingles too.
            own = own - F.when(F.col("n_rows") > LONG, F.coalesce("lone", F.lit(0))).otherwise(F.lit(0))
        held = held.withColumn("own", own).where(100 * F.col("own") >= self.percent * F.col("n_shingles"))
        every = written(held.drop("lone"), "mixed")
        held, long = every.where(F.col("n_rows") <= LONG), every.where(F.col("n_rows") > LONG)
        around = F.explode(F.array([F.col("size") + d for d in (-1, 0, 1)])).alias("size")
        minor = held.where("root != largest").select("bucket", "node", "root", "n_shingles", "own", "sketch", "bands", around).alias("x")
        bits = differing_bits(F.col("x.sketch"), F.col("y.sketch"))
        close = bits <= limit if above < 0 else bits.between(above + 1, limit)
        # Both stand in all of their common buckets.
        first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket")
        # Both outside the largest component: each pair once.
        once = (F.col("y.root") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node"))
        same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.size") == F.col("y.size"))
        able = self.may_reach(F.col("x.own"), F.col("x.n_shingles"), F.col("y.own"), F.col("y.n_shingles"))
        on = same & (F.col("x.root") != F.col("y.root")) & once & able & close & first
        few = minor.join(held.alias("y"), on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        return few if self.lone is None else few.unionByName(self.rest_of_long(long, above, limit))

    def rest_of_long(self, held: DataFrame, above: int, limit: int) -> DataFrame:
        """The same of long buckets, whose nodes outside the largest component meet all others block by block."""
        slot = F.pmod(F.xxhash64("node"), F.ceil(F.col("n_rows") / BLOCK)).alias("slot")
        one = F.struct("node", "root", "n_shingles", "own", "sketch", "bands").alias("one")
        rows = held.select("bucket", (F.col("root") != F.col("largest")).alias("minor"), slot, one)
        blocks = rows.groupBy("bucket", "minor", "slot").agg(F.collect_list("one").alias("block"))
        same = F.col("y.minor") & (F.col("x.slot") == F.col("y.slot"))
        on = (F.col("x.bucket") == F.col("y.bucket")) & (~F.col("y.minor") | (F.col("x.slot") <= F.col("y.slot")))
        both = blocks.where("minor").alias("x").join(blocks.alias("y"), on).select(
            "x.bucket", F.col("x.block").alias("x"), F.col("y.block").alias("y"), same.alias("same")
        )
        with small_batches(held.sparkSession, BLOCK_PAIRS):
            return written(both.mapInArrow(_close_blocks(self.percent, above, limit), "a binary, b binary"), "close")

    def add_sets(self, pairs: DataFrame) -> None:
        """Build the sets of the pairs' nodes from their texts, unless they are there already."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node"), "node", "left_anti")
        wanted = written(self.nodes.select("node", "id").join(wanted, "node", "left_semi"), "wanted")
        ids = listed(wanted.select("id").distinct())
        found = self.texts.join(ids, self.texts["id"].eqNullSafe(ids["id"]), "left_semi").select("text").mapInArrow(_sets(self.words), "node binary, values binary")
        found = written(found.join(listed(wanted.select("node")), "node", "left_semi").dropDuplicates(["node"]), "sets")
        self.sets = found if self.sets is None else self.sets.unionByName(found)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs similar enough on their full sets."""
        joined = pairs.join(self.sets.select(F.col("node").alias("a"), F.col("values").alias("left_values")), "a").join(
            self.sets.select(F.col("node").alias("b"), F.col("values").alias("right_values")), "b"
        )
        return joined.select("a", "b", "left_values", "right_values").mapInArrow(
            _confirm(self.percent), "a binary, b binary"
        )


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id, kept``.

    Documents are linked when the sets of their lower-case (A-Z) ``words``-word shingles share at least
    ``percent`` hundredths of their union; ``component_id`` is the smallest id reachable, ``kept`` whether
    that is the row's own. A text with fewer words is one shingle. Null, empty and
    white texts are linked with nothing and stay. Repeated rows give repeated rows. A null id
    is passed over as smallest id; such a row stays only if its whole component has none.
    """
    with small_batches(docs.sparkSession):
        found = _decided(NearDuplicates(docs, words, percent, id_col, text_col))
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _decided(job: NearDuplicates) -> DataFrame:
    """``id, mark, n_shingles, component_id, kept`` of every row."""
    roots = job.components()
    placed = job.labelled(job.prints.select("id", "mark", "n_shingles", "node"), roots, "node", "root")
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    out = placed.join(smallest, "root", "left").withColumn(
        "component_id", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates; same columns.

    Rows go by id and text: of rows that share an id, also none, only those that are near copies. Names of
    other columns do not matter.
    """
    with small_batches(docs.sparkSession):
        found = _decided(NearDuplicates(docs, words, percent, "doc_id", "text", F.unhex(F.md5("text"))))
    dropped = found.where(~F.col("kept")).select("id", "mark").distinct()
    held = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("id")) & F.unhex(F.md5("doc.text")).eqNullSafe(F.col("mark"))
    return held.join(dropped, same, "left_anti").select("doc.*")


_SQL = r"""
WITH toks AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM toks WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM toks WHERE len(w) IN (1, 2)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (WITH RECURSIVE r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM r JOIN both_ways b ON b.x = r.other)
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM reach LEFT JOIN sizes USING (doc_id)
"""


@query("op7_near_dedup", _SQL)
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=3, percent=85)
