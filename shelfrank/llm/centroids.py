"""Centroid clustering over blocks along a Hilbert curve, with min/max boxes as zone maps.

Vectors are put in the order of a Hilbert curve through all their dimensions, which is cut into
blocks of near vectors; a block's box holds the smallest and largest value of every dimension. In each
round the box alone bounds the distance of every centroid to all vectors of the block: a centroid whose
least distance exceeds another one's largest distance cannot be the nearest of any of them. Only the
block's candidate centroids are compared with its vectors, exactly.

All arithmetic is exact. Whole numbers below ``SMALL`` have distances below 2**53, so float64 matrix
products of them are exact; blocks with larger ones are computed with Python's integers.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.common import table, written
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256
# Bits of the curve in each dimension; the grid has 2**BITS cells along it.
BITS = 2
SMALL = 1 << 20
LIMB = 40
LARGEST = (1 << 63) - 1
BLOCK_SCHEMA = "ids array<long>, vectors binary, low binary, high binary"
PART_SCHEMA = "cluster int, part int, limb int, value long"
ASSIGNED_SCHEMA = "vec_id long, cluster int, distance long"


def scaled(column: pa.Array, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)`` as whole float64 numbers."""
    flat = pa.concat_arrays([column]).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(len(column), -1) * scale)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of grid cells along the Hilbert curve, as bytes that sort in its order.

    The transposed form of the curve: undo the excess rotations from the highest bit on, Gray-encode, and
    take the bits of all dimensions in turn, highest first.
    """
    x = cells.astype(np.int64).T.copy()
    dims, n = x.shape
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            flip = (x[d] >> level & 1).astype(bool)
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    twist = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        twist ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= twist
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return np.packbits(planes.reshape(bits * dims, n).astype(np.uint8).T, axis=1)


def whole(x: np.ndarray) -> np.ndarray:
    """The same numbers in a type whose arithmetic is exact for them."""
    if x.size == 0 or np.abs(x).max() < SMALL:
        return x
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def candidates(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to some point of a box, rising."""
    under, over = low - centres, centres - high
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(1)
    most = (np.maximum(high - centres, centres - low) ** 2).sum(1)
    return np.flatnonzero((least <= most.min()).astype(bool))


def nearest_centres(x: np.ndarray, centres: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid among ``near``; ties to the smaller number."""
    c = centres[near]
    square = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    best = square.argmin(1)
    return near[best], square[np.arange(len(x)), best]


class Blocks:
    """Blocks of an Arrow batch, each with its numbers compared with the centroids that its box allows."""

    def __init__(self, centres: list[list[int]]):
        self.small = all(abs(v) < SMALL for row in centres for v in row)
        self.exact = np.empty((len(centres), len(centres[0])), object)
        self.exact[:] = centres
        self.centres = self.exact.astype(float) if self.small else self.exact

    def read(self, batches) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                low, high = (np.frombuffer(batch.column(k)[i].as_buffer(), float) for k in (2, 3))
                x = np.frombuffer(batch.column(1)[i].as_buffer(), float).reshape(len(ids), -1)
                centres = self.centres
                if not self.small or whole(np.array([low, high])).dtype == object:
                    centres, x = self.exact, x.astype(object)
                    x.ravel()[:] = [int(v) for v in x.ravel()]
                    low, high = (np.array([int(v) for v in side], object) for side in (low, high))
                yield ids, x, *nearest_centres(x, centres, candidates(low, high, centres))


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as ``sum(part << LIMB * place)``; parts of many numbers may be added up as longs."""
    sign, value, place = (-1, -value, 0) if value < 0 else (1, value, 0)
    while value:
        yield place, sign * (value & (1 << LIMB) - 1)
        value >>= LIMB
        place += 1


def _sums(centres: list[list[int]]):
    """Per task: sums of all components, and the count, of each centroid's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, total = Blocks(centres), {}
        for _, x, cluster, _ in blocks.read(batches):
            for c in np.unique(cluster).tolist():
                mine = x[cluster == c]
                found = [*map(int, mine.sum(0)), len(mine)]
                total[c] = [a + b for a, b in zip(total[c], found, strict=True)] if c in total else found
        rows = [(c, j, e, v) for c, parts in total.items() for j, part in enumerate(parts) for e, v in limbs(part)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "part", "limb", "value"])

    return run


def _assign(centres: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in Blocks(centres).read(batches):
            distance = [min(int(d), LARGEST) for d in distance]
            arrays = [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    return run


def usable_vectors(df: DataFrame, dims: int, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows with ``dims`` components, none null or non-finite after scaling."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where((F.size("vector") == dims) & finite)


def hilbert_blocks(vectors: DataFrame, dims: int, scale: float, size: int = BLOCK) -> DataFrame:
    """``ids, vectors, low, high``: the vectors in blocks of at most ``size`` along the curve, with their boxes.

    The grid's cuts lie around the mean of every dimension, one pass over the table. Rows are dealt by ranges of
    (place on the curve, vec_id, row), so equal vectors may fill several blocks. How the cuts fall
    decides the blocks only, never a result.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = np.clip(scaled(batch.column(0), scale), -1e100, 1e100)
            n, total, squares = n + len(x), total + x.sum(0), squares + (x * x).sum(0)
        arrays = [pa.array(range(dims), pa.int32()), pa.array([float(n)] * dims), pa.array(total), pa.array(squares)]
        yield pa.RecordBatch.from_arrays(arrays, ["dim", "n", "total", "squares"])

    found = vectors.select("vector").mapInArrow(moments, "dim int, n double, total double, squares double")
    found = found.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).orderBy("dim").collect()
    n, total, squares = (np.array([r[k] for r in found] or [0.0] * dims) for k in ("n", "total", "squares"))
    mean = total / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(n, 1) - mean**2, 0))
    # Cuts at equal shares of a bell curve: at 0 and 0.674 deviations for four cells.
    steps = np.linspace(-0.674, 0.674, 2**BITS - 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(batch.column(1), scale)
            cells = sum((x > mean + s * spread).astype(np.int64) for s in steps)
            keys = pa.array([k.tobytes() for k in hilbert_keys(cells, BITS)], pa.binary())
            rows = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, batch.column(0), rows], ["key", "vec_id", "row"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: pa.RecordBatch) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(rows.column(1).to_pylist()), float).reshape(len(rows), dims)
            ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.concat_arrays([rows.column(0)]))
            sides = [pa.array([side.tobytes()], pa.binary()) for side in (x, x.min(0), x.max(0))]
            return pa.RecordBatch.from_arrays([ids, *sides], ["ids", "vectors", "low", "high"])

        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= size:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                while len(rows) >= size:
                    yield block(rows.slice(0, size))
                    rows = rows.slice(size)
                held, waiting = [rows], len(rows)
        if waiting:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    rows = vectors.mapInArrow(keyed, "key binary, vec_id long, row binary")
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "vec_id", "at"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranged.select("vec_id", "row").mapInArrow(cut, BLOCK_SCHEMA)


def seed_key(vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit("2:"), vec_id.cast("string")), 256)


def cluster_vectors(
    df: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """Lloyd's rounds over whole numbers ``floor(scale * x)``, then one more assignment.

    Gives ``vec_id, cluster, distance`` per kept row, and the final centroids. Kept are rows with exactly ``dims``
    components, none null or non-finite (nor infinite after scaling); repeated rows each count. The first
    centroids are the ``k`` vectors with the smallest ``sha256("2:<vec_id>")``, ties by the vector, rows without an id
    last; fewer rows give fewer centroids, an empty table none and no rows. Of equal centroids the
    smaller number gets the vectors. A centroid becomes the exact floor of its vectors' mean; an empty one stays.
    Distances above the largest long are given as that. Other columns and their names play no part. Only ``k`` rows
    of ``dims`` numbers reach the driver and go back to the tasks in each round.
    """
    vectors = usable_vectors(df, dims, scale, id_col, vector_col)
    first = vectors.orderBy(seed_key(F.col("vec_id")).asc_nulls_last(), "vector").limit(k).collect()
    centres = [[int(v) for v in np.floor(np.array(r["vector"]) * scale)] for r in first]
    if not centres:
        return df.sparkSession.createDataFrame([], ASSIGNED_SCHEMA), centres
    blocks = written(hilbert_blocks(vectors, dims, scale), "hilbert")
    for _ in range(rounds):
        parts = blocks.mapInArrow(_sums(centres), PART_SCHEMA)
        sums = [[0] * (dims + 1) for _ in centres]
        for r in parts.groupBy("cluster", "part", "limb").agg(F.sum("value").alias("value")).collect():
            sums[r["cluster"]][r["part"]] += r["value"] << LIMB * r["limb"]
        centres = [[v // s[-1] for v in s[:-1]] if s[-1] else old for s, old in zip(sums, centres, strict=True)]
    return blocks.mapInArrow(_assign(centres), ASSIGNED_SCHEMA), centres


def _sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    ips = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT row, min_by(n, [d, n]) AS n, min(d) AS d FROM"
            f" (SELECT v.row, c.n, {ips} AS d FROM v CROSS JOIN c{i} c) GROUP BY row)"
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (SELECT a.n, u.j, sum(u.x)::HUGEINT AS s, count(*)::HUGEINT AS m FROM a{i} a
  JOIN (SELECT row, unnest(x) AS x, unnest(range({dims})) AS j FROM v) u USING (row) GROUP BY a.n, u.j),
m{i} AS (SELECT n, list(((s - ((s % m) + m) % m) // m)::DOUBLE ORDER BY j) AS x FROM s{i} GROUP BY n),
c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (n))"""
            )
    chain = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
  list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS n, x FROM
  (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k})),
{chain}
SELECT v.vec_id, a.n::INTEGER AS cluster, a.d::BIGINT AS distance,
  (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda e: e::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (row) JOIN c{rounds} c ON c.n = a.n
"""


@query("op11_centroids", _sql())
def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centres = cluster_vectors(table(spark, folder, "embeddings"))
    assigned = written(assigned, "assigned")
    # One row per centroid reaches the driver.
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    every = min(sum(per.values()), LARGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    rows = [(n, min(per.get(n, 0), LARGEST), every, digest) for n, digest in enumerate(digests)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
