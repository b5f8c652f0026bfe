"""Nearest neighbours by a block matrix join over int8 tiles.

Queries and candidates are dealt by hash into bounded blocks; a task gets one pair of blocks. It
multiplies the vectors rounded to int8, which gives every inner product up to a known error: with
``x = s*q + e`` the error of ``s*s'*(q.q')`` is at most ``|s*q|*|e'| + |e|*|x'|``. Only pairs whose upper
bound reaches the k-th best lower bound of their query are computed again from the original
vectors, and a heap per query keeps the best. The blocks' lists are merged by rank at last. The
result is exact.
"""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.common import table
from shelfrank.llm.registry import query
from shelfrank.operators.ordinal import top_ranked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
# Share of a bound added for rounding in the bounds themselves.
SLACK = 1e-5
SCHEMA = "query_id long, vec_id long, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows. Squares are taken of rows scaled to 1, so that they neither overflow nor vanish."""
    most = np.abs(x).max(1)
    most[most == 0] = 1.0
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, their scale, and the norms of the rounded vector and of the rest."""
    scale = np.maximum(np.abs(x).max(1) / 127, np.finfo(float).tiny)
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, norms(near), norms(x - near)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def best_of_tile(q_ids, q_vectors, c_ids, c_vectors, k: int) -> list[tuple[int, int, float]]:
    """The ``k`` nearest candidates of every query in one tile; ties to the smaller id."""
    x, y = q_vectors.astype(float), c_vectors.astype(float)
    qx, sx, near_x, rest_x = quantised(x)
    qy, sy, _, rest_y = quantised(y)
    norm_y = norms(y)
    # Products of int8 values add up to less than 2**24 in up to 1,040 dimensions: exact as float32.
    kind = np.float32 if x.shape[1] <= 1040 else np.float64
    # Scales of large and small vectors are multiplied first: either one alone could leave the range.
    with np.errstate(over="ignore", invalid="ignore"):
        product = (qx.astype(kind) @ qy.astype(kind).T) * (sx[:, None] * sy)
        error = near_x[:, None] * rest_y + rest_x[:, None] * norm_y
        error += SLACK * norms(x)[:, None] * norm_y
        lower, upper = product - error, product + error
    # Beyond the range of doubles bounds say nothing: such pairs are computed in full.
    unknown = ~(np.isfinite(lower) & np.isfinite(upper))
    lower[unknown], upper[unknown] = -np.inf, np.inf
    own = q_ids[:, None] == c_ids
    lower[own], upper[own] = -np.inf, -np.inf
    if len(c_ids) > k:
        floor = np.partition(lower, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
    else:
        floor = np.full(len(q_ids), -np.inf)
    rows, columns = np.nonzero((upper >= floor[:, None]) & ~own)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = exact_products(x[rows], y[columns])
    heaps: list[list] = [[] for _ in q_ids]
    for row, score, vec in zip(rows.tolist(), scores.tolist(), c_ids[columns].tolist(), strict=True):
        heap = heaps[row]
        # As in Spark's order, what is not a number comes before all numbers.
        entry = (math.inf, 1, -vec) if math.isnan(score) else (score, 0, -vec)
        if len(heap) < k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
    return [
        (int(q), -vec, math.nan if odd else score)
        for q, heap in zip(q_ids, heaps, strict=True)
        for score, odd, vec in heap
    ]


def _tile(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list = []
        if len(queries) and len(candidates):
            q, c = queries.combine_chunks(), candidates.combine_chunks()
            out = best_of_tile(
                q["vec_id"].to_numpy(), _matrix(q["embedding"].combine_chunks()),
                c["vec_id"].to_numpy(), _matrix(c["embedding"].combine_chunks()), k,
            )
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(v, t) for n, v, t in zip(("query_id", "vec_id", "score"), columns, kinds, strict=True)})

    return run


def nearest(
    queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` candidates with the largest inner product.

    Candidates with the query's own id take no part, nor rows whose id is null or whose vector is null,
    empty, all zero, or holds a null or a non-finite component. Vectors meet only vectors of their
    length. A repeated candidate counts every time; of a query id given several times the smallest vector is
    searched. Fewer candidates than ``k`` give fewer rows; empty tables none. Products beyond the range of doubles are
    infinite, or not a number where infinite terms cancel; the latter come first. Other columns do not matter.
    """
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col(id_col).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)
    shape = [F.col(id_col).cast("long").alias("vec_id"), vector.alias("embedding"), F.size(vector).alias("dim")]
    left = queries.where(usable).select(*shape).groupBy("vec_id").agg(F.min(F.struct("embedding", "dim")).alias("x"))
    left = left.select("vec_id", "x.embedding", "x.dim")
    right = candidates.where(usable).select(*shape)
    n_left = max(1, math.ceil(left.count() / QUERY_BLOCK))
    n_right = max(1, math.ceil(right.count() / CANDIDATE_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.select("dim", deal(n_left).alias("qb"), spread(n_right).alias("cb"), "vec_id", "embedding")
    right = right.select("dim", spread(n_left).alias("qb"), deal(n_right).alias("cb"), "vec_id", "embedding")
    keys = ["dim", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_tile(k), SCHEMA)
    ranked = top_ranked(found, "query_id", [F.col("score").desc(), F.col("vec_id")], k)
    return ranked.select("query_id", "rank", "vec_id", "score")


_SQL = """
WITH usable AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query("op4_nearest", _SQL)
def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)
