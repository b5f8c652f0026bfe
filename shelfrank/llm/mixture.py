"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Everything is DataFrame work: sums per source, running sums over one row per source, and running
sums of hash buckets, again for what is missing. Only the bucket in which a source's quota ends is looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import listed, table, word_count, written
from shelfrank.llm.registry import query

# Fixed weights of the contract, repeating along the sorted sources.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42
BUCKETS = 4096


def cycling_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight``: the given ones in turn, sources in code point order, null last.

    Works on one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``source, source_size, weight``: weight times one common level, clamped at
    ``max_epochs`` times the size.

    Clamping the sources that are too small and sharing their excess by weight, again until none
    is above, ends at the level that this finds directly: with sources sorted by the level at which
    they are full, the first ``i`` are clamped for the smallest ``i`` whose next source isn't.
    """
    full = F.col("source_size") * max_epochs
    order = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.col("__all") - F.coalesce(F.sum(full).over(ahead), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    )
    found = sources.withColumn("__all", F.sum("source_size").over(whole)).withColumn("__level", level)
    open_ = F.when(F.col("__level") * F.col("weight") <= full, F.col("__level"))
    # Sources from the first open one on stay open: their common level is the one found there.
    common = F.first(open_, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    target = F.coalesce(common * F.col("weight"), full.cast("double"))
    return found.withColumn("target", target).drop("__all", "__level")


def _draw(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _named(sources: DataFrame) -> DataFrame:
    return sources.withColumnRenamed("source", "__of")


def _of_source() -> Column:
    return F.col("source").eqNullSafe(F.col("__of"))


def _drawn(docs: DataFrame, quota: str) -> DataFrame:
    """Add ``__once``: the first documents of each source in the order of the draw up to the quota.

    Documents larger than the quota are passed over; the first one that does not fit ends the draw. Buckets before the
    one in which the quota ends are taken whole.
    """
    fits = (F.col("size") > 0) & (F.col("size") <= F.col(quota))
    cells = docs.where(fits).groupBy("source", "__bucket").agg(F.sum("size").alias("__cell"), F.first(quota).alias("__limit"))
    running = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    spread = cells.withColumn("__before", F.coalesce(F.sum("__cell").over(running), F.lit(0))).where("__before <= __limit")
    spread = written(
        spread.select(F.col("source").alias("__of"), F.col("__bucket").alias("__in"), "__before", "__cell"), "spread"
    )
    placed = docs.join(spread, _of_source() & (F.col("__bucket") == F.col("__in")), "left")
    upto = F.col("__before") + F.col("__cell")
    ends = F.coalesce(fits & (upto > F.col(quota)), F.lit(False))
    sure = placed.where(~ends).withColumn("__once", F.coalesce(fits & (upto <= F.col(quota)), F.lit(False)))
    inside = Window.partitionBy("source", "__bucket").orderBy("__draw", "__id", "__row").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where(ends).withColumn("__once", F.col("__before") + F.sum("size").over(inside) <= F.col(quota))
    return sure.unionByName(edge).drop("__of", "__in", "__before", "__cell")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """How often the mix repeats every document: ``id, size, source_size, target, repeats, taken``.

    A source with target ``e`` times its size repeats each document ``floor(e)`` times, and once more
    those that come first in a seeded hash order, as long as they fit into what is missing; documents larger than
    that are passed over, and the draw goes on for the rest until no document left out fits. A source thus
    misses its target by less than the smallest document left out. Null and empty texts have size 0 and count as taken whole
    times only; null sources form a source of their own. Repeated rows are separate documents. An empty
    table gives no rows. ``extra`` columns are carried along.
    """
    sized = docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        _draw(id_col, text_col, seed).alias("__draw"), F.monotonically_increasing_id().alias("__row"),
        *[F.col(c) for c in extra],
    )
    sized = sized.withColumn("__bucket", F.pmod(F.shiftrightunsigned("__draw", 20), F.lit(buckets)).cast("int"))
    sized = written(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = water_fill(cycling_weights(totals, weights), max_epochs)
    size = F.col("source_size")
    whole = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(max_epochs))).otherwise(0).cast("long")
    plan = plan.withColumn("__whole", whole).withColumn(
        "__quota", F.floor(F.col("target") - F.col("__whole") * size).cast("long")
    )
    plan = written(plan.select("source", "source_size", "target", "__whole", "__quota"), "plan")
    drawn = written(_drawn(sized.join(_named(plan), _of_source()).drop("__of"), "__quota"), "drawn")
    # Documents passed over get what is missing, until none of them fits.
    taken = drawn.where("__once").groupBy("source").agg(F.sum("size").alias("__taken"))
    rest = plan.join(_named(taken), _of_source(), "left").select(
        "source", (F.col("__quota") - F.coalesce("__taken", F.lit(0))).alias("__rest")
    )
    rest = written(rest, "missing")
    free = drawn.where(~F.col("__once") & (F.col("size") > 0)).select("source", "size", "__draw", "__id", "__row", "__bucket")
    fills = None
    while True:
        free = free.join(_named(rest), _of_source()).drop("__of").where("size <= __rest")
        free = written(free, "free")
        if free.isEmpty():
            break
        more = written(_drawn(free, "__rest"), "more")
        now = more.where("__once").select("__row")
        fills = now if fills is None else fills.unionByName(now)
        taken = more.groupBy("source").agg((F.first("__rest") - F.sum(F.when(F.col("__once"), F.col("size")))).alias("__rest"))
        rest = written(taken, "missing")
        free = more.where(~F.col("__once")).drop("__rest", "__once")
    joined = drawn.withColumn("__fills", F.lit(None))
    if fills is not None:
        joined = drawn.join(listed(fills.withColumn("__fills", F.lit(1))), "__row", "left")
    repeats = F.col("__whole") + F.when(F.col("__once") | F.col("__fills").isNotNull(), 1).otherwise(0)
    return joined.select(
        F.col("__id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"),
        (repeats * F.col("size")).alias("taken"), *extra,
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken; same columns, whatever the names of the others."""
    held = docs.select("doc_id", F.struct("*").alias("__doc"), "text", "source")
    marked = mix(held, extra=("__doc",), **settings).where("repeats > 0")
    copies = marked.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return copies.select("__doc.*")


@query("op10_source_mix")
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
