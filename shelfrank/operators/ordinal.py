"""Row numbers, running sums and sliding windows that survive very large groups.

A plain ``row_number() over (partition by user order by ts)`` sorts one user's rows in one
task. That is right for ordinary groups. When some group has more than ``ROWS_PER_TASK`` rows,
it is cut along its own order: by the blocks its caller names or, for a score, at quantiles of the group
itself, read from one sketch per group, into as many pieces as its size asks for. The sizes of the pieces (few,
pre-aggregated map-side) are summed up along the group, the rows themselves are sorted piece by
piece, on many tasks. Callers that know a bound on the group size say so; otherwise one
aggregation looks for large groups first. Null keys are a group like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import cut_lineage

ROWS_PER_TASK = 1_000_000
PIECES = 256  # quantiles read from one sketch; larger groups are cut again, piece by piece
SKETCH = 1024  # items a sketch keeps per level: ranks are right to about 0.3 %


def split_ordinal(
    df: DataFrame,
    part: list[str],
    order: list[Column],
    blocks: list[Column],
    out: str = "ordinal",
    bucket_by: str | None = None,
    at_most: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, ... within ``part`` along ``order``.

    ``blocks`` go from coarse to fine and cut the groups above ``limit`` rows. Each must never
    fall along ``order`` among the rows that agree on the coarser ones; the result then
    does not depend on the choice. ``bucket_by`` names a numeric column that never rises along ``order``: groups
    are first cut along it, and ``blocks`` cut only pieces in which one value alone has more than ``limit`` rows.
    ``at_most`` is a bound on the group size that the caller can prove.
    """
    limit = limit or ROWS_PER_TASK
    row_number = F.row_number().over(Window.partitionBy(*part).orderBy(*order)).cast("long")
    if at_most is not None and at_most <= limit:
        return df.withColumn(out, row_number)
    keys = part or ["__all"]
    keyed = df if part else df.withColumn("__all", F.lit(0))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    large = cut_lineage(counts.where(F.col("__n") > limit).select(*keys))
    if large.isEmpty():
        return df.withColumn(out, row_number)

    # No more than rows / limit groups are in this list, so it may be broadcast.
    tagged = matched(keyed, F.broadcast(large.withColumn("__hot", F.lit(True))), keys, "left")
    names = [f"__block{i}" for i in range(len(blocks))]
    cut_here = F.col("__hot")
    if bucket_by is not None:
        tagged = cut_along(tagged, large, keys, bucket_by, limit, falling=True)
        names, cut_here = ["__piece", *names], F.col("__long")
    tagged = tagged.withColumns({n: F.when(cut_here, b) for n, b in zip(names[-len(blocks) :], blocks, strict=True)})
    sizes = cut_lineage(
        tagged.where(F.col("__hot")).groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("__size"))
    )
    starts = sizes.select(*keys, *names, F.lit(0).cast("long").alias("__start"))
    for depth in range(len(names), 0, -1):
        upto = keys + names[:depth]
        before = (
            Window.partitionBy(*keys, *names[: depth - 1])
            .orderBy(names[depth - 1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        level = sizes if depth == len(names) else sizes.groupBy(*upto).agg(F.sum("__size").alias("__size"))
        ahead = level.select(*upto, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__ahead"))
        starts = matched(starts, ahead, upto, "inner").withColumn("__start", F.col("__start") + F.col("__ahead"))
        starts = starts.drop("__ahead")
    within = Window.partitionBy(*keys, *names).orderBy(*order)
    numbered = tagged.withColumn(out, F.row_number().over(within).cast("long"))
    return (
        matched(numbered, starts, keys + names, "left")
        .withColumn(out, F.col(out) + F.coalesce(F.col("__start"), F.lit(0)))
        .select(*df.columns, out)
    )


def matched(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on columns of the same names where null equals null; each is kept once."""
    other = right.withColumnsRenamed({c: f"__of_{c}" for c in on})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in on])
    return left.join(other, same, how).drop(*[f"__of_{c}" for c in on])


def cut_along(
    rows: DataFrame, groups: DataFrame, keys: list[str], column: str, limit: int, falling: bool = False
) -> DataFrame:
    """Add ``__piece``, a place along a numeric column, and ``__long`` to the rows of ``groups``.

    Each group is cut at quantiles of its own, twice as many as its size asks for; pieces still above ``limit``
    rows are cut again, until they fit or hold one value only: these are ``__long``. A value that is a cut is a piece of its
    own, so every round separates something. Nulls come where ``column`` asc (or desc, with ``falling``) has
    them, first (last); NaN is the largest number. Rows of other groups all have the same piece.
    """
    value, sign = F.col(column).cast("double"), -1 if falling else 1
    known = value.isNotNull() & ~F.isnan(value)
    shares = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    names: list[str] = []
    whole: DataFrame | None = None
    left = groups.select(*keys)
    while True:
        at = keys + names
        inside = matched(rows, F.broadcast(left), at, "left_semi")
        sketch = inside.groupBy(*at).agg(
            F.kll_sketch_agg_double(F.when(known, value), F.lit(SKETCH)).alias("__sketch"),
            F.count(F.when(known, 1)).alias("__n"),
        )
        # Of 255 quantiles every stride-th is kept; strides are powers of two.
        wanted = F.greatest(F.ceil(F.log2(F.col("__n") * 2 / limit)), F.lit(1)).cast("int")
        stride = F.greatest(F.pow(F.lit(2), F.lit(PIECES.bit_length() - 1) - wanted), F.lit(1)).cast("int")
        quantiles = F.when(F.col("__n") > 0, F.kll_sketch_get_quantile_double("__sketch", shares))
        chosen = F.array_distinct(F.filter(quantiles, lambda _, i: (i + 1) % F.col("__stride") == 0))
        none = F.array().cast("array<double>")
        cuts = cut_lineage(
            sketch.withColumn("__stride", stride).select(*at, F.coalesce(chosen, none).alias("__cuts"))
        )
        below = F.size(F.filter("__cuts", lambda cut: cut < value))
        place = (
            F.when(F.col("__cuts").isNull(), 0)
            .when(value.isNull(), -sign)
            .when(F.isnan(value), sign * 2 * PIECES)
            .otherwise(sign * (2 * below + F.array_contains("__cuts", value).cast("int")))
        )
        name = f"__piece{len(names)}"
        # At most three cuts for each limit rows of the table.
        rows = matched(rows, F.broadcast(cuts), at, "left").withColumn(name, place).drop("__cuts")
        names.append(name)
        now = matched(rows, F.broadcast(left), at, "left_semi").groupBy(*keys, *names)
        sizes = now.agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias("__low"), F.max(value).alias("__high"))
        large = cut_lineage(sizes.where(F.col("__n") > limit))
        mixed = F.coalesce(F.col("__low") < F.col("__high"), F.lit(False))
        single = large.where(~mixed).select(*keys, *names)
        whole = single if whole is None else whole.withColumn(name, F.lit(0)).unionByName(single)
        left = large.where(mixed).select(*keys, *names)
        if left.isEmpty():
            break
    tagged = matched(rows, F.broadcast(whole.withColumn("__long", F.lit(True))), keys + names, "left")
    return tagged.withColumn("__piece", F.struct(*names)).drop(*names)


def rank_by_score(
    df: DataFrame,
    part: list[str],
    score: str,
    ties: list[Column] | None = None,
    tie_block: Column | None = None,
    out: str = "rank",
    at_most: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Position in the order (score falling, ties) within each group.

    A group above ``limit`` rows is cut at its own score quantiles, and by id range where many rows
    share a score, so neither its length nor such a score puts it into one task. Rows without a
    score come last.
    """
    last = F.floor(F.col("item_idx") / 4096) if tie_block is None else tie_block
    order = [F.col(score).desc(), *(ties or [F.col("item_idx")])]
    return split_ordinal(df, part, order, [last], out, bucket_by=score, at_most=at_most, limit=limit)


def global_rank(
    df: DataFrame,
    score: str,
    tie: str,
    out: str = "rank",
    tie_desc: bool = False,
    at_most: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Position in the order (score falling, tie-breaking id) over a whole table."""
    direction = F.col(tie).desc() if tie_desc else F.col(tie).asc()
    sign = -1 if tie_desc else 1
    block = F.floor(F.col(tie) * sign / 65536)
    return rank_by_score(df, [], score, [direction], block, out, at_most, limit)


def ranked_head(
    df: DataFrame,
    part: list[str],
    score: str,
    ties: list[Column],
    tie_block: Column,
    n: int,
    at_most: int | None = None,
    out: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group in the order (score falling, ties) with their position.

    A short head comes from a limit that every map task applies to its own rows; only a head of more rows than a
    task should sort ranks the whole group."""
    if n > ROWS_PER_TASK:
        whole = rank_by_score(df, part, score, ties, tie_block, out, at_most)
        return whole.where(F.col(out) <= n)
    order = [F.col(score).desc(), *ties]
    rows = df if part else df.orderBy(*order).limit(n)
    return top_ranked(rows, part, order, n, out).withColumn(out, F.col(out).cast("long"))


def running_sums(
    df: DataFrame, order: str, sums: list[str], descending: bool = False, limit: int | None = None
) -> DataFrame:
    """Add ``cum_<name>``: the sum of ``name`` up to and including the row.

    ``order`` must be unique (aggregate by it first); the aggregate is written out, as it is
    read up to three times here.
    """
    limit = limit or ROWS_PER_TASK
    table = cut_lineage(df)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if table.count() <= limit:
        so_far = Window.orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumns({f"cum_{s}": F.sum(s).over(so_far) for s in sums})
    one = table.withColumn("__all", F.lit(0))
    tagged = cut_along(one, one.select("__all").limit(1), ["__all"], order, limit, falling=descending).drop("__all", "__long")
    totals = tagged.groupBy("__piece").agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    before = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    # A few piece totals for each limit rows reach this window.
    offsets = totals.select(
        "__piece", *[F.coalesce(F.sum(f"__t_{s}").over(before), F.lit(0)).alias(f"__o_{s}") for s in sums]
    )
    within = Window.partitionBy("__piece").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.join(offsets, "__piece")
        .withColumns({f"cum_{s}": F.sum(s).over(within) + F.col(f"__o_{s}") for s in sums})
        .drop("__piece", *[f"__o_{s}" for s in sums])
    )


def sliding_context(
    df: DataFrame, part: str, ordinal: str, value: str, size: int, stretch: int = 4096
) -> DataFrame:
    """Add ``context``: the ``size`` values before each row, oldest first.

    ``ordinal`` numbers the rows of a group without gaps. A group is cut into stretches;
    the last ``size`` rows of one are repeated at the head of the next, so windows
    never need more than ``stretch + size`` rows at once.
    """
    home = F.floor((F.col(ordinal) - 1) / stretch)
    reaches_next = F.pmod(F.col(ordinal) - 1, F.lit(stretch)) >= stretch - size
    copies = F.when(reaches_next, F.array(home, home + 1)).otherwise(F.array(home))
    spread = df.withColumn("__home", home).withColumn("__stretch", F.explode(copies))
    window = (
        Window.partitionBy(part, "__stretch").orderBy(ordinal).rowsBetween(-size, -1)
    )
    return (
        spread.withColumn("context", F.collect_list(value).over(window))
        .where((F.col("__stretch") == F.col("__home")) & (F.size("context") == size))
        .drop("__home", "__stretch")
    )


def top_ranked(
    df: DataFrame, part: str | list[str], order: list[Column], k: int, out: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group with their position.

    Written as ``row_number() <= k``, which Spark turns into a per-task group limit before
    the shuffle: a hot group sends at most ``k`` rows per map task.
    """
    keys = [part] if isinstance(part, str) else part
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)
