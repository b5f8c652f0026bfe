"""Top-k unseen items from a ranked catalogue, without pairing users and items.

Let a catalogue be ranked 1, 2, 3, ... and let a user have seen the ranks
``s_1 < s_2 < ...``. Before ``s_j`` lie ``s_j - j`` unseen items, so the n-th unseen item
has rank ``n + #{j : s_j - j < n}``. One pass over the log finds it; the work grows with
the log plus ``k`` rows per user, never with users times items.

A user who has seen ``m`` of the first ``h`` items finds ``k`` unseen ones among them where ``m + k <= h``. So
``first_unseen`` reads the head of the ranking only, and a longer one where some user has seen too much of it: log rows
of other items go while they are scanned, before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.ordinal import split_ordinal
from shelfrank.session import cut_lineage

_HEAD = 1024
_COPIES = 32
# First length of the head, up to which Spark cuts rankings per map task, and its growth from round to round.
FIRST, GROWTH = 1000, 16
LISTED = 300_000  # rows of a head that every task may get
SHARED = 10_000  # users from which on one of many rankings is copied


def first_unseen(
    users: DataFrame,
    head_of: Callable[[int], DataFrame],
    seen: DataFrame | None,
    k: int,
    catalogue: int,
    by: list[str] | None = None,
    who: list[str] | None = None,
    work: list | None = None,
) -> DataFrame:
    """The first ``k`` unseen items of every user, as ``unseen_at`` gives them for whole rankings.

    ``head_of(n)`` gives the rows of the ranking (one for each value of ``by``, which is part of ``who``) with ranks up to
    ``n``; ``catalogue`` is the number of items. ``work``, if given, takes the lengths of the heads that were read."""
    who, by, size = who or ["user_idx"], by or [], max(FIRST, 2 * k)
    while True:
        size = min(size, max(catalogue, 1))
        if work is not None:
            work.append(size)
        head = cut_lineage(head_of(size))
        listed = head.count() <= LISTED
        held = F.broadcast(head) if listed else head
        asked = users.select(*who)
        if seen is None:
            shifts = asked.withColumn("__shift", F.array_repeat(F.lit(0).cast("long"), k))
            break
        pairs = seen.select(*who, "item_idx").join(held.select("item_idx", "rank", *by), ["item_idx", *by])
        counts = _passed(pairs.select(*who, "rank").distinct(), who, k, size)
        if size < catalogue:
            counts = cut_lineage(counts)
            if (counts.agg(F.max("__seen")).first()[0] or 0) + k > size:
                size *= GROWTH
                continue
        none = F.array_repeat(F.lit(0).cast("long"), k)
        shifts = asked.join(counts.drop("__seen"), who, "left").withColumn("__shift", F.coalesce("__shift", none))
        break
    picked = shifts.select(*who, F.posexplode("__shift").alias("nth", "rank")).select(
        *who, (F.col("nth") + 1).alias("nth"), (F.col("rank") + F.col("nth") + 1).alias("rank")
    )
    if not listed:
        return _spread_lookup(picked, head, who, by)
    carried = [c for c in head.columns if c not in ("rank", *by)]
    return picked.join(held, ["rank", *by]).select(*who, *carried, "nth")


def _passed(placed: DataFrame, who: list[str], k: int, at_most: int) -> DataFrame:
    """Per user how many seen ranks lie before their n-th unseen item, as an array, and how many were given."""
    numbered = split_ordinal(
        placed, who, [F.col("rank")], [F.floor(F.col("rank") / 4096)], "__before", at_most=at_most
    ).withColumn("__gap", F.col("rank") - F.col("__before"))
    passed = [F.sum(F.when(F.col("__gap") < n, 1).otherwise(0)).cast("long") for n in range(1, k + 1)]
    return numbered.groupBy(*who).agg(F.array(*passed).alias("__shift"), F.count(F.lit(1)).alias("__seen"))


def unseen_at(
    users: DataFrame,
    ranked: DataFrame,
    seen: DataFrame | None,
    k: int,
    wanted: Column | None = None,
    by: list[str] | None = None,
    who: list[str] | None = None,
    catalogue: int | None = None,
) -> DataFrame:
    """Items at chosen positions among each user's unseen items.

    ``ranked`` has ``item_idx`` and ``rank`` (1, 2, ... without gaps within ``by``); ``by`` names the
    columns, present in ``users`` too, that choose one of several rankings. ``wanted`` is an
    array column of ``k`` positions held by ``users``; without it the first ``k`` are taken.
    ``who`` is the key of ``users`` and ``seen`` (``user_idx`` unless given).
    ``catalogue`` is the number of items, which bounds what one user can have seen.
    Returns ``who``, ``by``, the other columns of ``ranked`` and ``nth``, the place in the list.
    Positions past the end of a ranking give no row.
    """
    who = who or ["user_idx"]
    by = by or []
    keys = who + [c for c in by if c not in who]
    first_k = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda n: n.cast("long"))
    asked = users.select(*keys, (first_k if wanted is None else wanted).alias("__wanted"))
    if seen is None:
        shifts = asked.withColumn("__shift", F.transform("__wanted", lambda n: F.lit(0).cast("long")))
    else:
        pairs = seen.select(*who, "item_idx").distinct()
        if wanted is not None:
            pairs = pairs.join(asked, who)
        elif not set(by) <= set(who):
            pairs = pairs.join(asked.drop("__wanted"), who)
        placed = pairs.join(ranked.select("item_idx", "rank", *by), ["item_idx", *by])
        numbered = split_ordinal(
            placed.select(*who, "rank", *([] if wanted is None else ["__wanted"])),
            who,
            [F.col("rank")],
            [F.floor(F.col("rank") / 4096)],
            "__before",
            at_most=catalogue,
        ).withColumn("__gap", F.col("rank") - F.col("__before"))
        if wanted is None:
            # Rows of the log do not carry these through the shuffles.
            numbered = numbered.withColumn("__wanted", first_k)
        counts = numbered.groupBy(*who).agg(
            *[
                F.sum(F.when(F.col("__gap") < F.get("__wanted", F.lit(i)), 1).otherwise(0)).alias(f"__s{i}")
                for i in range(k)
            ]
        )
        shifts = asked.join(counts, who, "left").withColumn(
            "__shift", F.array(*[F.coalesce(F.col(f"__s{i}"), F.lit(0).cast("long")) for i in range(k)])
        )
    picked = shifts.select(
        *keys, F.posexplode(F.zip_with("__wanted", "__shift", lambda n, shift: n + shift)).alias("nth", "rank")
    ).withColumn("nth", F.col("nth") + 1)
    hot = None
    if not set(by) <= set(who):
        # One ranking of many: only those that many users share are copied. At most users / SHARED of them.
        sizes = users.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
        hot = F.broadcast(cut_lineage(sizes.where(F.col("__n") > SHARED).select(*by, F.lit(True).alias("__hot"))))
    return _spread_lookup(picked.where(F.col("rank").isNotNull()), ranked, keys, by, hot)


def _spread_lookup(
    picked: DataFrame, ranked: DataFrame, keys: list[str], by: list[str], hot: DataFrame | None = None
) -> DataFrame:
    """Join picks to the ranking. Nearly every user picks from the head of it, so the
    head's rows exist in several copies and each user reads one of them. With ``hot`` only the rankings it names do."""
    carried = [c for c in ranked.columns if c not in ("rank", *by)]
    head = F.col("rank") <= _HEAD
    if hot is not None:
        picked, ranked = picked.join(hot, by, "left"), ranked.join(hot, by, "left")
        head = head & F.col("__hot").isNotNull()
    copies = F.when(head, F.sequence(F.lit(0), F.lit(_COPIES - 1))).otherwise(F.array(F.lit(0)))
    spread = ranked.withColumn("__copy", F.explode(copies))
    chosen = F.when(head, F.pmod(F.xxhash64(*keys), F.lit(_COPIES))).otherwise(F.lit(0))
    return (
        picked.withColumn("__copy", chosen.cast("int"))
        .join(spread.drop("__hot"), ["rank", "__copy", *by])
        .select(*keys, *carried, "nth")
    )
