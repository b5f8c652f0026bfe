"""Document fingerprints by SpotSigs, with DataFrame functions only.

The most common words of the corpus are anchors. Every anchor in a text, with the next ``CHAIN`` words that are no anchors,
is a signature; a fingerprint is the set of a text's signatures, so it follows the running prose and not
lists, menus or numbers. Likeness is the Jaccard similarity of two fingerprints. ``near_fingerprints`` finds all like pairs: sets
are partitioned by length so that only neighbouring partitions can hold like sets, meet through their
rarest signatures, and are compared if their lengths allow the threshold.

A word is a run of ASCII letters and digits and of any other characters, A-Z as a-z.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import table, written
from shelfrank.llm.registry import query

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words taken as anchors; at most a quarter of all different words.
ANCHORS = 64
CHAIN = 2


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order."""
    words = F.split(F.translate(text, UPPER, LOWER), SEPARATORS)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def common_words(docs: DataFrame, text_col: str = "text", most: int = ANCHORS) -> list[int]:
    """Hashes of the words that stand in the most documents, over all documents; ties to the smaller hash.

    Counts are added up on the map side first; ``most`` rows reach the driver."""
    words = docs.select(F.explode(F.array_distinct(word_hashes(F.col(f"`{text_col}`")))).alias("word"))
    counts = written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    limit = min(most, max(1, counts.count() // 4))
    return [r["word"] for r in counts.orderBy(F.col("n").desc(), "word").limit(limit).collect()]


def _is_anchor(anchors: list[int]):
    """A test of a word's hash by one look into a table in which every anchor has its own slot."""
    bits = 2
    while True:
        for shift in range(0, 64 - bits, 3):
            slots = {a >> shift & (1 << bits) - 1: a for a in anchors}
            if len(slots) == len(anchors):
                rows = F.array(*[F.lit(slots.get(i)).cast("long") for i in range(1 << bits)])
                at = lambda h: F.shiftright(h, shift).bitwiseAND((1 << bits) - 1).cast("int")  # noqa: B023, E731
                return lambda h: F.coalesce(F.get(rows, at(h)) == h, F.lit(False))
        bits += 1


def signatures(df: DataFrame, anchors: list[int], text: Column, out: str, bits: int = 64) -> DataFrame:
    """Add ``out``: the sorted array of a text's different signatures, longs of ``bits`` bits.

    A text without a whole chain has its words as signatures, one without words itself, an empty or null text none.
    """
    anchor = _is_anchor(anchors)
    words, places, content = (f"__{out}_{x}" for x in ("words", "places", "content"))
    n = F.size(words)
    upto = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(words, word_hashes(text))
    df = df.withColumns({
        places: F.filter(upto, lambda i: anchor(F.get(words, i))), content: F.filter(words, lambda h: ~anchor(h)),
    })
    # Before the j-th anchor (from 0), at place p, stand p - j words of content.
    link = lambda p, j, k: F.get(content, p - j + k)
    chains = F.transform(places, lambda p, j: F.when(
        p - j + CHAIN <= F.size(content), F.xxhash64(F.get(words, p), *[link(p, j, k) for k in range(CHAIN)])
    ))
    df = df.withColumn(out, F.filter(chains, lambda s: s.isNotNull()))
    rest = F.when(n > 0, F.col(words)).when(F.length(text) > 0, F.array(F.xxhash64(text))).otherwise(F.array().cast("array<long>"))
    found = F.when(F.size(out) > 0, F.col(out)).otherwise(rest)
    if bits < 64:
        found = F.transform(found, lambda s: F.shiftright(s, 64 - bits).cast("int" if bits <= 32 else "long"))
    return df.withColumn(out, F.array_sort(F.array_distinct(found))).drop(words, places, content)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets given as arrays; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def fingerprint_text(signature_set: Column) -> Column:
    """Eight hexadecimal digits a signature, joined by blanks."""
    return F.array_join(F.transform(signature_set, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), " ")


def before_each(keys: DataFrame, parts: int) -> DataFrame:
    """``key, before, before_n``: for every row of ``doc_id, key, n`` the row before it in their order, the last for the first.

    The table is cut into ranges; within one a window looks back by a row, and the last rows of all ranges, one for each,
    go through the driver to the range after."""
    order = ["doc_id", "key"]
    ranged = written(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    row = F.struct("doc_id", "key", "n")
    tails = [(r["range"], r["x"]["key"], r["x"]["n"]) for r in ranged.groupBy("range").agg(F.max(row).alias("x")).orderBy("range").collect()]
    rows = [(at, *tails[i - 1][1:]) for i, (at, _, _) in enumerate(tails)]
    ahead = ranged.sparkSession.createDataFrame(rows, "range int, tail string, tail_n int")
    window = Window.partitionBy("range").orderBy(*order)
    back = ranged.withColumns({"before": F.lag("key").over(window), "before_n": F.lag("n").over(window)})
    return back.join(F.broadcast(ahead), "range").select(
        "key", F.coalesce("before", "tail").alias("before"), F.coalesce("before_n", "tail_n").alias("before_n")
    )


def edited_fingerprints(docs: DataFrame, anchors: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, next_id, edited, spots, edited_spots, next_spots`` of every document.

    The edited text has its last quarter replaced by as many first characters of the next document in the order
    (doc_id, digest of id and text; null ids first), after the last the first. Rows that share id and text
    count as one document there and each give the same row. Null texts are empty; an empty table gives none. Signatures
    have 32 bits. Other columns play no part.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit("t"), "text")))
    # Both joins below take the same three columns, so the texts are shuffled once.
    chain = before_each(rows.select("doc_id", "key", F.length("text").alias("n")).distinct(), parts)
    following = rows.join(chain, "key").select(
        F.col("before").alias("key"), F.expr("substring(text, 1, cast(floor(before_n / 4) as int))").alias("head"),
        "text", F.col("doc_id").alias("next_id"),
    )
    following = signatures(following, anchors, F.col("text"), "next_spots", 32).drop("text").dropDuplicates(["key"])
    both = rows.join(following, "key").drop("key")
    kept = F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))")
    both = both.withColumn("edited", F.concat(kept, "head")).drop("head")
    both = signatures(both, anchors, F.col("text"), "spots", 32)
    return signatures(both, anchors, F.col("edited"), "edited_spots", 32)


def near_fingerprints(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints with a likeness of ``threshold`` or more, and the members of each fingerprint.

    ``a, b, likeness`` with ``a < b``, and ``doc_id, class, n_signatures`` with a row for every row of ``docs``; equal
    fingerprints are one class, so copies are not paired. Empty fingerprints belong to a class of their own and
    to no pair. An empty table gives none; other columns play no part. No pair is left out: sets at the threshold share one
    of their first ``n - ceil(threshold * n) + 1`` signatures in any order common to all; rarest first keeps those
    lists short.
    """
    anchors = common_words(docs, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    spots = signatures(rows, anchors, F.col("text"), "spots").drop("text")
    spots = spots.withColumn("class", F.md5(F.array_join("spots", ",")))
    spots = written(spots.withColumn("n_signatures", F.size("spots")), "spots")
    sets = written(spots.where("n_signatures > 0").groupBy("class").agg(F.first("spots").alias("spots")), "spot-sets")
    single = sets.select("class", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    common = single.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    rare = single.join(common, "spot").groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("s"))
    # Rounding must not shorten a prefix: a little slack in the threshold keeps ceil() low.
    least = F.ceil(F.col("n") * (threshold - 1e-9))
    prefix = rare.select("class", "n", F.explode(F.slice("s", 1, (F.col("n") - least + 1).cast("int"))["spot"]).alias("spot"))
    # Lengths of one partition differ by less than the threshold allows: like sets lie in one or in neighbours.
    part = F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold) + 1e-9)
    left = prefix.select("spot", F.col("class").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(part - 1, part, part + 1)).alias("part"))
    right = prefix.select("spot", F.col("class").alias("b"), F.col("n").alias("n_b"), part.alias("part"))
    allowed = F.least("n_a", "n_b") >= (threshold - 1e-9) * F.greatest("n_a", "n_b")
    pairs = left.join(right, ["spot", "part"]).where((F.col("a") < F.col("b")) & allowed).select("a", "b").distinct()
    side = lambda c: sets.select(F.col("class").alias(c), F.col("spots").alias(f"spots_{c}"))
    compared = pairs.join(side("a"), "a").join(side("b"), "b")
    compared = compared.select("a", "b", likeness(F.col("spots_a"), F.col("spots_b")).alias("likeness"))
    return compared.where(F.col("likeness") >= threshold), spots.select("doc_id", "class", "n_signatures")


@query("op12_spots")
def op12_spots(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = edited_fingerprints(docs, common_words(docs))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("spots")).alias("fingerprint"),
        fingerprint_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        "next_id",
    )
