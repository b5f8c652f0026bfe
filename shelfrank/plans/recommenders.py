"""Recommenders: ``fit(log, users, items)`` builds model tables, ``predict`` is one lazy plan.

``predict`` returns ``user_idx, item_idx, relevance, price, rank`` with at most ``k`` rows per user.
Names follow the tables: ``users(user_idx, segment, ...)``, ``items(item_idx, price, ...)``, and
``log(user_idx, item_idx, response, relevance, ...)``.
"""

from __future__ import annotations

import math
from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.config import DEFAULTS, NotFittedError
from shelfrank.functions import chance
from shelfrank.operators import graph, neighbours, ngram
from shelfrank.operators.blocks import block_top_k
from shelfrank.operators.embedding import walk_vectors
from shelfrank.operators.ordinal import global_rank, matched, rank_by_score, ranked_head, top_ranked
from shelfrank.operators.sampling import item_slots
from shelfrank.operators.sequences import last_n
from shelfrank.operators.unseen import first_unseen, unseen_at
from shelfrank.operators.weighted import weighted_choice
from shelfrank.session import cut_lineage

RECS = ["user_idx", "item_idx", "relevance", "price", "rank"]
PASS_OFFERS = 200_000_000  # rows of neighbours' histories that are offered to users at one time


class Recommender(ABC):
    """Contract of all recommenders."""

    @abstractmethod
    def fit(
        self, log: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None
    ) -> "Recommender": ...

    @abstractmethod
    def predict(
        self, log: DataFrame | None, k: int, users: DataFrame, items: DataFrame, filter_seen: bool = True
    ) -> DataFrame: ...


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def _by_score(df: DataFrame, k: int) -> DataFrame:
    return top_ranked(df, "user_idx", [F.col("relevance").desc(), F.col("item_idx")], k)


def without_seen(recs: DataFrame, log: DataFrame) -> DataFrame:
    """Recommendations whose (user, item) pair is not in the log."""
    return recs.join(log.select("user_idx", "item_idx").distinct(), ["user_idx", "item_idx"], "left_anti")


def with_fallback(
    recs: DataFrame,
    fallback: Recommender,
    log: DataFrame | None,
    k: int,
    users: DataFrame,
    items: DataFrame,
    filter_seen: bool = True,
) -> DataFrame:
    """``recs``, plus the fallback's rows for the users ``recs`` says nothing about.

    The list is written out first. The fallback then runs on the missing users and their part
    of the log only, and not at all when nobody is missing.
    """
    found = cut_lineage(recs.select(RECS))
    missing = users.join(found.select("user_idx").distinct(), "user_idx", "left_anti")
    if missing.isEmpty():
        return found
    theirs = None if log is None else log.join(missing.select("user_idx"), "user_idx", "left_semi")
    return found.unionByName(fallback.predict(theirs, k, missing, items, filter_seen).select(RECS))


def _best_unseen(
    scored: DataFrame,
    score: str,
    users: DataFrame,
    seen: DataFrame | None,
    k: int,
    catalogue: int,
    tie_desc: bool = False,
) -> DataFrame:
    """First ``k`` unseen items per user by falling score, ties to the smaller (``tie_desc``: larger) item."""
    tie = F.col("item_idx").desc() if tie_desc else F.col("item_idx").asc()
    block = F.floor(F.col("item_idx") * (-1 if tie_desc else 1) / 65536)

    def head_of(n: int) -> DataFrame:
        return ranked_head(scored, [], score, [tie], block, n, at_most=catalogue)

    return first_unseen(users.select("user_idx"), head_of, seen, k, catalogue)


class Random(Recommender):
    """Uniform random unseen items, drawn without pairing users and items.

    A user with ``n`` unseen items draws ``k`` of the positions 1..n without replacement
    (one hash per position drawn), and only those positions are looked up.
    """

    def __init__(self, seed: int = DEFAULTS.seed):
        self.seed = seed

    def fit(self, log, users=None, items=None):
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        ranked = (
            item_slots(items)
            .join(items.select("item_idx", "price"), "item_idx")
            .select("item_idx", "price", (F.col("slot") + 1).alias("rank"))
        )
        total = _row_count(items)
        asked = users.select("user_idx")
        if filter_seen and log is not None:
            known = log.select("user_idx", "item_idx").distinct()
            known = known.join(items.select("item_idx"), "item_idx", "left_semi")
            counts = known.groupBy("user_idx").agg(F.count(F.lit(1)).alias("__seen"))
            asked = asked.join(counts, "user_idx", "left")
            free = total - F.coalesce(F.col("__seen"), F.lit(0))
        else:
            free = total
        asked = asked.withColumn("__free", free.cast("long"))
        steps = F.when(
            F.col("__free") > 0, F.sequence(F.greatest(F.lit(1), F.col("__free") - k + 1), F.col("__free"))
        ).otherwise(F.array().cast("array<long>"))

        def draw(taken: Column, step: Column) -> Column:
            place = F.floor(chance.uniform(self.seed, "user_idx", step) * step) + 1
            return F.concat(taken, F.array(F.when(F.array_contains(taken, place), step).otherwise(place)))

        positions = F.aggregate(steps, F.array().cast("array<long>"), draw)
        asked = asked.withColumn("__positions", positions)
        picks = unseen_at(
            asked,
            ranked,
            log if filter_seen else None,
            k,
            wanted=F.col("__positions"),
            catalogue=items.count(),
        ).withColumn("relevance", chance.uniform(self.seed, "user_idx", "item_idx"))
        return _by_score(picks, k).select(RECS)


class Popularity(Recommender):
    """Smoothed share of positive interactions; items never seen score 0.5."""

    def __init__(self, alpha: float = DEFAULTS.alpha):
        self.alpha = alpha
        self.model: DataFrame | None = None

    @staticmethod
    def scores(log: DataFrame, alpha: float) -> DataFrame:
        positive, total = F.sum("relevance"), F.count(F.lit(1))
        return log.groupBy("item_idx").agg(((positive + alpha) / (total + 2 * alpha)).alias("relevance"))

    def fit(self, log, users=None, items=None):
        self.model = self.scores(log, self.alpha)
        return self

    def catalogue(self, items: DataFrame) -> DataFrame:
        """Every item with its rounded score."""
        catalogue = items.select("item_idx", "price")
        if self.model is None:
            scored = catalogue.withColumn("relevance", F.lit(0.5))
        else:
            scored = catalogue.join(self.model, "item_idx", "left").withColumn(
                "relevance", F.coalesce(F.col("relevance"), F.lit(0.5))
            )
        return scored.withColumn("relevance", F.round("relevance", 9))

    def ranked(self, items: DataFrame) -> DataFrame:
        return global_rank(self.catalogue(items), "relevance", "item_idx", at_most=items.count())

    def predict(self, log, k, users, items, filter_seen=True):
        seen = log if filter_seen else None
        picks = _best_unseen(self.catalogue(items), "relevance", users, seen, k, items.count())
        return picks.withColumnRenamed("nth", "rank").select(RECS)


class UCB(Recommender):
    """Upper confidence bound; ``price_weight`` blends in the min-max scaled price.

    With ``sample`` every user draws items without replacement by their share of all bounds, as many as they
    have seen and ``k`` more, and gets the first ``k`` unseen ones with that share as relevance.
    """

    def __init__(
        self,
        exploration_coef: float = DEFAULTS.exploration_coef,
        price_weight: float = 0.0,
        seed: int = DEFAULTS.seed,
        sample: bool = False,
    ):
        self.coef, self.price_weight, self.seed, self.sample = exploration_coef, price_weight, seed, sample
        self.model: DataFrame | None = None
        self.fill: Column | None = None

    def fit(self, log, users=None, items=None):
        # One pass gives the sums per item, the rows and the labels that are neither 0 nor 1.
        odd = F.coalesce(~F.col("relevance").isin(0, 1), F.lit(True))
        sums = [F.sum("relevance").alias("pos"), F.count(F.lit(1)).alias("total"), F.count_if(odd).alias("odd")]
        stats = cut_lineage(log.groupBy("item_idx").agg(*sums))
        rows, wrong = stats.agg(F.coalesce(F.sum("total"), F.lit(0)), F.sum("odd")).first()
        if wrong:
            raise ValueError("relevance must be 0 or 1")
        bonus = F.log(F.lit(self.coef) * F.lit(rows))
        self.model = stats.select(
            "item_idx",
            (F.col("pos") / F.col("total") + F.sqrt(bonus / F.col("total"))).alias("relevance"),
        )
        self.fill = 1 + F.sqrt(bonus)
        return self

    def scores(self, items: DataFrame) -> DataFrame:
        """Score of every catalogue item; one never seen gets the highest bound."""
        if self.model is None:
            raise NotFittedError("fit before scoring")
        scored = items.select("item_idx", "price").join(self.model, "item_idx", "left")
        value = F.coalesce(F.col("relevance"), self.fill)
        if self.price_weight:
            lo = items.agg(F.min("price").alias("lo")).scalar()
            hi = items.agg(F.max("price").alias("hi")).scalar()
            value = (1 - self.price_weight) * value + self.price_weight * (F.col("price") - lo) / (hi - lo)
        return scored.withColumn("relevance", F.round(value, 9))

    def ranked(self, items: DataFrame) -> DataFrame:
        return global_rank(self.scores(items), "relevance", "item_idx", tie_desc=True, at_most=items.count())

    def drawn(self, log: DataFrame | None, k: int, users: DataFrame, items: DataFrame) -> DataFrame:
        """``user_idx, item_idx, turn``: the items that users draw, as many as each has in ``log`` and ``k`` more."""
        weights = self.scores(items).select("item_idx", F.col("relevance").alias("weight"))
        wanted = users.select("user_idx").distinct()
        if log is None:
            return weighted_choice(wanted.withColumn("cnt", F.lit(k).cast("long")), cut_lineage(weights), self.seed)
        counts = log.select("user_idx", "item_idx").distinct().groupBy("user_idx").agg(F.count(F.lit(1)).alias("n"))
        wanted = wanted.join(counts, "user_idx", "left").select("user_idx", (F.coalesce("n", F.lit(0)) + k).alias("cnt"))
        return weighted_choice(wanted, cut_lineage(weights), self.seed)

    def sampled(self, log, k, users, items, filter_seen=True) -> DataFrame:
        seen = log if filter_seen else None
        drawn = self.drawn(seen, k, users, items)
        if seen is not None:
            drawn = without_seen(drawn, seen)
        first = top_ranked(drawn, "user_idx", [F.col("turn")], k)
        shares = self.probabilities(items).select("item_idx", F.col("probability").alias("relevance"), "price")
        return first.join(shares, "item_idx").select(RECS)

    def predict(self, log, k, users, items, filter_seen=True):
        if self.sample:
            return self.sampled(log, k, users, items, filter_seen)
        seen = log if filter_seen else None
        picks = _best_unseen(self.scores(items), "relevance", users, seen, k, items.count(), tie_desc=True)
        return picks.withColumnRenamed("nth", "rank").select(RECS)

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        if self.model is None:
            raise NotFittedError("fit before scoring")
        return pairs.join(self.model, "item_idx", "left").withColumn(
            "relevance", F.coalesce(F.col("relevance"), self.fill)
        )

    def probabilities(self, items: DataFrame) -> DataFrame:
        scored = self.scores(items)
        return scored.withColumn(
            "probability", F.col("relevance") / scored.agg(F.sum("relevance").alias("s")).scalar()
        )


class Content(Recommender):
    """Cosine of a user's mean liked item vector with each item vector.

    ``vectors`` has ``item_idx, vec, price``. Users without a profile get random items.
    """

    def __init__(
        self,
        vectors: DataFrame,
        size: int,
        threshold: float = DEFAULTS.similarity_threshold,
        seed: int = DEFAULTS.seed,
    ):
        self.vectors, self.size, self.threshold, self.seed = vectors, size, threshold, seed
        self.profiles: DataFrame | None = None

    def fit(self, log, users=None, items=None):
        # Counted, scored and checked for cold users below, so written out once.
        self.profiles = cut_lineage(content_profiles(log, self.vectors, self.size))
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        chance_recs = Random(self.seed)
        if self.profiles is None:
            return chance_recs.predict(log, k, users, items, filter_seen)
        asked = self.profiles.select("user_idx", "vec").join(users.select("user_idx"), "user_idx", "left_semi")
        catalogue = self.vectors.join(items.select("item_idx"), "item_idx", "left_semi")
        close = block_top_k(
            asked, catalogue, log if filter_seen else None, k, "cosine", threshold=self.threshold
        ).join(items.select("item_idx", "price"), "item_idx")
        cold = users.join(self.profiles.select("user_idx"), "user_idx", "left_anti")
        # The random recommender scores in [0, 1), all above the default threshold.
        random_part = chance_recs.predict(log, k, cold, items, filter_seen).where(
            F.col("relevance") >= self.threshold
        )
        return close.select(RECS).unionByName(random_part.select(RECS))


def content_profiles(log: DataFrame, vectors: DataFrame, size: int) -> DataFrame:
    """Per user the relevance-weighted mean item vector, with count and total relevance."""
    links = log.select("user_idx", "item_idx", "relevance")
    found = [F.count(F.lit(1)).alias("interaction_count"), F.sum("relevance").cast("double").alias("total_relevance")]
    if graph.passes(links.count(), size) > 1:
        links = cut_lineage(links)
        totals = links.join(vectors.select("item_idx"), "item_idx").groupBy("user_idx").agg(*found)
        sums = graph.spread_sums(links, vectors.select("item_idx", "vec"), "user_idx", "item_idx", "relevance", size)
        totals = matched(totals, sums, ["user_idx"], "inner")
    else:
        joined = links.join(vectors.select("item_idx", "vec"), "item_idx")
        sums = [F.sum(F.get("vec", F.lit(i)) * F.col("relevance")).alias(f"__v{i}") for i in range(size)]
        totals = joined.groupBy("user_idx").agg(*found, *sums)
        totals = totals.withColumn("vec", F.array(*[F.col(f"__v{i}") for i in range(size)]))
    mean = F.transform("vec", lambda x: F.when(F.col("total_relevance") > 0, x / F.col("total_relevance")).otherwise(0.0))
    return totals.select("user_idx", "interaction_count", "total_relevance", mean.alias("vec"))


class Hybrid(Recommender):
    """Weighted sum of several recommenders' scores over their best ``2k`` items."""

    def __init__(self, parts: list[Recommender], weights: list[float] | None = None):
        self.parts = parts
        raw = weights or [1.0] * len(parts)
        self.weights = [w / sum(raw) for w in raw]

    def fit(self, log, users=None, items=None):
        for part in self.parts:
            part.fit(log, users, items)
        return self

    def blended(self, log, k, users, items, filter_seen=True) -> DataFrame:
        tagged = None
        for number, (part, weight) in enumerate(zip(self.parts, self.weights)):
            recs = part.predict(log, 2 * k, users, items, filter_seen).select(
                "user_idx",
                "item_idx",
                (F.col("relevance") * weight).alias("share"),
                F.lit(number).alias("model"),
            )
            tagged = recs if tagged is None else tagged.unionByName(recs)
        return tagged.groupBy("user_idx", "item_idx").agg(
            F.round(F.sum("share"), 9).alias("relevance"),
            F.sort_array(F.collect_list("model")).alias("models"),
        )

    def predict(self, log, k, users, items, filter_seen=True):
        best = _by_score(self.blended(log, k, users, items, filter_seen), k)
        return best.join(items.select("item_idx", "price"), "item_idx").select(RECS)


class SequenceKnn(Recommender):
    """Items from the histories of the most similar users, ranked by expected revenue."""

    def __init__(
        self,
        variant: str = "session",
        neighbour_count: int = DEFAULTS.neighbours,
        max_len: int = DEFAULTS.max_seq_len,
        decay: float = DEFAULTS.temporal_decay,
        hot_limit: int = neighbours.HOT_LIMIT,
    ):
        self.variant = variant if variant in ("session", "pattern", "temporal") else "session"
        self.neighbour_count, self.max_len, self.decay = neighbour_count, max_len, decay
        self.hot_limit = hot_limit
        self.recent: DataFrame | None = None
        self.popularity = Popularity()

    def fit(self, log, users=None, items=None):
        # Read several times below, so the truncated histories are written out once.
        kept = last_n(log, self.max_len).select("user_idx", "item_idx", "response", "iter_no", "pos")
        self.recent = cut_lineage(kept)
        self.popularity.fit(log)
        return self

    def neighbours(self) -> DataFrame:
        if self.recent is None:
            raise NotFittedError("fit before asking for neighbours")
        if self.variant == "pattern":
            return neighbours.pattern_neighbours(self.recent, self.neighbour_count, self.hot_limit)
        if self.variant == "temporal":
            return neighbours.temporal_neighbours(
                self.recent, self.neighbour_count, self.decay, self.hot_limit
            )
        session = top_ranked(self.recent, "user_idx", [F.col("pos").desc()], DEFAULTS.session_len, "back")
        return neighbours.session_neighbours(session, self.neighbour_count, self.hot_limit)

    def candidates(self, near: DataFrame | None = None) -> DataFrame:
        """Score of every (user, item) the neighbours' histories offer; ``near`` names the neighbours to ask."""
        histories = self.recent.groupBy("user_idx").agg(
            F.collect_list(F.struct("pos", "item_idx", "response")).alias("events")
        )
        near = (self.neighbours() if near is None else near).select("user_idx", "neighbour", "similarity")
        offered = near.join(histories.withColumnRenamed("user_idx", "neighbour"), "neighbour").select(
            "user_idx", "similarity", F.size("events").alias("len"), F.explode("events").alias("e")
        )
        weight = F.col("similarity") * (F.col("e.pos") / F.col("len")) * (1 + F.col("e.response"))
        return offered.groupBy("user_idx", F.col("e.item_idx").alias("item_idx")).agg(
            F.sum(weight).alias("score")
        )

    def predict(self, log, k, users, items, filter_seen=True):
        def best_of(near: DataFrame) -> DataFrame:
            offered = self.candidates(near).join(users.select("user_idx"), "user_idx", "left_semi")
            if filter_seen and log is not None:
                offered = without_seen(offered, log)
            priced = offered.join(items.select("item_idx", "price"), "item_idx").withColumn(
                "relevance", F.round(F.col("score") * F.col("price"), 6)
            )
            return _by_score(priced, k).select(RECS)

        near = self.neighbours()
        # As many rows as this are offered and shuffled; many of them in passes over the users, whose shuffles go in between.
        passes = math.ceil(self.recent.count() * self.neighbour_count / PASS_OFFERS)
        if passes > 1:
            near, best = cut_lineage(near), None
            for number in range(passes):
                some = cut_lineage(best_of(near.where(F.pmod(F.hash("user_idx"), F.lit(passes)) == number)))
                best = some if best is None else best.unionByName(some)
        else:
            best = best_of(near)
        return with_fallback(best, self.popularity, log, k, users, items, filter_seen)


class Ngram(Recommender):
    """Next-item probability times price.

    Every vocabulary item has a probability, yet only two short lists per user matter: the
    items seen after the user's context, and for the rest, which all share one
    probability, the dearest unseen ones.
    """

    def __init__(
        self, order: int = 2, alpha: float = 1.0, max_len: int = DEFAULTS.max_seq_len
    ):
        self.order, self.alpha, self.max_len = ngram.clamp_order(order), alpha, max_len
        self.model: ngram.NgramModel | None = None
        self.popularity = Popularity()

    def fit(self, log, users=None, items=None):
        self.model = ngram.fit(log, self.order, self.alpha, self.max_len)
        self.popularity.fit(log)
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        if self.model is None:
            raise NotFittedError("fit before predict")
        contexts = ngram.user_contexts(self.model, users)
        vocabulary = items.select("item_idx", "price").join(self.model.vocabulary, "item_idx", "left_semi")
        seen = log if filter_seen else None

        followers = (
            ngram.observed_probabilities(self.model)
            .join(contexts.select("ctx").distinct(), "ctx", "left_semi")
            .select("ctx", F.col("next_item").alias("item_idx"), "probability")
            .join(vocabulary, "item_idx")
            .withColumn("relevance", F.round(F.col("probability") * F.col("price"), 9))
        )
        size = items.count()
        ranked = rank_by_score(followers.drop("probability"), ["ctx"], "relevance", at_most=size)
        from_context = unseen_at(contexts, ranked, seen, k, by=["ctx"], catalogue=size).select(
            "user_idx", "item_idx", "relevance", "price"
        )

        base = ngram.unobserved_probability(self.model, contexts).select("user_idx", "unseen_probability")
        from_rest = (
            _best_unseen(vocabulary, "price", contexts, seen, k, size)
            .join(base, "user_idx")
            .select(
                "user_idx",
                "item_idx",
                F.round(F.col("unseen_probability") * F.col("price"), 9).alias("relevance"),
                "price",
            )
        )
        offers = from_context.unionByName(from_rest)
        merged = offers.groupBy("user_idx", "item_idx").agg(
            F.max("relevance").alias("relevance"), F.max("price").alias("price")
        )
        best = _by_score(merged, k).select(RECS)
        return with_fallback(best, self.popularity, log, k, users, items, filter_seen)


class WalkEmbedding(Recommender):
    """Embedding of random walks (factorised windows, see ``operators/embedding.py``); ranks by ``sigmoid(cosine) * price``.

    Items without a vector count as the zero vector. Users outside the graph get no rows.
    """

    def __init__(
        self,
        walk_length: int = DEFAULTS.walk_length,
        walks_per_node: int = DEFAULTS.walks_per_node,
        dim: int = DEFAULTS.embedding_dim,
        window: int = DEFAULTS.window_size,
        epochs: int = DEFAULTS.epochs,
        seed: int = DEFAULTS.seed,
    ):
        self.walk_length, self.walks_per_node = walk_length, walks_per_node
        self.dim, self.window, self.epochs, self.seed = dim, window, epochs, seed
        self.user_vectors: DataFrame | None = None
        self.item_vectors: DataFrame | None = None

    def fit(self, log, users=None, items=None):
        table = cut_lineage(graph.edges(log))
        offset = graph.item_offset(log)
        walks = graph.random_walks(table, self.walk_length, self.walks_per_node, self.seed)
        nodes = walk_vectors(walks, self.dim, self.window, self.epochs, self.seed)
        self.user_vectors = nodes.where(F.col("node") < offset).select(F.col("node").alias("user_idx"), "vec")
        self.item_vectors = nodes.where(F.col("node") >= offset).select(
            (F.col("node") - offset).alias("item_idx"), "vec"
        )
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        if self.user_vectors is None:
            raise NotFittedError("fit before predict")
        asked = self.user_vectors.join(users.select("user_idx"), "user_idx", "left_semi")
        zero = F.array_repeat(F.lit(0.0), self.dim)
        catalogue = (
            items.select("item_idx", "price")
            .join(self.item_vectors, "item_idx", "left")
            .withColumn("vec", F.coalesce("vec", zero))
        )
        best = block_top_k(asked, catalogue, log if filter_seen else None, k, "sigmoid_cosine_price")
        return best.join(items.select("item_idx", "price"), "item_idx").select(RECS)


class GraphPropagation(Recommender):
    """Item vectors spread over the purchase graph; ranks by ``sigmoid(dot) * price``."""

    def __init__(self, vectors: DataFrame, size: int, rounds: int = 2):
        self.vectors, self.size, self.rounds = vectors, size, rounds
        self.nodes: DataFrame | None = None
        self.offset: Column | None = None
        self.popularity = Popularity()

    def fit(self, log, users=None, items=None):
        bought = log.where(F.col("response") > 0)
        self.offset = graph.known_item_offset(bought)
        start = self.vectors.select((F.col("item_idx") + self.offset).alias("node"), "vec")
        self.nodes = graph.propagate(cut_lineage(graph.edges(bought)), start, self.size, self.rounds)
        self.popularity.fit(log)
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        if self.nodes is None:
            raise NotFittedError("fit before predict")
        known = self.nodes.where(F.col("node") < self.offset).select(F.col("node").alias("user_idx"), "vec")
        asked = known.join(users.select("user_idx"), "user_idx", "left_semi")
        catalogue = (
            self.nodes.where(F.col("node") >= self.offset)
            .select((F.col("node") - self.offset).alias("item_idx"), "vec")
            .join(items.select("item_idx", "price"), "item_idx")
        )
        seen = log if filter_seen else None
        best = block_top_k(asked, catalogue, seen, k, "sigmoid_dot_price")
        best = best.join(items.select("item_idx", "price"), "item_idx").select(RECS)
        return with_fallback(best, self.popularity, log, k, users, items, filter_seen)


class Als(Recommender):
    """Implicit-feedback matrix factorisation; ranks by the factors' dot product."""

    def __init__(self, rank: int = 8, iterations: int = 3, seed: int = DEFAULTS.seed):
        self.rank, self.iterations, self.seed = rank, iterations, seed
        self.model = None
        self.nodes: DataFrame | None = None
        self.popularity = Popularity()

    def numbers(self, kind: str, name: str, number: str) -> DataFrame:
        """Ids of one side next to the dense numbers that the factorisation takes."""
        side = self.nodes.where(F.col("kind") == kind)
        return side.select(F.col("id").alias(name), F.col("node").cast("int").alias(number))

    def fit(self, log, users=None, items=None):
        from pyspark.ml.recommendation import ALS

        self.nodes = cut_lineage(graph.graph_nodes(log))
        sums = log.groupBy("user_idx", "item_idx").agg(F.sum("response").cast("float").alias("rating"))
        ratings = (
            sums.join(self.numbers("user", "user_idx", "user_no"), "user_idx")
            .join(self.numbers("item", "item_idx", "item_no"), "item_idx")
            .select("user_no", "item_no", "rating")
        )
        self.model = ALS(
            rank=self.rank,
            maxIter=self.iterations,
            implicitPrefs=True,
            userCol="user_no",
            itemCol="item_no",
            ratingCol="rating",
            seed=self.seed,
        ).fit(ratings.where(F.col("rating") > 0))
        self.popularity.fit(log)
        return self

    def predict(self, log, k, users, items, filter_seen=True):
        if self.model is None:
            raise NotFittedError("fit before predict")
        vec = F.col("features").cast("array<double>").alias("vec")
        asked = (
            self.model.userFactors.select(F.col("id").alias("user_no"), vec)
            .join(self.numbers("user", "user_idx", "user_no"), "user_no")
            .join(users.select("user_idx"), "user_idx", "left_semi")
            .select("user_idx", "vec")
        )
        catalogue = (
            self.model.itemFactors.select(F.col("id").alias("item_no"), vec)
            .join(self.numbers("item", "item_idx", "item_no"), "item_no")
            .join(items.select("item_idx", "price"), "item_idx")
            .select("item_idx", "vec", "price")
        )
        best = block_top_k(asked, catalogue, log if filter_seen else None, k, "dot")
        best = best.join(items.select("item_idx", "price"), "item_idx").select(RECS)
        return with_fallback(best, self.popularity, log, k, users, items, filter_seen)
