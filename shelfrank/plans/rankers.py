"""MLlib classifiers as rankers.

All feature columns found by prefix enter the models with their own values. Linear models
are additive: the probability rises with ``a + b``, one number per user and one per item, and the
relevance is a rising positive function of it times a factor of the item. An item that enough
others beat in both numbers can be on nobody's list, so only a short list of items is scored per user. A
tree is taken apart into what its leaves ask of the user and of the item: the catalogue is ranked once for each thing it can
ask of a user.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.config import DEFAULTS, NotFittedError
from shelfrank.functions.scalars import feature_columns, price_response_relevance
from shelfrank.operators.blocks import block_top_k
from shelfrank.operators.ordinal import cut_along, rank_by_score, top_ranked
from shelfrank.operators.unseen import unseen_at
from shelfrank.plans.recommenders import RECS, Recommender
from shelfrank.session import cut_lineage, joined, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = 128  # a range of the grid holds at most this part of the items, or one value
TIER, TIER_STEP = 256, 16
USER_PREFIX, ITEM_PREFIX = "user_attr_", "item_attr_"


def training_table(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Log rows with all features of both sides, projected before the joins."""
    own, theirs = feature_columns(users, USER_PREFIX), feature_columns(items, ITEM_PREFIX)
    rows = joined(log.select("user_idx", "item_idx", "response"), items.select("item_idx", "category", *theirs, "price"), "item_idx")
    return joined(rows, users.select("user_idx", "segment", *own), "user_idx")


def feature_stages(own: list[str], theirs: list[str]) -> list:
    """One-hot segment and category, raw attributes of user and item, standardised price."""
    return [
        StringIndexer(
            inputCols=["segment", "category"],
            outputCols=["segment_no", "category_no"],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=["segment_no", "category_no"], outputCols=["segment_hot", "category_hot"], dropLast=False
        ),
        VectorAssembler(inputCols=["price"], outputCol="price_vec"),
        StandardScaler(inputCol="price_vec", outputCol="price_std", withMean=True),
        VectorAssembler(
            inputCols=["segment_hot", "category_hot", *own, *theirs, "price_std"], outputCol="features"
        ),
    ]


def _staircase(grid: np.ndarray, need: int) -> list[int]:
    """Per row of a table of counts, the first column with fewer than ``need`` counted in earlier rows and later columns."""
    ahead = np.zeros_like(grid)
    ahead[1:, :-1] = grid.cumsum(0)[:-1, ::-1].cumsum(1)[:, ::-1][:, 1:]
    # Along a row the counts fall.
    return (ahead >= need).sum(1).tolist()


def short_list(items: DataFrame, need: int, work: list | None = None) -> DataFrame:
    """Items of ``item_idx, b, g`` (``g`` of one sign) but those that ``need`` others beat in both numbers.

    Beaten means: by a larger ``g`` and a larger ``b``. The items are counted on a grid of quantiles of both; from
    these counts, at most about a thousand a side whatever the number of items, the driver reads for each range of ``g`` which
    ranges of ``b`` that many items precede for certain. The rest is counted again on a finer grid, while that
    leaves out a quarter: those who beat an item often enough are among the rest too. ``work`` takes the sizes.
    """
    left = cut_lineage(items)
    n = left.count()
    if work is not None:
        work.append(n)
    while n > max(GRID, 4 * need):
        # Ranges of g fall, ranges of b rise.
        placed = left.withColumn("__all", F.lit(0))
        for column, name, falling in (("g", "row", True), ("b", "col", False)):
            placed = cut_along(placed, placed.select("__all").limit(1), ["__all"], column, math.ceil(n / GRID), falling)
            placed = placed.withColumnRenamed("__piece", name).drop("__long")
        placed = cut_lineage(placed)
        cells = placed.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n")).collect()
        rows, cols = (sorted({c[name] for c in cells}) for name in ("row", "col"))
        row_at, col_at = ({piece: at for at, piece in enumerate(found)} for found in (rows, cols))
        grid = np.zeros((len(rows), len(cols)), np.int64)
        for cell in cells:
            grid[row_at[cell["row"]], col_at[cell["col"]]] = cell["n"]
        # A row whose ranges of b all go needs no entry.
        kept = [(row, cols[at]) for row, at in zip(rows, _staircase(grid, need), strict=True) if at < len(cols)]
        shape = placed.select("row", F.col("col").alias("from")).schema
        steps = placed.sparkSession.createDataFrame(kept, shape)
        rest = placed.join(F.broadcast(steps), "row").where(F.col("col") >= F.col("from"))
        left = cut_lineage(rest.select(*items.columns))
        before, n = n, left.count()
        if work is not None:
            work.append(n)
        if n > 0.75 * before:
            break
    return left


def additive_top_k(
    users: DataFrame,
    items: DataFrame,
    seen: DataFrame | None,
    k: int,
    kind: str = "sigmoid_dot_price",
    tier: int = TIER,
    work: list | None = None,
) -> DataFrame:
    """Best unseen items by a rising function of ``a + b`` times ``g``: ``user_idx, item_idx, relevance, rank``.

    ``users`` has ``user_idx, a``; ``items`` has ``item_idx, b, g``; items without a number are on no list. Who has seen
    ``h`` items needs none that ``k + h`` others precede for everyone: with a factor ``g`` of 0 or more those with larger ``g``
    and ``b``, else those with larger ``g`` and smaller ``b`` and all of the first kind. Users are dealt into tiers by ``k + h``,
    each sixteen times as long as the one before, so one long history lengthens nobody else's list.
    """
    asked = users.select("user_idx", F.array(F.col("a").cast("double"), F.lit(1.0)).alias("vec"))
    level = F.lit(0)
    if seen is not None:
        pairs = seen.select("user_idx", "item_idx").distinct()
        held = pairs.groupBy("user_idx").agg(F.count(F.lit(1)).alias("__held"))
        above = F.log((F.coalesce("__held", F.lit(0)) + k) / F.lit(float(tier))) / math.log(TIER_STEP)
        level = F.greatest(F.ceil(F.round(above, 9)), F.lit(0))
        asked = asked.join(held, "user_idx", "left")
    asked = asked.withColumn("__tier", level.cast("int")).select("user_idx", "vec", "__tier")
    if seen is not None:
        asked = cut_lineage(asked)
    # One row for each length, sixteen times the one before.
    tiers = sorted((r[0] for r in asked.select("__tier").distinct().collect()), reverse=True)
    left = items.select(F.col("item_idx").cast("long"), F.col("b").cast("double"), F.col("g").cast("double"))
    left = left.where((F.col("b") < math.inf) & (F.col("b") > -math.inf) & (F.col("g") < math.inf) & (F.col("g") > -math.inf))
    if not tiers:
        tiers = [0]
    lists = []
    for number in tiers:
        need = max(tier * TIER_STEP**number, k)
        first = short_list(left.where("g >= 0"), need, work)
        room = need - first.count()
        if room > 0:
            # All of the first kind are in the list, or more than room.
            turned = left.where("g < 0").withColumn("b", -F.col("b"))
            last = short_list(turned, room, work).withColumn("b", -F.col("b"))
            first = cut_lineage(first.unionByName(last))
        # What a longer list leaves out no shorter one needs.
        left = first
        right = left.select("item_idx", F.array(F.lit(1.0), "b").alias("vec"), F.col("g").alias("price"))
        theirs = asked.where(F.col("__tier") == number)
        known = pairs.join(theirs.select("user_idx"), "user_idx", "left_semi") if seen is not None else None
        lists.append(block_top_k(theirs.select("user_idx", "vec"), right, known, k, kind))
    return reduce(DataFrame.unionByName, lists)


class ScoreRanker(Recommender):
    """Base: fit a pipeline of features and a classifier on the log."""

    def __init__(self, seed: int = DEFAULTS.seed):
        self.seed = seed
        self.model: PipelineModel | None = None
        self.own: list[str] = []
        self.theirs: list[str] = []

    def estimators(self, rows: int) -> list:
        raise NotImplementedError

    def fit(self, log, users=None, items=None):
        self.own, self.theirs = feature_columns(users, USER_PREFIX), feature_columns(items, ITEM_PREFIX)
        table = training_table(log, users, items).withColumn("label", F.col("response").cast("double"))
        table = table.persist()
        try:
            stages = feature_stages(self.own, self.theirs) + self.estimators(table.count())
            self.model = Pipeline(stages=stages).fit(table)
        finally:
            table.unpersist()
        return self

    def fitted(self) -> PipelineModel:
        if self.model is None:
            raise NotFittedError("fit before predict")
        return self.model


class AdditiveRanker(ScoreRanker):
    """A linear model: one number per user and one per item."""

    kind = "sigmoid_dot_price"

    def linear(self) -> tuple[np.ndarray, float]:
        """Weights and intercept of the logit."""
        raise NotImplementedError

    def factor(self) -> Column:
        return F.col("price")

    def sides(self, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``user_idx, a`` and ``item_idx, b, g, price``."""
        weights, intercept = self.linear()
        segments, categories = self.fitted().stages[0].labelsArray
        scaler = self.fitted().stages[3]
        at = 0

        def part(n: int) -> list[float]:
            nonlocal at
            at += n
            return [float(w) for w in weights[at - n : at]]

        def chosen(column: str, labels: list[str], values: list[float]) -> Column:
            """The label's weight; the last one stands for missing and unknown labels."""
            known = F.lit(values[-1])
            for label, value in zip(labels, values, strict=False):
                known = F.when(F.col(column) == label, value).otherwise(known)
            return known

        a = chosen("segment", segments, part(len(segments) + 1))
        b = chosen("category", categories, part(len(categories) + 1))
        for name, weight in zip(self.own, part(len(self.own)), strict=True):
            a = a + F.col(name) * weight
        for name, weight in zip(self.theirs, part(len(self.theirs)), strict=True):
            b = b + F.col(name) * weight
        (price,) = part(1)
        mean, spread = float(scaler.mean[0]), float(scaler.std[0]) or 1.0
        b = b + (F.col("price") - mean) * (price / spread) + intercept
        return users.select("user_idx", a.alias("a")), items.select(
            "item_idx", b.alias("b"), self.factor().alias("g"), "price"
        )

    def predict(self, log, k, users, items, filter_seen=True):
        left, right = self.sides(users, items)
        best = additive_top_k(left, right, log if filter_seen else None, k, self.kind)
        probability = F.round(1 / (1 + F.exp(-(F.col("a") + F.col("b")))), 9).alias("probability")
        return joined(joined(best, left, "user_idx"), right, "item_idx").select(*RECS, probability)


class LogisticRanker(AdditiveRanker):
    """L2 logistic regression. A penalty of C on the summed loss is 1 / (C n) on the mean."""

    def __init__(self, c: float = 1.0, max_iter: int = 100, seed: int = DEFAULTS.seed):
        super().__init__(seed)
        self.c, self.max_iter = c, max_iter

    def estimators(self, rows: int) -> list:
        return [
            LogisticRegression(regParam=1.0 / (self.c * max(rows, 1)), standardization=False, maxIter=self.max_iter)
        ]

    def linear(self):
        model = self.fitted().stages[-1]
        return model.coefficients.toArray(), float(model.intercept)


class SvmRanker(AdditiveRanker):
    """Linear SVM whose margin a logistic regression turns into a probability."""

    kind = "response_dot_price"

    def __init__(self, max_iter: int = 20, seed: int = DEFAULTS.seed):
        super().__init__(seed)
        self.max_iter = max_iter

    def estimators(self, rows: int) -> list:
        return [
            LinearSVC(maxIter=self.max_iter, regParam=1.0 / math.sqrt(max(rows, 1))),
            VectorAssembler(inputCols=["rawPrediction"], outputCol="margin"),
            LogisticRegression(
                featuresCol="margin",
                predictionCol="calibrated",
                rawPredictionCol="calibrated_raw",
                probabilityCol="probability",
                maxIter=20,
                regParam=1e-6,
            ),
        ]

    def linear(self):
        svm, _, calibration = self.fitted().stages[-3:]
        low, high = calibration.coefficients.toArray()
        slope = high - low
        return svm.coefficients.toArray() * slope, float(svm.intercept * slope + calibration.intercept)

    def factor(self):
        return F.log1p("price") * F.cos(F.col("price") / 100)


@dataclass(frozen=True)
class Range:
    """What a path through the tree asks of one feature: not at most ``low``, at most ``high``, one of ``among``."""

    feature: int
    low: float | None = None
    high: float | None = None
    among: tuple[float, ...] | None = None

    def holds(self, value: Column) -> Column:
        """Missing values are not at most anything, as NaN is for the tree."""
        met = F.lit(True)
        if self.low is not None:
            met = met & ~F.coalesce(value <= self.low, F.lit(False))
        if self.high is not None:
            met = met & F.coalesce(value <= self.high, F.lit(False))
        if self.among is not None:
            met = met & F.coalesce(value.isin(*self.among), F.lit(False)) if self.among else F.lit(False)
        return met

    def cut(self, split, left: bool) -> "Range":
        """Narrowed by one split of the tree."""
        values = split["leftCategoriesOrThreshold"]
        if split["numCategories"] < 0:
            (at,) = values
            if left:
                return replace(self, high=at if self.high is None else min(at, self.high))
            return replace(self, low=at if self.low is None else max(at, self.low))
        before = range(split["numCategories"]) if self.among is None else self.among
        return replace(self, among=tuple(float(v) for v in before if (v in values) == left))


@dataclass(frozen=True)
class Leaf:
    ranges: tuple[Range, ...]
    probability: float


class TreeRanker(ScoreRanker):
    """Decision tree. MLlib has no cost-complexity pruning.

    A leaf asks something of the user and something of the item. Leaves that ask the same of the user are one path:
    its items are ranked once, each under the one leaf it can reach there. A user follows few paths, and every item
    is on exactly one of them for that user, so the best of all are among the first unseen items of each. No table of classes of
    users times items is made: an item is ranked at most once for each leaf.
    """

    def __init__(self, max_depth: int = 5, min_leaf: int = 1, seed: int = DEFAULTS.seed):
        super().__init__(seed)
        self.max_depth, self.min_leaf = max_depth, min_leaf

    def estimators(self, rows: int) -> list:
        return [DecisionTreeClassifier(maxDepth=self.max_depth, minInstancesPerNode=self.min_leaf, seed=self.seed)]

    def leaves(self) -> list[Leaf]:
        """Leaves with what their paths ask, from the table of nodes that a saved tree has (at most 2 ** (max_depth + 1))."""
        spark = SparkSession.active()
        folder = new_folder(spark, "tree")
        self.fitted().stages[-1].write().save(folder)
        nodes = {n["id"]: n for n in spark.read.parquet(f"{folder}/data").collect()}
        found, open_ = [], [(0, {})]
        while open_:
            at, asked = open_.pop()
            node = nodes[at]
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                share = stats[1] / sum(stats) if sum(stats) and len(stats) > 1 else 0.0
                found.append(Leaf(tuple(asked[f] for f in sorted(asked)), share))
                continue
            split = node["split"]
            feature = split["featureIndex"]
            before = asked.get(feature, Range(feature))
            for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
                open_.append((child, {**asked, feature: before.cut(split, left)}))
        return found

    def features(self) -> tuple[list[Column], set[int]]:
        """Each feature as an expression of its table's columns, and which are the user's."""
        labels, scaler = self.fitted().stages[0].labelsArray, self.fitted().stages[3]
        found: list[Column] = []
        mine: set[int] = set()
        for name, known in zip(("segment", "category"), labels, strict=True):
            other = ~F.coalesce(F.col(name).isin(*known), F.lit(False))
            tests = [*(F.coalesce(F.col(name) == label, F.lit(False)) for label in known), other]
            if name == "segment":
                mine.update(range(len(tests)))
            found += [test.cast("double") for test in tests]
        mine.update(range(len(found), len(found) + len(self.own)))
        spread = float(scaler.std[0])
        price = (F.col("price") - float(scaler.mean[0])) * (1.0 / spread if spread else 0.0)
        return [*found, *(F.col(c).cast("double") for c in (*self.own, *self.theirs)), price], mine

    def paths(self, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``user_idx, paths`` and ``item_idx, price, leaves`` with structs of ``path`` and ``probability``."""
        values, mine = self.features()
        by_path: dict[tuple[Range, ...], list[Leaf]] = {}
        for leaf in self.leaves():
            by_path.setdefault(tuple(r for r in leaf.ranges if r.feature in mine), []).append(leaf)

        def all_hold(ranges) -> Column:
            return reduce(Column.__and__, [r.holds(values[r.feature]) for r in ranges], F.lit(True))

        followed = [F.when(all_hold(path), F.lit(at)) for at, path in enumerate(by_path)]
        offered = []
        for at, leaves in enumerate(by_path.values()):
            share = F.lit(None).cast("double")
            for leaf in leaves:
                theirs = [r for r in leaf.ranges if r.feature not in mine]
                share = F.when(all_hold(theirs), F.lit(round(leaf.probability, 9))).otherwise(share)
            offered.append(F.struct(F.lit(at).alias("path"), share.alias("probability")))
        return users.select("user_idx", F.array_compact(F.array(*followed)).alias("paths")), items.select(
            "item_idx", "price", F.filter(F.array(*offered), lambda x: x["probability"].isNotNull()).alias("leaves")
        )

    def predict(self, log, k, users, items, filter_seen=True):
        follow, offer = self.paths(users, items)
        n_items = items.count()
        scored = offer.select("item_idx", "price", F.inline("leaves"))
        scored = scored.withColumn("relevance", F.round(F.col("probability") * F.col("price"), 6))
        # Read twice below: to place what was seen and to look the picks up.
        ranked = cut_lineage(rank_by_score(scored, ["path"], "relevance", at_most=n_items))
        seen = None
        if filter_seen:
            both = joined(joined(log.select("user_idx", "item_idx").distinct(), follow, "user_idx"), offer, "item_idx")
            path = F.get(F.array_intersect("paths", F.col("leaves.path")), F.lit(0))
            seen = both.select("user_idx", "item_idx", path.alias("path"))
        asked = follow.select("user_idx", F.explode("paths").alias("path"))
        heads = unseen_at(asked, ranked, seen, k, by=["path"], who=["user_idx", "path"], catalogue=n_items)
        best = top_ranked(heads.drop("path", "nth"), "user_idx", [F.col("relevance").desc(), F.col("item_idx")], k)
        return best.select(RECS + ["probability"])


def exact_relevance(ranker: ScoreRanker, probability: Column, price: Column) -> Column:
    """The relevance a ranker orders by, from the model's own probability."""
    return price_response_relevance(probability, price) if isinstance(ranker, SvmRanker) else probability * price
