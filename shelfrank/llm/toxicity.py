"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax.

A word is the bag of its character n-grams and itself, hashed into buckets with one embedding each. The
embeddings in a window of words are averaged and go into a softmax over two classes; a text scores
as its highest window, so that a long text does not thin out a few words. Embeddings and softmax
are trained jointly in numpy on a bounded sample of labelled texts, first on whole-text
averages, then on each text's highest window. Spellings that were never seen share
n-gram vectors with those that were.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import SMALL_SLICE, SPACE_WORDS, Words, mixed, run_hash, table, text_slices, worker_store
from shelfrank.llm.registry import query

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bounds of the training sample: texts per class and bytes of one text.
TRAIN_TEXTS = 1500
TRAIN_TEXT_BYTES = 16_384
BUCKETS = 1 << 20
DIMENSIONS = 8
SIZES = (4, 5, 6, 7)
WINDOW = 6
# A window with fewer features is averaged as if it had these; its mean counts this much.
LEAST_FEATURES = 200
SCALE = 32.0
WARM_EPOCHS, EPOCHS = 5, 80
LEAST_SEEN = 4
RATE = 4.0
THRESHOLD = 0.7
# Entries of the sample's bags, and new words, that training handles at once: the driver holds the bags and little beside them.
STEP, NEW_WORDS = 1 << 17, 1 << 13
# Word scores that one worker remembers.
REMEMBERED = 2_000_000


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' n-grams, one word after another, and how many each has."""
    text = "".join(f"<{w}>" for w in words).lower()
    marked = [len(w.lower()) + 2 for w in words]
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.repeat(np.cumsum(marked), marked)
    at = np.arange(len(codes))
    word = np.repeat(np.arange(len(words)), marked)
    keys, owners = [], []
    for size in SIZES:
        starts = np.flatnonzero(at + size <= ends)
        gram = run_hash([codes[starts + k] + np.uint64(size) for k in range(size)])
        keys.append(gram)
        owners.append(word[starts])
    # The word itself: a sum over its letters and places.
    place = at - np.repeat(np.cumsum(marked) - marked, marked)
    letters = mixed(codes * np.uint64(0x1F123BB5) + place.astype(np.uint64))
    first = np.cumsum(marked) - marked
    keys.append(mixed(np.add.reduceat(letters, first)) if len(words) else np.zeros(0, np.uint64))
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(keys) & np.uint64(BUCKETS - 1)).astype(np.int64)[order]
    return bucket, np.bincount(owner, minlength=len(words))


def summed(index: np.ndarray, values, n: int) -> np.ndarray:
    """Sums by index, in the order of the entries; ``values(a, b)`` gives those of the entries from a to b."""
    out = np.zeros(n)
    for k in range(0, len(index), STEP):
        np.add.at(out, index[k : k + STEP].astype(np.intp), values(k, k + STEP))
    return out


@dataclass
class ToxicityModel:
    """What scoring needs: per bucket the embedding times the class weights' difference, and the bias."""

    worth: np.ndarray
    bias: float
    embeddings: np.ndarray
    weights: np.ndarray


class Bags:
    """Texts as windows of word numbers, and words as bags of buckets; built slice by slice."""

    def __init__(self, texts: list[str]):
        known: dict[int, int] = {}
        words, rows, buckets, sizes, seen_in = [], [], [], [], []
        batch = pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.large_string()), pa.array(np.arange(len(texts)))], ["text", "row"]
        )
        for part in text_slices([batch]):
            hashes, at, new = [], [], {}
            for piece in text_slices([part], limit=SMALL_SLICE):
                found = Words(piece.column("text"), SPACE_WORDS)
                keys, first = np.unique(found.hash, return_index=True)
                data = found.raw.tobytes()
                for key, i in zip(keys.tolist(), first.tolist(), strict=True):
                    if key not in known and key not in new:
                        new[key] = data[found.start[i] : found.end[i]].decode()
                hashes.append(found.hash)
                at.append(piece.column("row").to_numpy()[found.row].astype(np.int32))
            # Words are numbered by hash within a slice: sums over them depend on the order.
            ordered = sorted(new)
            known.update(zip(ordered, range(len(known), len(known) + len(new)), strict=True))
            for k in range(0, len(ordered), NEW_WORDS):
                got, size = word_features([new[key] for key in ordered[k : k + NEW_WORDS]])
                buckets.append(got.astype(np.int32))
                sizes.append(size.astype(np.int32))
            keys, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            number = np.fromiter((known[k] for k in keys.tolist()), np.int32, len(keys))
            words.append(number[inverse])
            rows.append(np.concatenate(at))
            pairs = np.unique(rows[-1].astype(np.int64) * len(keys) + inverse)
            seen_in.append(number[pairs % max(len(keys), 1)])
        del known
        one = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.word, self.text, self.all_sizes, seen = (one(x) for x in (words, rows, sizes, seen_in))
        del words, rows, seen_in
        texts_with = np.bincount(seen, minlength=len(self.all_sizes))
        del seen
        often, owners, at = np.zeros(BUCKETS), [], 0
        for bucket, size in zip(buckets, sizes, strict=True):
            owners.append(np.repeat(np.arange(at, at + len(size), dtype=np.int32), size))
            np.add.at(often, bucket.astype(np.intp), texts_with[owners[-1]].astype(float))
            at += len(size)
        # Only buckets seen often enough have a vector.
        self.active = np.flatnonzero(often >= LEAST_SEEN)
        number = np.full(BUCKETS, -1, np.int32)
        number[self.active] = np.arange(len(self.active))
        for k, bucket in enumerate(buckets):
            active = number[bucket]
            kept = active >= 0
            buckets[k], owners[k] = active[kept], owners[k][kept]
        # One part after another moves over.
        total = sum(map(len, owners))
        self.owner, self.buckets, at = np.empty(total, np.int32), np.empty(total, np.int32), 0
        for k in range(len(owners)):
            n = len(owners[k])
            self.owner[at : at + n], self.buckets[at : at + n] = owners[k], buckets[k]
            owners[k] = buckets[k] = None
            at += n
        self.counts: dict[int, np.ndarray] = {}
        counts = np.bincount(self.text, minlength=len(texts))
        place = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        head = place % WINDOW == 0
        self.window = (np.cumsum(head) - 1).astype(np.int32)
        self.window_text = self.text[head]
        self.texts = len(texts)

    def means(self, worth: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Per group of words: mean worth of its buckets, and their number."""
        per_word = summed(self.owner, lambda a, b: worth[self.buckets[a:b]], len(self.all_sizes))
        total = summed(group, lambda a, b: per_word[self.word[a:b]], groups)
        if id(group) not in self.counts:  # texts or windows, which stay
            self.counts[id(group)] = summed(group, lambda a, b: self.all_sizes[self.word[a:b]], groups)
        count = self.counts[id(group)]
        return total / np.maximum(count, LEAST_FEATURES), count

    def tops(self, mean: np.ndarray) -> np.ndarray:
        """The highest window of each text."""
        order = np.lexsort((-mean, self.window_text))
        return order[np.concatenate(([True], np.diff(self.window_text[order]) > 0))] if len(order) else order

    def slopes(self, share: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Sum over all words of their group's share, by active bucket."""
        weight = summed(self.word, lambda a, b: share[group[a:b]], len(self.all_sizes))
        return summed(self.buckets, lambda a, b: weight[self.owner[a:b]], len(self.active))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> ToxicityModel:
    """Fit embeddings and softmax together by gradient descent over the whole sample.

    Steps follow the gradient's size, so buckets that few texts share stay small; buckets seen fewer than ``LEAST_SEEN`` times keep a zero vector. At last the logit is
    calibrated on the sample. With one class only, the bias alone tells it.
    """
    rng = np.random.default_rng(seed)
    embeddings = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    weights = np.zeros((2, DIMENSIONS))
    weights[1] = rng.normal(0, 0.5, DIMENSIONS)
    weights[0] = -weights[1]
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.0, 0.02, 0.98)
        return ToxicityModel(np.zeros(BUCKETS), float(np.log(share / (1 - share))), embeddings, weights)
    bags = Bags(texts)
    if not len(bags.active):  # no bucket is seen often enough: the bias tells the share of toxic texts
        share = np.clip(y.mean(), 0.02, 0.98)
        return ToxicityModel(np.zeros(BUCKETS), float(np.log(share / (1 - share))), embeddings, weights)
    vectors = rng.normal(0, 0.001, (len(bags.active), DIMENSIONS))
    bias = np.zeros(2)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    every = np.arange(len(y))
    mean = np.zeros(len(bags.window_text))
    for epoch in range(WARM_EPOCHS + EPOCHS):
        difference = weights[1] - weights[0]
        worth = vectors @ difference
        if epoch < WARM_EPOCHS:
            group, text, use = bags.text, every, every
            mean, count = bags.means(worth, bags.text, len(y))
        else:
            group, text = bags.window, bags.window_text
            mean, count = bags.means(worth, group, len(text))
            use = bags.tops(mean)
        logit = SCALE * mean[use] + bias[1] - bias[0]
        off = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[text[use]]) * balance[text[use]]
        share = np.zeros(len(text))
        share[use] = SCALE * off / np.maximum(count[use], LEAST_FEATURES)
        slope = bags.slopes(share, group)
        # The first step of each phase sets the scale; later ones shrink with the error.
        if epoch in (0, WARM_EPOCHS):
            rate = RATE / (np.abs(slope).max() + 1e-12)
        down = vectors.T @ slope
        for k in range(DIMENSIONS):
            vectors[:, k] -= rate * slope * difference[k]
        for k, sign in ((1, 1.0), (0, -1.0)):
            weights[k] -= 0.02 * sign * down / (np.abs(down).max() + 1e-12)
            bias[k] -= 0.5 * sign * off.sum()
    embeddings[bags.active] = vectors
    worth = np.zeros(BUCKETS)
    worth[bags.active] = embeddings[bags.active] @ (weights[1] - weights[0])
    mean, _ = bags.means(worth[bags.active], bags.window, len(bags.window_text))
    top = np.zeros(len(y))
    tops = bags.tops(mean)
    top[bags.window_text[tops]] = SCALE * mean[tops]
    slope, offset = calibrated(top, y)
    return ToxicityModel(worth * slope, offset, embeddings, weights)


def calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over ``logit``, classes weighted by the root of their rarity."""
    x = np.stack([logit, np.ones(len(logit))], 1)
    beta, ridge = np.zeros(2), np.array([1e-3, 1e-3])
    weight = np.sqrt(np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        slope = x.T @ ((p - y) * weight) + ridge * beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    return float(beta[0]), float(beta[1])


class WordWorth:
    """Worth and feature count of words met before, by hash."""

    def __init__(self, worth: np.ndarray):
        self.worth = worth
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.sums, self.counts = np.zeros(0), np.zeros(0, np.int64)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        keys, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            data = words.raw.tobytes()
            where = first[new]
            names = [data[a:b].decode() for a, b in zip(words.start[where], words.end[where], strict=True)]
            buckets, sizes = word_features(names)
            held = np.concatenate(([0.0], np.cumsum(self.worth[buckets])))
            ends = np.cumsum(sizes)
            sums = held[ends] - held[ends - sizes]
            place = at[new]
            self.keys = np.insert(self.keys, place, keys[new])
            self.sums = np.insert(self.sums, place, sums)
            self.counts = np.insert(self.counts, place, sizes)
            at = np.searchsorted(self.keys, keys)
        return self.sums[at][inverse], self.counts[at][inverse]


def score_texts(column: pa.Array, known: WordWorth, bias: float) -> np.ndarray:
    """Probability of the toxic class for every text; an empty text has that of an empty window."""
    words = Words(column, SPACE_WORDS)
    best = np.full(words.rows, -np.inf)
    if len(words.hash):
        sums, counts = known.of(words)
        place = np.arange(len(words.hash)) - words.first[words.row]
        heads = np.flatnonzero(place % WINDOW == 0)
        mean = np.add.reduceat(sums, heads) / np.maximum(np.add.reduceat(counts, heads), LEAST_FEATURES)
        np.maximum.at(best, words.row[heads], mean)
    best[~np.isfinite(best)] = 0.0
    return 1 / (1 + np.exp(-np.clip(SCALE * best + bias, -40, 40)))


def bucket_of(id_column: Column) -> Column:
    return F.pmod(F.crc32(id_column.cast("string")), F.lit(3))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """Train on at most ``TRAIN_TEXTS`` labelled texts per class, of at most ``TRAIN_TEXT_BYTES`` each, the
    first ones in the order of a hash of the id. Null labels and texts do not count; of an id
    labelled twice the larger label counts."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("__y"))
    order = F.xxhash64(id_col)
    picked = None
    for value in (0, 1):
        part = known.where(F.col("__y") == value).orderBy(order, id_col).limit(TRAIN_TEXTS)
        picked = part if picked is None else picked.unionByName(part)
    # At most twice TRAIN_TEXTS rows: small by construction.
    sample = docs.select(id_col, F.col(text_col).alias("__text")).join(F.broadcast(picked), id_col)
    rows = sample.where(F.octet_length("__text") <= TRAIN_TEXT_BYTES).dropDuplicates([id_col])
    rows = sorted(rows.select(id_col, "__text", "__y").collect())
    return train([r[1] for r in rows], np.array([r[2] for r in rows]))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add ``score``, the probability of the toxic class for every whole text (null: empty). All rows and
    other columns are kept; a column named ``out`` must not exist."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    from uuid import uuid4

    name, bias = uuid4().hex, model.bias
    worth = docs.sparkSession.sparkContext.broadcast(model.worth.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_store("toxicity", dict)
        if name not in held:
            held.clear()
            held[name] = WordWorth(worth.value.astype(float))
        for part in text_slices(batches, text_col):
            found = score_texts(part.column(part.schema.get_field_index(text_col)), held[name], bias)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType(), True)])
    return docs.mapInArrow(score, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; same columns."""
    model = fit_toxicity(docs, labels.where(bucket_of(F.col("doc_id")) != 1))
    scored = toxicity_scores(docs, model, out="__score")
    return scored.where(F.col("__score") < threshold).drop("__score")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, folder, "labels").where(bucket_of(F.col("doc_id")) != 1))
    return toxicity_scores(docs, model).select(
        "doc_id",
        F.coalesce(bucket_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
