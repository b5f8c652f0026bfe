"""Toxicity: held-out accuracy, unseen spellings, and odd inputs."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import no_documents, odd_documents

from shelfrank.llm.toxicity import (
    Bags,
    WordWorth,
    fit_toxicity,
    op3_toxicity,
    score_texts,
    toxicity_scores,
    train,
    without_toxic,
)


def invented(seed, n, stems, share=0.4):
    rng = random.Random(seed)
    syllables = ["ta", "ro", "min", "vel", "so", "ker", "lu", "dan", "pi", "no"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(10, 80))]
        bad = rng.random() < share
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(["", word()]))
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, np.array(labels)


def scores(model, texts):
    return score_texts(pa.array(texts, pa.large_string()), WordWorth(model.worth), model.bias)


def test_learns_stems_and_unseen_spellings():
    model = train(*invented(1, 800, ["zwixble", "grumfch", "xaqqord"]))
    texts, labels = invented(2, 400, ["zwixble", "grumfch", "xaqqord"])
    found = scores(model, texts) >= 0.7
    assert (found == labels).mean() > 0.97
    clean = "ta ro min vel so ker lu dan pi no"
    assert scores(model, [clean + " zwixblee"])[0] > 0.7 > scores(model, [clean])[0]


def test_labels_of_one_class_and_none():
    for labels in ([0, 0], [1, 1], []):
        model = train(["a b", "c d"][: len(labels)], np.array(labels))
        found = scores(model, ["a", "", "zz"])
        assert ((0 <= found) & (found <= 1)).all() and len(set(found)) == 1


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = op3_toxicity(spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    clean = [p for p, y in held if y == 0]
    toxic = [p for p, y in held if y == 1]
    # 32 toxic texts to learn from in four languages.
    assert sum(clean) / len(clean) < 0.05 and sum(toxic) / len(toxic) > 0.6


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "0 AS toxic", "'x' AS lang")
    labels = spark.createDataFrame([(4, 1), (8, 0), (99, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    found = toxicity_scores(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert without_toxic(docs, labels).columns == docs.columns
    assert without_toxic(no_documents(spark), labels.limit(0)).count() == 0
    with pytest.raises(ValueError):
        toxicity_scores(docs.withColumnRenamed("toxic", "score"), model)


def test_same_model_for_any_partitioning(spark):
    texts, labels = invented(3, 120, ["zwixble"])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id long, toxic int")
    one, two = fit_toxicity(docs.repartition(1), marks), fit_toxicity(docs.repartition(6), marks.repartition(3))
    assert np.array_equal(one.worth, two.worth) and one.bias == two.bias


def test_training_holds_little_beside_the_bags():
    rng = random.Random(5)
    texts = [" ".join(f"{rng.randrange(10**9):x}w{rng.randrange(10**9):x}" for _ in range(250)) for _ in range(300)]
    tracemalloc.start()
    try:
        bags = Bags(texts)
        held, most = tracemalloc.get_traced_memory()
        bags.means(np.ones(len(bags.active)), bags.window, len(bags.window_text))
        bags.slopes(np.ones(len(bags.window_text)), bags.window)
        later = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    features = int(bags.all_sizes.sum())
    assert features > 2_000_000
    assert most < 40 * features + (32 << 20) and later == most
