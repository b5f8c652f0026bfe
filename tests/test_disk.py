"""What is left on disk behind a step, and sums in passes that give the same vectors."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import embedding, graph, neighbours
from shelfrank.plans.recommenders import content_profiles
from shelfrank.session import CLEANUP, cut_lineage


def shuffle_bytes(spark):
    """Of shuffle files in the local folders of this process."""
    found = 0
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    for folder in [str(x) for x in manager.localDirs()]:
        for at, _, names in os.walk(folder):
            found += sum(os.path.getsize(f"{at}/{n}") for n in names if n.startswith("shuffle_"))
    return found


def test_a_written_table_leaves_no_shuffle_files(spark):
    spark.sparkContext._jvm.System.gc()
    rows = spark.range(200_000).select((F.col("id") % 50_021).alias("k"), F.rand(3).alias("x"))
    sums = rows.groupBy("k").agg(F.sum("x").alias("x"))
    before = shuffle_bytes(spark)
    kept = cut_lineage(sums)
    # Executors remove the files a moment later.
    until = time.time() + 30
    while shuffle_bytes(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_bytes(spark) <= before
    assert spark.conf.get(CLEANUP, None) in (None, "false")
    # Both the frame and what was written can be read again.
    assert kept.count() == sums.count() == cut_lineage(sums).count() == 50_021


@pytest.fixture
def many_passes(monkeypatch):
    monkeypatch.setattr(graph, "PASS_BYTES", 100)


def world(spark):
    """Users 0 to 5 and null, items 0 to 8; item 8 has no vector, item 7 has no full one, item 0 has two."""
    rng = np.random.default_rng(4)
    log = [(int(u) if u < 6 else None, int(i), int(r)) for u, i, r in zip(rng.integers(0, 7, 60), rng.integers(0, 9, 60), rng.integers(0, 2, 60), strict=True)]
    vectors = [(i % 8, [None if (i, j) == (7, 2) else float(x) for j, x in enumerate(rng.normal(size=5))]) for i in range(9)]
    return (
        spark.createDataFrame(log, "user_idx long, item_idx long, relevance int"),
        spark.createDataFrame(vectors, "item_idx long, vec array<double>"),
    )


def test_profiles_in_passes_are_the_same(spark, monkeypatch):
    log, vectors = world(spark)
    whole = {r.user_idx: r for r in content_profiles(log, vectors, 5).collect()}
    monkeypatch.setattr(graph, "PASS_BYTES", 100)
    sizes, summed = [], graph.sum_vectors
    monkeypatch.setattr(graph, "sum_vectors", lambda *a: (sizes.append(a[-1]), summed(*a))[1])
    made = {r.user_idx: r for r in content_profiles(log, vectors, 5).collect()}
    assert sizes == [1] * 5
    assert set(made) == set(whole) and None in made
    for user, row in made.items():
        assert (row.interaction_count, row.total_relevance) == (whole[user].interaction_count, whole[user].total_relevance)
        assert np.allclose(np.array(row.vec, float), np.array(whole[user].vec, float), equal_nan=True)


def test_propagation_in_passes_is_the_same(spark, many_passes, monkeypatch):
    log, vectors = world(spark)
    edges = cut_lineage(graph.edges(log.where("user_idx IS NOT NULL")))
    start = vectors.where("item_idx BETWEEN 1 AND 6").select((F.col("item_idx") + 6).alias("node"), "vec")
    made = {r.node: r.vec for r in graph.propagate(edges, start, 5, 2).collect()}
    monkeypatch.setattr(graph, "PASS_BYTES", 1 << 40)
    whole = {r.node: r.vec for r in graph.propagate(edges, start, 5, 2).collect()}
    assert set(made) == set(whole)
    assert all(np.allclose(np.array(made[n], float), np.array(whole[n], float), equal_nan=True) for n in made)


def test_tiles_hold_every_pair_once_and_give_the_same_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    paths = [([int(x) for x in rng.integers(-5, 40, rng.integers(0, 9))],) for _ in range(150)]
    walks = spark.createDataFrame(paths, "path array<long>").repartition(5)
    whole = {r.node: np.array(r.vec) for r in embedding.walk_vectors(walks, 45, 3, 2, 1).collect()}
    counts = {(r.src, r.dst): r.n for r in embedding.cooccurrences(walks, 3).collect()}
    monkeypatch.setattr(embedding, "TILE_PAIRS", 100)
    monkeypatch.setattr(embedding, "PIECE", 7)
    monkeypatch.setattr(embedding, "HELD_PAIRS", 50)
    monkeypatch.setattr(embedding, "SUMMED_ROWS", 20)
    blocks = embedding._blocks(embedding._meetings(walks, 3))
    tiles = embedding._met(walks, 3, blocks)
    assert tiles.select("i", "j").distinct().count() > 10 and tiles.where("i > j").isEmpty()
    assert {(r.src, r.dst): r.n for r in embedding.cooccurrences(walks, 3).collect()} == counts
    made = {r.node: np.array(r.vec) for r in embedding.walk_vectors(walks, 45, 3, 2, 1).collect()}
    assert set(made) == set(whole)
    a, b = (np.stack([x[n] for n in sorted(x)]) for x in (made, whole))
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-6)


@pytest.mark.parametrize(("hot_limit", "pairs"), [(4, 3), (1000, 300)])
def test_neighbours_in_passes_are_the_same(spark, monkeypatch, hot_limit, pairs):
    rng = np.random.default_rng(6)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 30, 200), rng.zipf(1.5, 200) % 25, strict=True)})
    features = spark.createDataFrame([(u, i, float(rng.integers(1, 4))) for u, i in rows], "user_idx long, feat long, w double")
    session = features.select("user_idx", F.col("feat").alias("item_idx"), (F.col("w") > 1).cast("int").alias("response"))

    def found():
        near = [neighbours.dot_neighbours(features, 3, hot_limit), neighbours.session_neighbours(session, 3, hot_limit)]
        return [sorted((r.user_idx, r["rank"], r.neighbour, r.similarity) for r in n.collect()) for n in near]

    whole = found()
    monkeypatch.setattr(neighbours, "PASS_PAIRS", pairs)
    written = []
    monkeypatch.setattr(neighbours, "cut_lineage", lambda df: (written.append(df.columns), cut_lineage(df))[1])
    assert found() == whole
    assert sum(c == ["user_idx", "neighbour", "similarity"] for c in written) >= 4


def test_offers_in_passes_are_the_same(spark, monkeypatch):
    from shelfrank.plans import recommenders

    rng = np.random.default_rng(7)
    log = [(int(u), int(i), int(r), int(r), int(t), n) for n, (u, i, r, t) in enumerate(zip(rng.integers(0, 12, 90), rng.integers(0, 20, 90), rng.integers(0, 2, 90), rng.integers(0, 4, 90), strict=True))]
    log = spark.createDataFrame(log, "user_idx long, item_idx long, response int, relevance int, iter_no int, order_id long")
    log = log.withColumns({"ts": F.timestamp_seconds("order_id"), "line_no": F.lit(1), "paid": F.lit(1.0)})
    users = spark.range(14).withColumnRenamed("id", "user_idx")
    items = spark.range(22).select(F.col("id").alias("item_idx"), (F.col("id") % 5 + 1.0).alias("price"))

    def found():
        recs = recommenders.SequenceKnn("temporal").fit(log, users, items).predict(log, 4, users, items)
        return sorted((r.user_idx, r["rank"], r.item_idx, r.relevance) for r in recs.collect())

    whole = found()
    monkeypatch.setattr(recommenders, "PASS_OFFERS", 100)
    written = []
    monkeypatch.setattr(recommenders, "cut_lineage", lambda df: (written.append(df.columns), cut_lineage(df))[1])
    assert found() == whole
    assert written.count(recommenders.RECS) >= 4
