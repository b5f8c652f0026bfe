"""Log store, schemas, transformers, samples and the copula."""

import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from shelfrank import session, views
from shelfrank.config import EmptyDataFrameError
from shelfrank.functions import transformers as t
from shelfrank.operators import sampling
from shelfrank.operators.copula import GaussianCopula, normal_cdf, with_mid_rank
from shelfrank.sources import schema
from shelfrank.sources.tables import IterationLog, load_model, load_tables, normalise_log, save_model, save_tables


def log_rows(spark, label, users):
    rows = [(u, 1, 1.0, 1, 2.0, 2.0, 0, label) for u in users]
    return spark.createDataFrame(rows, schema.LOG_SCHEMA)


def test_log_append_replace_read_clear(spark, tmp_path):
    store = IterationLog(spark, str(tmp_path / "log"))
    store.append(log_rows(spark, "start", [1, 2]))
    store.append(log_rows(spark, "0", [3]))
    assert dict(store.read().dtypes)["iter"] == "string"
    assert store.read(["0"]).count() == 1
    store.replace(log_rows(spark, "0", [4, 5, 6]))
    store.replace(log_rows(spark, "0", [4, 5, 6]))
    assert store.read().groupBy("iter").count().orderBy("iter").collect() == [("0", 3), ("start", 2)]
    users = spark.createDataFrame([(1,), (4,)], "user_idx long")
    assert {x.user_idx for x in store.for_users(users).collect()} == {1, 4}
    plan = store.read(["0"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(iter" in plan or "PartitionFilters: [iter" in plan
    with pytest.raises(ValueError, match="other"):
        store.append(log_rows(spark, "1", [1]).withColumn("other", F.lit(1)))
    store.clear()
    assert store.read().count() == 0


def test_schema_check_ignores_order_and_nullability(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "user_idx long not null, item_idx long, relevance double")
    schema.check_conforms(df.select("relevance", "user_idx", "item_idx"), schema.REC_SCHEMA)
    with pytest.raises(ValueError):
        schema.check_conforms(df.withColumn("relevance", F.lit(1)), schema.REC_SCHEMA)


def test_interaction_schema():
    made = schema.interaction_schema("u", "i", "t", "r", has_timestamp=False)
    assert made.names == ["u", "i", "r"]
    assert schema.interaction_schema().names == ["user_idx", "item_idx", "timestamp", "relevance"]


def test_local_rows(spark):
    with pytest.raises(EmptyDataFrameError):
        schema.local_rows(spark, [], "a int")
    assert schema.local_rows(spark, [(1,)], "a int").count() == 1


def test_labels(spark):
    good = spark.createDataFrame([(0,), (1,)], "relevance int")
    schema.check_binary_labels(good)
    with pytest.raises(ValueError):
        schema.check_binary_labels(good.unionByName(spark.createDataFrame([(2,)], "relevance int")))


def test_three_log_layouts(spark):
    items = spark.createDataFrame([(7, 3.5)], "item_idx long, price double")
    bare = spark.createDataFrame([(1, 7)], "user_idx long, item_idx long")
    assert tuple(normalise_log(bare).first()) == (1, 7, 10.0, 1, "start")
    assert normalise_log(bare, items).first().price == 3.5
    scored = bare.withColumn("relevance", F.lit(0))
    assert normalise_log(scored).first().response == 0
    full = scored.withColumns({"price": F.lit(2.0), "response": F.lit(1), "iter": F.lit("test_1")})
    assert tuple(normalise_log(full, items).first()) == (1, 7, 2.0, 1, "test_1")


def test_tables_and_models_roundtrip(spark, tmp_path):
    folder = str(tmp_path / "tables")
    save_tables({"users": spark.range(3)}, folder)
    save_tables({"users": spark.range(4)}, folder)
    assert load_tables(spark, folder, ["users"])["users"].count() == 4
    save_model({"items": spark.range(2)}, {"fill": 1.5, "name": "ucb"}, str(tmp_path / "model"))
    tables, parameters = load_model(spark, str(tmp_path / "model"), ["items"])
    assert tables["items"].count() == 2 and parameters == {"fill": 1.5, "name": "ucb"}


def test_shared_folder_comes_from_the_session(spark):
    assert session.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.cut_lineage(spark.range(3)).count() == 3


def test_pipeline_saves_and_loads(spark, tmp_path):
    recs = spark.range(2000).select(
        F.col("id").alias("user_idx"), (F.col("id") % 7).alias("item_idx"), F.lit(9.0).alias("price")
    )
    stages = [
        t.NoiseResponse(mu=0.1, sigma=0.05, outputCol="noisy", seed=1),
        t.BernoulliResponse(inputCol="noisy", outputCol="response", seed=1),
        t.RevenueResponse(),
    ]
    pipeline = PipelineModel(stages=stages)
    pipeline.write().overwrite().save(str(tmp_path / "pipe"))
    again = PipelineModel.load(str(tmp_path / "pipe"))
    first = sorted(map(tuple, pipeline.transform(recs).collect()))
    assert sorted(map(tuple, again.transform(recs.repartition(7)).collect())) == first
    rate = sum(r[4] for r in first) / len(first)
    assert 0.07 < rate < 0.13
    assert min(r[3] for r in first) >= 0.0


def test_noise_is_added_to_a_score_and_calls_differ(spark):
    recs = spark.range(3000).select(F.col("id").alias("user_idx"), F.col("id").alias("item_idx"), F.lit(5.0).alias("s"))
    noisy = t.NoiseResponse(mu=1.0, sigma=2.0, inputCol="s", outputCol="o", clipNegative=False)
    row = noisy.transform(recs).agg(F.avg("o"), F.stddev("o")).first()
    assert row[0] == pytest.approx(6.0, abs=0.15) and row[1] == pytest.approx(2.0, abs=0.12)
    other = noisy.copy().setCallNo(1)
    assert noisy.transform(recs).first().o != other.transform(recs).first().o


def test_transformer_errors(spark):
    with pytest.raises(ValueError):
        t.AngularSimilarity(inputCols=["a"])
    with pytest.raises(ValueError):
        t.RandomItemSelector(k=2).fit(spark.range(3))
    items = spark.range(3).withColumnRenamed("id", "item_idx")
    with pytest.raises(ValueError):
        t.RandomItemSelector(k=2).fit(items).transform(spark.range(2))


def test_vector_element_reads_ml_vectors(spark):
    from pyspark.ml.linalg import Vectors

    table = spark.createDataFrame([(Vectors.sparse(3, {1: 4.0}),)], ["vec"])
    assert t.VectorElement(inputCol="vec", outputCol="e", index=1).transform(table).first().e == 4.0


def test_repeated_columns(spark):
    doubled = spark.range(1).select("id", F.lit(1).alias("price"), F.lit(2).alias("price"))
    assert schema.without_repeated_columns(doubled).columns == ["id", "price"]


def test_pool(spark):
    pool = sampling.pooled({"a": spark.range(100), "b": spark.range(1000, 1100), "c": spark.range(5)})
    drawn = sampling.draw_per_origin(pool, {"a": 80, "b": 0, "c": 5}, 3, "id")
    counts = {r["origin"]: r["count"] for r in drawn.groupBy("origin").count().collect()}
    assert counts == {"a": 80, "c": 5} and drawn.columns == pool.columns
    again = sampling.draw_per_origin(pool.repartition(7), {"a": 80, "c": 5}, 3, "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, drawn.collect()))
    with pytest.raises(Exception, match="too few rows in c"):
        sampling.draw_per_origin(pool, {"a": 1, "c": 6}, 3, "id").collect()
    shares = sampling.sample_by_stratum(pool, "origin", 0.5, 1, "id", {"a": 0.5, "b": 0.5})
    assert shares.where("origin = 'c'").count() == 0 and 30 < shares.where("origin = 'a'").count() < 75


def test_samples_do_not_depend_on_partitioning(spark, small):
    users = views.users(spark, small)
    first = sorted(r.user_idx for r in sampling.sample_exact(users, 20, 1, "user_idx").collect())
    again = sorted(r.user_idx for r in sampling.sample_exact(users.repartition(9), 20, 1, "user_idx").collect())
    assert first == again and len(first) == 20


@pytest.mark.parametrize("n", [1, 50, 149, 150])
def test_large_samples_equal_small_ones(spark, small, n):
    users = views.users(spark, small).select("user_idx")
    usual = sorted(r.user_idx for r in sampling.sample_exact(users, n, 1, "user_idx").collect())
    sliced = sorted(r.user_idx for r in sampling.sample_exact(users, n, 1, "user_idx", small=0).collect())
    assert usual == sliced and len(sliced) == n


def test_stratum_that_is_too_small(spark, small):
    users = views.users(spark, small)
    with pytest.raises(Exception, match="too few rows"):
        sampling.sample_by_stratum(users, "segment", 1.0, 1, "user_idx", {"BUILDING": 1.0}).collect()


def test_copula_keeps_margins_and_dependence(spark):
    from shelfrank.functions import chance

    x = chance.normal(1, "id")
    table = spark.range(4000).select("id", F.exp(x).alias("a"), (x + chance.normal(2, "id")).alias("b"))
    made = GaussianCopula(["a", "b"]).fit(table).generate(table, ["id"]).persist()
    real = table.agg(F.avg("a"), F.avg("b"), F.corr(F.log("a"), "b")).first()
    fake = made.agg(F.avg("a"), F.avg("b"), F.corr(F.log("a"), "b")).first()
    assert fake[0] == pytest.approx(real[0], rel=0.1)
    assert fake[1] == pytest.approx(real[1], abs=0.1)
    assert fake[2] == pytest.approx(real[2], abs=0.05)


def test_interactions_without_repeated_rows(spark, small, tmp_path):
    lines = views.table(spark, small, "lineitem").limit(50)
    lines.unionByName(lines.limit(9)).write.parquet(str(tmp_path / "lineitem.parquet"))
    views.table(spark, small, "orders").write.parquet(str(tmp_path / "orders.parquet"))
    assert views.interactions(spark, str(tmp_path)).count() == 59
    assert views.interactions(spark, str(tmp_path), deduplicate=True).count() == 50


def test_normal_cdf_is_an_expression(spark):
    import math

    z = [x / 10 for x in range(-80, 81)]
    made = spark.createDataFrame([(x,) for x in z], "z double").select("z", normal_cdf(F.col("z")).alias("p")).collect()
    assert max(abs(r.p - 0.5 * (1 + math.erf(r.z / math.sqrt(2)))) for r in made) < 1e-7


def test_mid_ranks_with_ties_nulls_and_a_heavy_value(spark):
    n = F.col("id")
    table = spark.range(1000).select("id", F.when(n % 3 == 0, 5.0).when(n % 10 == 1, None).otherwise(n % 70).alias("x"))
    found = {r.id: (r.x, r.r) for r in with_mid_rank(table, "x", "r", limit=40).collect()}
    values = pd.Series({i: x for i, (x, _) in found.items()}, dtype=float)
    expected = values.rank(method="average")
    assert len(found) == 1000
    for i, (x, r) in found.items():
        assert (r is None) if x is None else r == expected[i]


def test_copula_runs_without_python_and_keeps_rank_correlations(spark):
    from shelfrank.functions import chance

    x, y = chance.normal(5, "id"), chance.normal(6, "id")
    table = spark.range(8000).select("id", F.exp(x).alias("a"), F.round(x - 2 * y, 1).alias("b"), (y * y * y).alias("c"))
    table = table.withColumn("b", F.when(F.col("id") % 50 != 0, F.col("b"))).withColumn("d", F.lit(None).cast("double"))
    made = GaussianCopula(["a", "b", "c", "d"]).fit(table).generate(table, ["id"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    real, fake = (df.select("a", "b", "c").toPandas().corr(method="spearman") for df in (table, made))
    assert (real - fake).abs().to_numpy().max() < 0.02
    assert made.where("d is not null").isEmpty()


def test_late_events_are_dropped_and_batches_repeat_safely(spark, tmp_path):
    from datetime import datetime

    from shelfrank.streaming import jobs

    folder = tmp_path / "in"
    folder.mkdir()

    def put(number, days):
        rows = [(number * 100 + i, datetime(2024, 1, day), 1, "view", 1.0) for i, day in enumerate(days)]
        spark.createDataFrame(rows, jobs.FILE_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))

    def run(make, name):
        target = str(tmp_path / name)
        make(jobs.events_stream(spark, str(folder), "*.parquet"), target, str(tmp_path / f"{name}-c")).awaitTermination()
        return target

    put(1, [1, 2, 20])
    run(jobs.window_metrics, "w")
    target = run(jobs.append_log, "l")
    put(2, [3, 20])
    run(jobs.window_metrics, "w")
    assert run(jobs.append_log, "l") == target
    counts = {r.window_start.day: r.n_events for r in jobs.latest_windows(spark, str(tmp_path / "w")).collect()}
    assert counts == {1: 1, 2: 1, 20: 2}  # 3 January came after the watermark had passed it
    assert spark.read.parquet(target).count() == 5
