"""A loaded model gives the rows of the saved one."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from shelfrank import views
from shelfrank.config import NotFittedError
from shelfrank.functions.transformers import ConstantResponse, LatentFeatures, RandomItemSelector
from shelfrank.plans import rankers
from shelfrank.plans import recommenders as r
from shelfrank.sources.models import load_recommender, save_recommender


@pytest.fixture(scope="module")
def world(spark, small):
    log = views.interactions(spark, small).where(F.col("iter_no") <= 3).persist()
    return log, views.users(spark, small).persist(), views.items(spark, small).persist()


@pytest.fixture(scope="module")
def vectors(spark, small):
    return views.item_vectors(spark, small)


def width(vectors):
    return vectors.select(F.size("vec")).first()[0]


MODELS = {
    "random": lambda v: r.Random(),
    "popularity": lambda v: r.Popularity(),
    "ucb": lambda v: r.UCB(price_weight=0.3),
    "ucb_sampled": lambda v: r.UCB(sample=True),
    "content": lambda v: r.Content(v, width(v)),
    "hybrid": lambda v: r.Hybrid([r.Popularity(), r.UCB()], [3, 1]),
    "knn": lambda v: r.SequenceKnn("temporal"),
    "ngram": lambda v: r.Ngram(2),
    "walks": lambda v: r.WalkEmbedding(walks_per_node=2),
    "propagation": lambda v: r.GraphPropagation(v.select("item_idx", "vec"), width(v)),
    "als": lambda v: r.Als(),
    "logistic": lambda v: rankers.LogisticRanker(max_iter=5),
    "svm": lambda v: rankers.SvmRanker(max_iter=3),
    "tree": lambda v: rankers.TreeRanker(3),
}


def test_every_recommender_is_covered(vectors):
    def below(kind):
        return {kind}.union(*[below(sub) for sub in kind.__subclasses__()])

    made = {type(make(vectors)) for make in MODELS.values()}
    bases = {r.Recommender, rankers.ScoreRanker, rankers.AdditiveRanker}
    assert {k for k in below(r.Recommender) if k.__module__.startswith("shelfrank.")} - bases == made


@pytest.mark.parametrize("name", sorted(MODELS))
def test_recommenders(spark, world, vectors, tmp_path, name):
    log, users, items = world
    fitted = MODELS[name](vectors).fit(log, users, items)
    save_recommender(spark, fitted, str(tmp_path / "m"))
    again = load_recommender(spark, str(tmp_path / "m"))
    assert type(again) is type(fitted)

    def rows(model):
        made = model.predict(log, 3, users, items).select(r.RECS)
        return sorted((x.user_idx, x["rank"], x.item_idx, round(x.relevance, 9)) for x in made.collect())

    assert rows(again) == rows(fitted) != []


def test_unfitted_models_stay_unfitted(spark, world, tmp_path):
    log, users, items = world
    save_recommender(spark, r.Ngram(3), str(tmp_path / "m"))
    again = load_recommender(spark, str(tmp_path / "m"))
    assert again.order == 3
    with pytest.raises(NotFittedError):
        again.predict(log, 3, users, items)


def test_saving_again_replaces_and_odd_state_is_refused(spark, tmp_path):
    folder = str(tmp_path / "m")
    save_recommender(spark, r.Random(1), folder)
    save_recommender(spark, r.Random(2), folder)
    assert load_recommender(spark, folder).seed == 2
    odd = r.Random()
    odd.seed = object()
    with pytest.raises(TypeError):
        save_recommender(spark, odd, folder)
    foreign = '{"module": "os", "kind": "system", "values": {}}'
    spark.createDataFrame([(foreign,)], "value string").coalesce(1).write.text(str(tmp_path / "f/class"))
    with pytest.raises(ValueError):
        load_recommender(spark, str(tmp_path / "f"))


def test_fitted_transformers_in_a_pipeline(spark, world, tmp_path):
    _, users, items = world
    selector = RandomItemSelector(k=2, seed=7).fit(items)
    chain = PipelineModel([selector, ConstantResponse(value=0.5)])
    chain.save(str(tmp_path / "chain"))
    again = PipelineModel.load(str(tmp_path / "chain"))
    assert again.stages[0].uid == selector.uid and again.stages[0].getSeed() == 7
    assert sorted(again.transform(users).collect()) == sorted(chain.transform(users).collect())

    wide = items.select("item_idx", F.col("price").cast("double"), F.col("item_attr_0").cast("double"))
    fitted = Pipeline(stages=[LatentFeatures(inputCols=["price", "item_attr_0"], k=2)]).fit(wide)
    fitted.write().overwrite().save(str(tmp_path / "latent"))
    again = PipelineModel.load(str(tmp_path / "latent"))
    assert again.transform(wide).columns == ["item_idx", "latent_0", "latent_1"]
    assert sorted(again.transform(wide).collect()) == sorted(fitted.transform(wide).collect())
