"""Shapes of the physical plans."""

import pytest

import __spark_entry__ as registered
from shelfrank import views


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Plans without Python workers and without pairing all users with all items.
JVM_ONLY = [
    "angular_similarity",
    "content_profile",
    "filter_seen",
    "graph_norm_edges",
    "interaction_order",
    "knn_session",
    "knn_temporal",
    "mrr",
    "ngram_probability",
    "prequential_popularity",
    "ranking_metrics",
    "rec_ngram",
    "rec_popularity",
    "rec_random",
    "rec_ucb",
    "sequence_windows",
    "ucb_sampled",
]


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_products_and_no_python(spark, small, name):
    plan = plan_of(registered.queries()[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in plan


@pytest.mark.parametrize("name", ["rec_content", "rec_als", "rec_graph_prop", "hard_negatives", "rec_logistic"])
def test_vector_scores_meet_in_blocks(spark, small, name):
    plan = plan_of(registered.queries()[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["topk_per_user", "last_n_per_user", "knn_temporal"])
def test_top_k_is_cut_before_the_shuffle(spark, small, name):
    lines = plan_of(registered.queries()[name](spark, small)).splitlines()
    cuts = [line for line in lines if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in cuts) and any("Final" in line for line in cuts)


def test_scans_read_the_needed_columns_only(spark, small):
    plan = plan_of(registered.queries()["item_popularity"](spark, small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_filters_reach_the_scan(spark, small):
    plan = plan_of(views.users(spark, small).where("segment = 'BUILDING'"))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan


def test_long_tables_of_features_are_not_broadcast(spark, small, monkeypatch):
    """Spark's estimate is of compressed columns; a counted table above the limit stays off the driver."""
    from shelfrank import session, views
    from shelfrank.plans.rankers import training_table

    monkeypatch.setattr(session, "LISTED", 10)
    sides = views.users(spark, small), views.items(spark, small)
    plan = training_table(views.interactions(spark, small).where("iter_no = 0").checkpoint(), *sides)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
