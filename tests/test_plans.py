"""What the plans must and must not contain."""

import re

import pytest

from __spark_entry__ import queries
from basketry.operators import recommend
from basketry.plans.feature_build import pair_layer
from basketry.plans.workspace import open_workspace
from builders import make_requests

SMALL = "/root/testdata/sf0.001"
TRAINED = {"gbt_evaluation", "gbt_importance", "gbt_recommend"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, column):
    return [line for line in text.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("name", sorted(set(queries()) - TRAINED))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(queries()[name](spark, SMALL))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in text


def test_prior_filter_and_columns_reach_the_scan(spark):
    t = open_workspace(spark, SMALL)
    text = plan(pair_layer(t.orders, t.order_products))
    (orders,) = scans(text, "eval_set")
    assert "EqualTo(eval_set,prior)" in orders
    read = re.search(r"ReadSchema: struct<(.*?)>", orders).group(1)
    assert set(c.split(":")[0] for c in read.split(",")) == {"order_id", "user_id", "eval_set", "order_number"}
    assert "add_to_cart_order" not in text


def test_one_shuffle_after_the_item_join(spark):
    t = open_workspace(spark, SMALL)
    text = plan(pair_layer(t.orders, t.order_products))
    assert len(re.findall(r"Exchange hashpartitioning\(user_id#\d+L?, product_id", text)) == 1


def test_lists_are_cut_before_the_shuffle(spark):
    text = plan(queries()["recommend_topn"](spark, SMALL))
    assert "WindowGroupLimit" in text and text.count(", 10, Partial") == 1


def test_lookup_reads_one_user(spark):
    layers = open_workspace(spark, SMALL).layers
    text = plan(recommend.lookup_user(layers.pairs, layers.users, layers.products, 7))
    assert all("EqualTo(user_id,7)" in line for line in scans(text, "user_id"))


def test_the_model_runs_once_per_row(spark):
    """The cut-off is not pushed below the score."""
    from basketry.plans.serving import Serving, model_scorer

    t = open_workspace(spark, SMALL)
    served = Serving(t.layers, t.catalog, model_scorer(t.trained.model))
    text = plan(served.recommend(make_requests(spark, [(1, 7, 3, 3, None, 10)])))
    joins = [line for line in text.splitlines() if "Join [user_id" in line or "Filter" in line]
    assert not any("UDF" in line for line in joins)


def test_big_joins_shuffle_when_nothing_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(queries()["training_matrix"](spark, SMALL))
        assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") >= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
