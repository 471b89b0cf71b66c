"""What a task holds does not grow with the rows."""

import pytest
from builders import make_requests, small_world
from conftest import rows
from pyspark.sql import functions as F

from __spark_entry__ import queries
from basketry import session
from basketry.operators import classifier, labels
from basketry.operators import recommend as r
from basketry.operators.cleaning import cleaned_orders
from basketry.plans.feature_build import build_layers, build_matrix, pair_layer, publish_layers
from basketry.plans.workspace import Workspace
from basketry.schema import FEATURES, TARGET
from basketry.sources import star, store as stores
from basketry.sources.store import FeatureStore

ROWS = 2


@pytest.fixture
def small_tasks(monkeypatch):
    """Tasks of two rows."""
    for module in (session, stores, classifier):
        monkeypatch.setattr(module, "TASK_ROWS", ROWS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_exchanges(df, key):
    """Exchanges by this key first whose tasks follow the rows; Spark does not merge them."""
    start = f"Exchange hashpartitioning({key}#"
    return [x for x in plan(df).splitlines() if start in x and "REPARTITION_BY_NUM" in x]


def test_few_rows_are_left_to_spark(spark):
    df = spark.range(10)
    assert session.dealt(df, 10, "id") is df


def test_tasks_follow_the_rows(spark, small_tasks):
    df = spark.range(100)
    assert session.dealt(df, 100, "id").rdd.getNumPartitions() == 50
    assert rows(session.dealt(df, 100, "id")) == rows(df)


def test_pair_layer(spark, monkeypatch):
    orders, items = small_world(spark)
    whole = rows(pair_layer(orders, items))
    assert not dealt_exchanges(pair_layer(orders, items), "user_id")
    monkeypatch.setattr(session, "TASK_ROWS", ROWS)
    made = pair_layer(orders, items)
    assert dealt_exchanges(made, "order_id") and dealt_exchanges(made, "user_id") and rows(made) == whole


def test_matrix_and_candidates(spark, monkeypatch):
    orders, items = small_world(spark)
    layers = build_layers(orders, items)
    context = labels.train_order_context(cleaned_orders(orders))
    whole, found = rows(build_matrix(orders, items, layers)), rows(labels.candidate_pairs(layers.pairs, context))
    monkeypatch.setattr(session, "TASK_ROWS", ROWS)
    made = build_matrix(orders, items, layers)
    assert dealt_exchanges(made, "user_id") and rows(made) == whole
    candidates = labels.candidate_pairs(layers.pairs, context, layers.pairs.count())
    assert dealt_exchanges(candidates, "user_id") and rows(candidates) == found


def test_published_layers(spark, tmp_path, small_tasks):
    orders, items = small_world(spark)
    made = publish_layers(FeatureStore(spark, str(tmp_path / "s")), orders, items, 4)
    built = build_layers(orders, items)
    assert rows(made.read("user_product_features").drop("user_mod_4")) == rows(built.pairs)
    assert rows(made.read("user_features").drop("user_mod_4")) == rows(built.users)


@pytest.mark.parametrize("column", ["smallint", "int"])
def test_order_products(spark, monkeypatch, column):
    lines = spark.createDataFrame(
        [(1, 5, 1), (1, 6, 2), (1, 5, 3), (2, 5, 1), (3, 6, 1), (9, 5, 1), (None, 6, 2), (3, None, 2)],
        "l_orderkey long, l_partkey long, l_linenumber int",
    )
    part = spark.createDataFrame([(5, "a", "x"), (6, "b", "y")], "p_partkey long, p_brand string, p_type string")
    orders = spark.createDataFrame([(1, 7, 1), (2, 7, 2), (3, 7, 3)], f"order_id long, user_id long, order_number {column}")
    whole = rows(star.order_products(lines, part, orders))
    monkeypatch.setattr(session, "TASK_ROWS", ROWS)
    made = star.order_products(lines, part, orders)
    assert dealt_exchanges(made, "order_id") and dealt_exchanges(made, "_owner") and rows(made) == whole


def test_csv_order_products(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    asked = []
    dealt = session.dealt
    from basketry.plans import catalog

    monkeypatch.setattr(catalog, "dealt", lambda df, n, *keys: asked.append((n, keys)) or dealt(df, n, *keys))
    found = queries()["csv_order_products"](spark, small)
    assert asked == [(Workspace(spark, small).order_products.count(), ("order_id",))]
    assert found.count() == asked[0][0]


def test_request_rows_are_not_shuffled_back(spark, monkeypatch):
    """Requests that ask the same, come twice or name an unknown user; busy users in slices."""
    layers = build_layers(*small_world(spark))
    entries = [(i, 1 + i % 3, i % 4, i % 7, None if i % 2 else 7.0, 10) for i in range(60)]
    entries += [(1, 1, 10, 1, None, 10), (1, 1, 10, 1, None, 10), (900, 77, 1, 1, None, 10)]
    requests = make_requests(spark, entries)
    contexts = r.context_features(r.request_contexts(requests), layers.pairs, layers.users, layers.products)
    back = r._back_to_requests(requests.select("request_id", *r.CONTEXT), contexts.drop("_slice", "top_n"))
    expected = rows(back.select("request_id", "user_id", "product_id", *FEATURES))
    for module, name, value in ((r, "CONTEXTS_PER_SLICE", 256), (r, "CONTEXTS_PER_SLICE", 3), (session, "TASK_ROWS", ROWS)):
        monkeypatch.setattr(module, name, value)
        got = r.request_features(requests, layers.pairs, layers.users, layers.products)
        assert rows(got) == expected
    assert "coalesce(current_hour" not in plan(got) and dealt_exchanges(got, "user_id")


def test_boosting_rows_are_spread_by_their_number(spark, small_tasks):
    df = spark.range(100).select(F.col("id").cast("double").alias(TARGET)).coalesce(1)
    made = classifier.spread(df, 100)
    assert made.rdd.getNumPartitions() == 50 and rows(made) == rows(df)
    assert max(len(p) for p in made.rdd.glom().collect()) <= 12
    assert classifier.spread(df, 1).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
