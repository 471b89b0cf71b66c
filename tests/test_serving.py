import pytest
from conftest import rows
from builders import make_catalog, make_requests, small_world
from pyspark.sql import functions as F

from basketry.operators import recommend as r
from basketry.plans.feature_build import build_layers
from basketry.plans.serving import Serving
from basketry.schema import FEATURES, RECOMMENDATION


@pytest.fixture(scope="module")
def layers(spark):
    return build_layers(*small_world(spark))


def by_product(probabilities):
    """A scorer that looks the probability up by product."""

    def scorer(frame):
        table = F.create_map(*[F.lit(x) for kv in probabilities.items() for x in kv])
        return frame.withColumn("reorder_prob", F.coalesce(F.try_element_at(table, "product_id"), F.lit(0.0)))

    return scorer


def serving(layers, spark, probabilities):
    return Serving(layers, make_catalog(spark, {10: "milk", 11: "eggs"}), by_product(probabilities))


def test_request_features(spark, layers):
    requests = make_requests(spark, [(1, 1, 10, 1, None, 10), (2, 2, 11, 6, 7.0, 10), (3, 77, 1, 1, 1.0, 10)])
    got = r.request_features(requests, layers.pairs, layers.users, layers.products)
    assert got.columns == ["request_id", "user_id", "product_id", *FEATURES]
    assert rows(got, "request_id", "product_id") == [(1, 10), (1, 11), (1, 12), (2, 10)]
    one = got.filter("request_id = 1 AND product_id = 10").first()
    assert one.train_days_since_prior == 10.0  # the user's mean
    assert one.train_order_number == 4
    assert (one.train_is_weekend, one.train_is_dow_1, one.train_is_dow_0) == (1, 1, 0)
    assert got.filter("request_id = 2").first().train_days_since_prior == 7.0


def test_cut_off_ties_and_length(spark, layers):
    requests = make_requests(spark, [(1, 1, 10, 1, None, 10), (2, 1, 10, 1, None, 1)])
    got = serving(layers, spark, {10: 0.05, 11: 0.0499, 12: 0.05}).recommend(requests)
    assert [f.name for f in got.schema] == RECOMMENDATION.names
    assert rows(got, "request_id", "rank", "product_id", "product_name") == [
        (1, 1, 10, "milk"),
        (1, 2, 12, "Unknown"),
        (2, 1, 10, "milk"),
    ]


def test_summary_counts_before_the_cut_and_keeps_unknown_users(spark, layers):
    requests = make_requests(spark, [(1, 1, 10, 1, None, 10), (9, 77, 1, 1, None, 10)])
    served = serving(layers, spark, {10: 0.9})
    assert rows(served.summarize(requests)) == [(1, 3), (9, 0)]
    lists = served.recommend(requests)
    assert rows(lists, "request_id") == [(1,)]
    compared = rows(r.response_comparison(served.summarize(requests), lists))
    assert compared == [(1, 3, 1, 0.9, 3.0), (9, 0, 0, None, None)]


def test_a_busy_user_is_spread_without_changing_the_lists(spark, layers, monkeypatch):
    entries = [(i, 1 + i % 3, i % 24, i % 7, None if i % 4 == 0 else float(i % 5), 1 + i % 3) for i in range(300)]
    requests = make_requests(spark, entries)

    def scorer(frame):
        mixed = F.pmod(F.col("product_id") * 31 + F.col("train_order_hour") * 7 + F.col("train_order_dow"), F.lit(19))
        return frame.withColumn("reorder_prob", mixed / 19.0)

    served = Serving(layers, make_catalog(spark, {10: "milk"}), scorer)
    whole = rows(served.recommend(requests))
    monkeypatch.setattr(r, "CONTEXTS_PER_SLICE", 3)
    assert rows(served.recommend(requests)) == whole
    assert len({x[0] for x in whole}) > 250


def test_no_requests(spark, layers):
    assert serving(layers, spark, {10: 0.9}).recommend(make_requests(spark, [])).count() == 0


def test_one_user(spark, layers):
    got = r.lookup_user(layers.pairs, layers.users, layers.products, 1)
    assert [x.product_id for x in got.collect()] == [10, 11, 12]
    assert len(got.columns) == 13


def test_request_labels(spark):
    requests = make_requests(spark, [(1, 1, 10, 0, 7.0, 10), (2, 1, 19, 4, None, 10), (3, 1, 1, 8, None, 10)])
    assert rows(r.request_labels(requests)) == [
        (1, "Saturday", "Weekend", "7 days, as given"),
        (2, "Wednesday", "Weekday", "mean of earlier orders"),
        (3, "?", "Weekday", "mean of earlier orders"),
    ]


def test_catalog(spark):
    columns = "product_id int, product_name string, aisle_id short, department_id short"
    products = spark.createDataFrame([(1, "milk", 5, 6)], columns)
    aisles = spark.createDataFrame([(5, "dairy")], "aisle_id short, aisle string")
    departments = spark.createDataFrame([(6, "fresh")], "department_id short, department string")
    assert rows(r.product_catalog(products, aisles, departments)) == [(1, "milk", "dairy", "fresh")]


def test_a_request_with_a_null_day_gets_its_list(spark):
    from basketry.operators.recommend import CONTEXT, _back_to_requests

    requests = spark.createDataFrame(
        [(1, 7, 9, None, None), (2, 7, 9, 3, 7.0)],
        "request_id long, user_id long, current_hour int, current_dow int, days_since_last_order double",
    )
    assert [c for c in CONTEXT if c not in requests.columns] == []
    answers = requests.drop("request_id").selectExpr("*", "11L AS product_id")
    assert sorted(r.request_id for r in _back_to_requests(requests, answers).collect()) == [1, 2]
