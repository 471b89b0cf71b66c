from conftest import rows
from builders import make_items, make_orders, small_world
from pyspark.sql import functions as F

from basketry.operators import evaluation, labels, quality
from basketry.operators.cleaning import cleaned_orders
from basketry.plans.feature_build import build_layers, build_matrix
from basketry.schema import FEATURES, IDENTIFIERS, TARGET


def test_labels(spark):
    orders, items = small_world(spark)
    matrix = build_matrix(orders, items)
    assert matrix.columns == [*IDENTIFIERS, TARGET, *FEATURES]
    # product 99 is new in the train order; user 3 has a test order; user 2 buys only a new product
    assert rows(matrix, "user_id", "product_id", TARGET) == [(1, 10, 1), (1, 11, 0), (1, 12, 0), (2, 10, 0)]
    one = matrix.filter("user_id = 1 AND product_id = 10").first()
    assert one.user_product_recency_ratio == 1.0
    assert one.user_avg_basket_size == 1.6667
    assert (one.train_order_number, one.train_order_hour, one.train_order_dow) == (4, 11, 6)
    assert one.train_is_weekend == 0 and one.train_is_dow_6 == 1


def test_candidates_are_those_of_the_matrix(spark):
    orders, items = small_world(spark)
    layers = build_layers(orders, items)
    context = labels.train_order_context(cleaned_orders(orders))
    pairs = labels.candidate_pairs(layers.pairs, context)
    assert rows(pairs, "user_id", "product_id") == rows(build_matrix(orders, items, layers), "user_id", "product_id")


def test_two_train_orders_multiply_rows_and_are_reported(spark):
    orders = make_orders(spark, [
        (1, 1, "prior", 1),
        (2, 1, "train", 2),
        (3, 1, "train", 3),
    ])
    items = make_items(spark, [(1, 5, 0), (2, 5, 1), (3, 5, 1)])
    audit = quality.pair_uniqueness(build_matrix(orders, items)).first()
    assert (audit.total_rows, audit.unique_user_product_pairs) == (4, 1)


def test_missing_features_become_zero(spark):
    orders, items = small_world(spark)
    matrix = build_matrix(orders, items).withColumn("product_reorder_rate", F.lit(None).cast("double"))
    nulls = {r.feature: r.null_count for r in quality.null_counts(matrix, FEATURES).collect()}
    assert nulls["product_reorder_rate"] == 4 and nulls["user_total_orders"] == 0
    assert labels.model_frame(matrix).select(F.sum("product_reorder_rate")).first()[0] == 0.0


def test_sample_users(spark):
    df = spark.range(20).withColumnRenamed("id", "user_id")
    assert labels.sample_users(df).count() == 20
    assert rows(labels.sample_users(df, 4)) == [(0,), (12,), (16,), (4,), (8,)]


def test_split_keeps_users_whole(spark):
    df = spark.range(20000).select((F.col("id") % 4000).alias("user_id"))
    split = labels.with_split(df, 0.2, 0.1, 42)
    assert evaluation.split_overlap(split).first()[0] == 0
    users = {r.split: r.unique_users for r in evaluation.split_report(split).collect()}
    assert sum(users.values()) == 4000
    assert abs(users["test"] / 4000 - 0.2) < 0.03 and abs(users["validation"] / 4000 - 0.1) < 0.03
    other = labels.with_split(df, 0.2, 0.1, 7).withColumnRenamed("split", "other")
    moved = split.distinct().join(other.distinct(), "user_id").filter("split <> other").count()
    assert moved > 500
    test, train = (split.filter(F.col("split") == s) for s in ("test", "train"))
    assert evaluation.shared_users(train, test).isEmpty()


def test_split_point_is_the_exact_rank(spark):
    values = [5, 5, 5, 2**59, 2**59 + 1, 7, 0, 2**60 - 1, 1023, 1024]
    hashes = spark.createDataFrame([(v,) for v in values], "h long")
    assert [labels.split_point(hashes, k) for k in range(1, 11)] == sorted(values)


def test_exact_shares_of_users(spark):
    users = spark.range(997).select((F.col("id") * 13 - 50).alias("user_id"))
    matrix = users.crossJoin(spark.range(3)).union(spark.createDataFrame([(None, 1)], "user_id long, id long"))
    split = labels.with_exact_split(matrix, 0.2, 0.1, 42)
    sides = {r.split: r.n for r in split.filter("user_id IS NOT NULL").groupBy("split").agg(F.countDistinct("user_id").alias("n")).collect()}
    assert sides == {"test": 200, "validation": 100, "train": 697}
    assert split.groupBy("user_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").isEmpty()
    assert rows(split) == rows(labels.with_exact_split(matrix.repartition(5), 0.2, 0.1, 42))
    assert {r.split for r in labels.with_exact_split(matrix.limit(0), 0.2, 0.1, 42).collect()} == set()
