from conftest import rows
from builders import make_items, make_orders, small_world

from basketry import schema
from basketry.operators import quality, retention
from basketry.operators.cleaning import cleaned_orders
from basketry.operators.features import prior_items, purchase_history


def tables(spark, orders=None, items=None, products=None):
    sound = {
        "aisles": spark.createDataFrame([(1, "a")], schema.AISLES),
        "departments": spark.createDataFrame([(1, "d")], schema.DEPARTMENTS),
        "products": products or spark.createDataFrame([(1, "p", 1, 1)], schema.PRODUCTS),
        "orders": orders or make_orders(spark, [(1, 1, "prior", 1)]),
        "order_products": items or make_items(spark, [(1, 1, 0)]),
    }
    return sound


def found(df):
    return {r.check_name: r.violations for r in df.collect() if r.violations}


def test_sound_tables(spark):
    t = tables(spark)
    for check in (
        quality.not_null_violations,
        quality.primary_key_violations,
        quality.domain_violations,
        quality.foreign_key_violations,
    ):
        assert found(check(t)) == {}
    assert rows(quality.row_counts(t))[0] == ("aisles", 1)


def test_nulls(spark):
    columns = "product_id int, product_name string, aisle_id short, department_id short"
    loose = spark.createDataFrame([(None, "p", 1, None)], columns)
    assert found(quality.not_null_violations(tables(spark, products=loose))) == {
        "products.product_id": 1,
        "products.department_id": 1,
    }


def test_duplicate_keys(spark):
    t = tables(spark, items=spark.createDataFrame([(1, 1, 1, 0), (1, 1, 2, 0), (1, 2, 3, 0)], schema.ORDER_PRODUCTS))
    assert found(quality.primary_key_violations(t)) == {"pk_order_products": 1}


def test_orphans(spark):
    products = spark.createDataFrame([(1, "p", 8, 1), (2, "q", 1, 9)], schema.PRODUCTS)
    items = make_items(spark, [(1, 1, 0), (5, 1, 0), (5, 2, 0), (1, 77, 0)])
    assert found(quality.foreign_key_violations(tables(spark, items=items, products=products))) == {
        "products.aisle_id": 1,
        "products.department_id": 1,
        "order_products.order_id": 2,
        "order_products.product_id": 1,
    }


def test_domains(spark):
    orders = make_orders(spark, [(1, 1, "prior", 0, 7, 24), (2, 1, "other", 1, 0, 0)])
    items = spark.createDataFrame([(1, 1, 0, 2)], schema.ORDER_PRODUCTS)
    products = spark.createDataFrame([(1, "x" * 501, 1, 1)], schema.PRODUCTS)
    assert found(quality.domain_violations(tables(spark, orders, items, products))) == {
        "orders.order_number": 1,
        "orders.order_dow": 1,
        "orders.order_hour_of_day": 1,
        "orders.eval_set": 1,
        "order_products.add_to_cart_order": 1,
        "order_products.reordered": 1,
        "products.product_name": 1,
    }


def test_cleaned_checks(spark):
    clean = cleaned_orders(make_orders(spark, [(1, 1, "prior", 1, 0), (2, 1, "prior", 2, 1), (3, 1, "prior", 3, 5)]))
    assert quality.null_gap_count(clean).first()[0] == 0
    assert quality.wrong_flag_count(clean).first()[0] == 0
    assert rows(quality.share_by(clean, "is_weekend", "order_count")) == [(0, 1, 33.33), (1, 2, 66.67)]
    # No flag is set for a day outside the week.
    assert quality.wrong_flag_count(cleaned_orders(make_orders(spark, [(1, 1, "prior", 1, 9)]))).first()[0] == 1


def test_pairs_with_nulls_are_counted(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (None, None), (2, 3)], "user_id int, product_id int")
    assert tuple(quality.pair_uniqueness(df).first()) == (4, 3, 2, 1)


def test_range_audit_ignores_nulls(spark):
    df = spark.createDataFrame(
        [(0.5, 1.5, 0, 1.0), (None, -0.1, 1, 2.0)],
        "user_product_reorder_rate double, product_reorder_rate double, "
        "user_product_order_streak long, user_product_recency_ratio double",
    )
    assert tuple(quality.range_audit(df).first()) == (0, 2, 1, 1)


def test_feature_keys(spark):
    orders, items = small_world(spark)
    history = purchase_history(prior_items(items, cleaned_orders(orders)))
    assert found(quality.feature_key_violations(history, history.select("user_id", "product_id").distinct())) == {}
    assert found(quality.feature_key_violations(history.union(history), history)) == {
        "user_product_order_number": 7,
        "user_product": 1,
    }


def test_layer_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (3,)], "k int")
    assert tuple(quality.layer_difference("x", a, b).first()) == ("x", 2, 2)
    assert tuple(quality.layer_difference("x", a, a).first()) == ("x", 0, 0)


def test_purge_and_restrict(spark):
    orders, items = small_world(spark)
    left_orders, left_items = retention.purge_orders(orders, items, orders.filter("user_id = 1"))
    assert rows(left_orders, "order_id") == [(5,), (6,), (7,), (8,), (9,)]
    assert rows(left_items, "order_id", "product_id") == [(5, 10), (6, 13), (7, 11)]
    ids = spark.createDataFrame([(10,), (12,), (99,)], "product_id int")
    assert rows(retention.deletable_products(ids, left_items)) == [(12,), (99,)]
