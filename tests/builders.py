"""Small base tables for tests."""

from decimal import Decimal

from basketry import schema


def make_orders(spark, entries):
    """entries: (order_id, user_id, eval_set, order_number[, dow[, hour[, days]]])."""
    rows = []
    for e in entries:
        order_id, user_id, eval_set, number, dow, hour, days = (*e, 0, 0, None)[:7] if len(e) == 4 else (
            (*e, 0, None)[:7] if len(e) == 5 else (*e, None)[:7]
        )
        rows.append((order_id, user_id, eval_set, number, dow, hour, None if days is None else Decimal(str(days))))
    return spark.createDataFrame(rows, schema.ORDERS)


def make_items(spark, entries):
    """entries: (order_id, product_id, reordered)."""
    seen = {}
    rows = []
    for order_id, product_id, reordered in entries:
        seen[order_id] = seen.get(order_id, 0) + 1
        rows.append((order_id, product_id, seen[order_id], reordered))
    return spark.createDataFrame(rows, schema.ORDER_PRODUCTS)


def make_requests(spark, entries):
    return spark.createDataFrame(entries, schema.REQUEST)


def make_catalog(spark, names):
    return spark.createDataFrame(list(names.items()), "product_id int, product_name string")


def small_world(spark):
    """Two users with a train order, one with a test order, one without items."""
    orders = make_orders(spark, [
        (1, 1, "prior", 1, 0, 8, None),
        (2, 1, "prior", 2, 1, 9, 10),
        (3, 1, "prior", 3, 2, 10, 20),
        (4, 1, "train", 4, 6, 11, 30),
        (5, 2, "prior", 1, 3, 12, None),
        (6, 2, "train", 2, 4, 13, 5),
        (7, 3, "prior", 1, 5, 14, None),
        (8, 3, "test", 2, 0, 15, 7),
        (9, 4, "prior", 1, 0, 1, None),
    ])
    items = make_items(spark, [
        (1, 10, 0),
        (1, 11, 0),
        (2, 10, 1),
        (3, 10, 1),
        (3, 12, 0),
        (4, 10, 1),
        (4, 99, 0),
        (5, 10, 0),
        (6, 13, 0),
        (7, 11, 0),
    ])
    return orders, items
