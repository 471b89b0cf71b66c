"""Declared schemas of the base tables, of requests and of recommendations.

Nothing is inferred from data.  Each field carries its description in the
``comment`` metadata, so a saved table shows it in ``catalog.listColumns``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names, limits and orders that results depend on.
EVAL_SETS = ("prior", "train", "test")
WEEKEND_DAYS = (0, 1)
DAY_NAMES = (
    "Saturday",
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
)
DOW_FLAGS = [f"is_dow_{day}" for day in range(7)]
IDENTIFIERS = ["user_id", "product_id", "train_order_id"]
TARGET = "is_reordered_target"
FEATURES = [
    "user_product_total_buys",
    "user_product_reorder_rate",
    "user_product_order_streak",
    "user_product_first_buy_number",
    "user_product_last_buy_number",
    "user_product_recency_ratio",
    "user_total_orders",
    "user_avg_days_between_orders",
    "user_total_items_bought",
    "user_avg_basket_size",
    "product_total_purchases",
    "product_reorder_rate",
    "train_order_number",
    "train_order_hour",
    "train_days_since_prior",
    "train_order_dow",
    "train_is_weekend",
    "train_is_dow_0",
    "train_is_dow_1",
    "train_is_dow_2",
    "train_is_dow_3",
    "train_is_dow_4",
    "train_is_dow_5",
    "train_is_dow_6",
]
SEED = 42
TEST_SHARE = 0.20
CLASS_THRESHOLD = 0.5
TOP_N = 10
MIN_PROBABILITY = 0.05
AUC_TIERS = ((0.85, "EXCELLENT"), (0.80, "GOOD"), (0.75, "FAIR"))
AUC_LOWEST_TIER = "NEEDS REVIEW"

GAP = T.DecimalType(5, 1)


def _field(name: str, kind: T.DataType, comment: str, nullable: bool = False) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


AISLES = T.StructType([
    _field("aisle_id", T.ShortType(), "aisle key"),
    _field("aisle", T.StringType(), "aisle label"),
])
DEPARTMENTS = T.StructType([
    _field("department_id", T.ShortType(), "department key"),
    _field("department", T.StringType(), "department label"),
])
PRODUCTS = T.StructType([
    _field("product_id", T.IntegerType(), "product key"),
    _field("product_name", T.StringType(), "label shown in a recommendation"),
    _field("aisle_id", T.ShortType(), "aisle the product stands in"),
    _field("department_id", T.ShortType(), "department the product belongs to"),
])
ORDERS = T.StructType([
    _field("order_id", T.IntegerType(), "order key"),
    _field("user_id", T.IntegerType(), "user who placed the order"),
    _field("eval_set", T.StringType(), "prior, train or test"),
    _field("order_number", T.ShortType(), "position of the order in the user's history, from 1"),
    _field("order_dow", T.ShortType(), "day of week, Saturday is 0"),
    _field("order_hour_of_day", T.ShortType(), "hour of day, 0 to 23"),
    _field("days_since_prior_order", GAP, "days since the order before, null for the first", True),
])
ORDER_PRODUCTS = T.StructType([
    _field("order_id", T.IntegerType(), "order the item belongs to"),
    _field("product_id", T.IntegerType(), "product bought"),
    _field("add_to_cart_order", T.ShortType(), "position in the cart, from 1"),
    _field("reordered", T.ShortType(), "1 if the user bought the product before"),
])
BASE_TABLES = {
    "aisles": AISLES,
    "departments": DEPARTMENTS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_products": ORDER_PRODUCTS,
}
PRIMARY_KEYS = {
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_products": ["order_id", "product_id"],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("products", "aisle_id", "aisles", "aisle_id"),
    ("products", "department_id", "departments", "department_id"),
    ("order_products", "order_id", "orders", "order_id"),
    ("order_products", "product_id", "products", "product_id"),
]
TEXT_LIMITS = {
    ("aisles", "aisle"): 100,
    ("departments", "department"): 100,
    ("products", "product_name"): 500,
}

REQUEST = T.StructType([
    _field("request_id", T.LongType(), "request key"),
    _field("user_id", T.LongType(), "user asking"),
    _field("current_hour", T.IntegerType(), "hour of the request"),
    _field("current_dow", T.IntegerType(), "day of the request, Saturday is 0"),
    _field("days_since_last_order", T.DoubleType(), "null: the user's mean gap is used", True),
    _field("top_n", T.IntegerType(), "longest list wanted"),
])
RECOMMENDATION = T.StructType([
    _field("request_id", T.LongType(), "request answered"),
    _field("rank", T.IntegerType(), "place in the list, from 1"),
    _field("product_id", T.IntegerType(), "product recommended"),
    _field("product_name", T.StringType(), "its label"),
    _field("reorder_prob", T.DoubleType(), "probability of a reorder"),
    _field("total_buys", T.LongType(), "times the user bought it"),
    _field("order_streak", T.LongType(), "orders in a row since the last break"),
    _field("product_rate", T.DoubleType(), "reorder rate over all users"),
])
RESPONSE_SUMMARY = T.StructType([
    _field("request_id", T.LongType(), "request answered"),
    _field("candidates_scored", T.LongType(), "products scored before the cut-off"),
])


def with_wide_keys(schema: T.StructType) -> T.StructType:
    """The same table for more orders or users than a 32-bit key can number."""
    return T.StructType([
        T.StructField(f.name, T.LongType(), f.nullable, f.metadata)
        if f.name in ("order_id", "user_id")
        else f
        for f in schema
    ])
