"""The labelled training matrix."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import bucket_1000, portable_hash, round_ratio
from basketry.operators.features import PAIR, user_product_features
from basketry.schema import DOW_FLAGS, FEATURES, IDENTIFIERS, TARGET
from basketry.session import dealt, stage


def train_order_context(cleaned: DataFrame) -> DataFrame:
    """What is known about the order to predict: one row per train order."""
    return cleaned.filter(F.col("eval_set") == "train").select(
        F.col("order_id").alias("train_order_id"),
        "user_id",
        F.col("order_number").alias("train_order_number"),
        F.col("order_hour_of_day").alias("train_order_hour"),
        F.col("days_since_prior_order").alias("train_days_since_prior"),
        F.col("order_dow_raw").alias("train_order_dow"),
        F.col("is_weekend").alias("train_is_weekend"),
        *[F.col(flag).alias(f"train_{flag}") for flag in DOW_FLAGS],
    )


def train_items(train_orders: DataFrame, order_products: DataFrame) -> DataFrame:
    """Products in the order to predict."""
    placed = dealt(train_orders.select("train_order_id", "user_id"), order_products.count(), "train_order_id")
    return order_products.select(F.col("order_id").alias("train_order_id"), "product_id").join(
        placed, "train_order_id"
    ).select("user_id", "product_id", "train_order_id")


def candidate_pairs(pairs: DataFrame, train_orders: DataFrame, count: int = 0) -> DataFrame:
    """Pairs of users who have a train order: only what a user bought before
    can be reordered, so no user x product grid is ever built.  ``count``: pairs, about."""
    users = dealt(train_orders.select("user_id"), count, "user_id")
    return user_product_features(pairs).join(users, "user_id", "left_semi")


def derived_ratios() -> dict:
    """Ratios taken at read time from the stored layers."""
    return {
        "user_product_recency_ratio": round_ratio(
            F.col("user_product_last_buy_number"), F.col("user_product_total_buys"), 4
        ),
        "user_avg_basket_size": round_ratio(F.col("user_total_items_bought"), F.col("user_total_orders"), 4),
    }


def training_matrix(
    cleaned: DataFrame,
    order_products: DataFrame,
    pairs: DataFrame,
    users: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Identifiers, label and features for each candidate pair.

    The label says that the product is in the train order, whatever its
    ``reordered`` flag.  The inner join with the train orders also restricts the
    candidates to users who have one, so no separate semi join is run; train
    context and user features meet first, on one row per user, and reach the
    pairs in a single join.
    """
    count = pairs.count()
    train_orders = train_order_context(cleaned)
    bought = train_items(train_orders, order_products).select(*PAIR, F.lit(1).alias("_hit"))
    user_side = train_orders.join(users, "user_id", "left")
    labelled = dealt(user_product_features(pairs), count, *PAIR).join(bought, PAIR, "left")
    matrix = (
        dealt(labelled, count, "user_id")
        .join(user_side, "user_id")
        .join(products, "product_id", "left")
        .withColumns({TARGET: F.when(F.col("_hit").isNotNull(), 1).otherwise(0), **derived_ratios()})
    )
    return matrix.select(*IDENTIFIERS, TARGET, *FEATURES)


def model_frame(matrix: DataFrame) -> DataFrame:
    """The matrix as the model sees it: doubles, missing features as 0."""
    return matrix.select(
        *IDENTIFIERS,
        F.col(TARGET).cast("int").alias(TARGET),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES],
    )


def sample_users(matrix: DataFrame, one_in: int | None = None) -> DataFrame:
    """Rows of every ``one_in``-th user id; all rows by default."""
    if one_in is None:
        return matrix
    return matrix.filter(F.pmod(F.col("user_id"), F.lit(one_in)) == 0)


def with_split(matrix: DataFrame, test_share: float, validation_share: float, seed: int) -> DataFrame:
    """Put each user wholly on one side: ``test``, ``validation`` or ``train``,
    by a hash of the user id; a column expression, no shuffle."""
    bucket = bucket_1000(F.col("user_id"), seed)
    test_end = round(test_share * 1000)
    validation_end = test_end + round(validation_share * 1000)
    side = F.when(bucket < test_end, "test").when(bucket < validation_end, "validation").otherwise("train")
    return matrix.withColumn("split", side)


SPLIT_BITS, HASH_BITS = 10, 60


def split_point(hashes: DataFrame, k: int) -> int:
    """The k-th smallest number of column ``h`` (below 2**60), counted from 1.

    Counts per range of hashes find the range that holds it; that one is divided
    again, 1024 ranges a step.  Nothing is sorted, and 1024 counts at most reach
    the driver, whatever the number of rows.
    """
    low, shift = 0, HASH_BITS
    while shift:
        shift -= SPLIT_BITS
        place = F.shiftrightunsigned(F.col("h"), shift)
        inside = hashes.filter(F.shiftrightunsigned(F.col("h"), shift + SPLIT_BITS) == low)
        for r in inside.groupBy(place.alias("place")).agg(F.count("*").alias("n")).orderBy("place").collect():
            low = r.place
            if r.n >= k:
                break
            k -= r.n
    return low


def with_exact_split(matrix: DataFrame, test_share: float, validation_share: float, seed: int) -> DataFrame:
    """Put each user wholly on one side, with exact shares: of ``n`` users the
    ``ceil(test_share * n)`` with the smallest hashes are ``test``, the next
    ``ceil(validation_share * n)`` are ``validation``, the others ``train``.

    Two users with one 60-bit hash stay together.  Rows without a user are ``train``.
    """
    users = matrix.select("user_id").filter("user_id IS NOT NULL").distinct()
    hashes = stage(users.select(portable_hash(seed, "user_id").alias("h")), "split")
    n = hashes.count()
    test = math.ceil(round(test_share * n, 6))
    validation = min(n, test + math.ceil(round(validation_share * n, 6)))
    ends = [split_point(hashes, k) if k else -1 for k in (test, validation)]
    h = F.when(F.col("user_id").isNotNull(), portable_hash(seed, "user_id"))
    side = F.when(h <= ends[0], "test").when(h <= ends[1], "validation").otherwise("train")
    return matrix.withColumn("split", side)
