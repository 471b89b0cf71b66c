"""User, product and user-product layers over prior orders only.

Nothing here reads an order of another evaluation set, so the order to be
predicted never reaches a feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import round_ratio
from basketry.operators.sequence import number_rows, position_slice

PAIR = ["user_id", "product_id"]
# Folders a published user-keyed layer is spread over, unless told otherwise.
USER_FOLDERS = 256
PAIR_FEATURES = [
    "user_product_total_buys",
    "user_product_reorder_rate",
    "user_product_order_streak",
    "user_product_first_buy_number",
    "user_product_last_buy_number",
]


def folder_column(folders: int) -> str:
    """The name says how many folders there are, so a reader can compute a
    user's folder from the layer alone."""
    return f"user_mod_{folders}"


def with_user_folder(df: DataFrame, column: str) -> DataFrame:
    """Add the folder of a user; the same for a 32-bit and a 64-bit id."""
    folders = int(column.rsplit("_", 1)[1])
    folder = F.pmod(F.xxhash64(F.col("user_id").cast("bigint")), F.lit(folders))
    return df.withColumn(column, folder.cast("int"))


def prior_items(order_products: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Line items of prior orders with their user and order number."""
    prior = cleaned.filter(F.col("eval_set") == "prior").select("order_id", "user_id", "order_number")
    return order_products.select("order_id", "product_id", "reordered").join(prior, "order_id")


def purchase_history(items: DataFrame, count: int = 0) -> DataFrame:
    """Each purchase with its place among the user's purchases of the product
    and the order number of the purchase before.  ``count``: rows, about."""
    numbered = number_rows(
        items.select("user_id", "product_id", "order_id", "reordered", "order_number"),
        PAIR,
        ["order_number", "order_id"],
        "buy_sequence",
        {"prev_order_number_for_product": "order_number"},
        position_slice(items, "order_number"),
        count,
    )
    return numbered.select(
        "user_id",
        "product_id",
        "order_id",
        "reordered",
        "buy_sequence",
        "order_number",
        "prev_order_number_for_product",
    )


def pair_summary(history: DataFrame) -> DataFrame:
    """One row per user and product.

    A purchase that skips one or more of the user's orders is a break.  The
    streak counts the purchases *after* the last break, so it is total buys less
    the place of that break (0 when the break is the last purchase); the run
    length also counts the break itself.  One aggregation on the keys the
    history is already partitioned by: no join back to a last-break table.
    """
    is_break = F.col("order_number") - F.col("prev_order_number_for_product") > 1
    sums = history.groupBy(*PAIR).agg(
        F.count("*").alias("user_product_total_buys"),
        F.sum(F.col("reordered").cast("bigint")).alias("reordered_buys"),
        F.count("reordered").alias("flagged_buys"),
        F.max(F.when(is_break, F.col("buy_sequence"))).alias("_last_break"),
        F.min("buy_sequence").alias("user_product_first_buy_number"),
        F.max("buy_sequence").alias("user_product_last_buy_number"),
        F.max("order_number").alias("last_order_number"),
        F.min("order_number").alias("first_order_number"),
    )
    streak = F.col("user_product_total_buys") - F.coalesce("_last_break", F.lit(0))
    return sums.select(
        *PAIR,
        "user_product_total_buys",
        round_ratio(F.col("reordered_buys"), F.col("flagged_buys"), 6).alias("user_product_reorder_rate"),
        streak.alias("user_product_order_streak"),
        "user_product_first_buy_number",
        "user_product_last_buy_number",
        (streak + F.when(F.col("_last_break").isNull(), 0).otherwise(1)).alias("user_product_run_length"),
        "last_order_number",
        "first_order_number",
        "reordered_buys",
        "flagged_buys",
    )


def merge_pairs(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Two pair summaries as one, where a user's orders in ``later`` all come after
    those in ``earlier``.

    Counts add up.  The last break is the one inside the later part, else the
    step between the parts if it skips an order, else the one in the earlier
    part; streak and run length of each part tell where its last break is.
    """
    total, streak, run = "user_product_total_buys", "user_product_order_streak", "user_product_run_length"
    a, b = earlier.alias("a"), later.alias("b")

    def last_break(side: str):
        return F.when(F.col(f"{side}.{run}") > F.col(f"{side}.{streak}"), F.col(f"{side}.{total}") - F.col(f"{side}.{streak}"))

    before = F.coalesce(f"a.{total}", F.lit(0))
    skips = F.col("b.first_order_number") - F.col("a.last_order_number") > 1
    joined = F.coalesce(before + last_break("b"), F.when(skips, before + 1), last_break("a"))

    def added(name: str):
        return (F.coalesce(f"a.{name}", F.lit(0)) + F.coalesce(f"b.{name}", F.lit(0))).alias(name)

    sums = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in PAIR], "full").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in PAIR],
        added(total), added("reordered_buys"), added("flagged_buys"),
        joined.alias("_last_break"),
        F.coalesce("a.user_product_first_buy_number", "b.user_product_first_buy_number").alias("user_product_first_buy_number"),
        F.coalesce("b.last_order_number", "a.last_order_number").alias("last_order_number"),
        F.coalesce("a.first_order_number", "b.first_order_number").alias("first_order_number"),
    )
    after = F.col(total) - F.coalesce("_last_break", F.lit(0))
    return sums.select(
        *PAIR,
        total,
        round_ratio(F.col("reordered_buys"), F.col("flagged_buys"), 6).alias("user_product_reorder_rate"),
        after.alias(streak),
        "user_product_first_buy_number",
        F.col(total).alias("user_product_last_buy_number"),
        (after + F.when(F.col("_last_break").isNull(), 0).otherwise(1)).alias(run),
        "last_order_number",
        "first_order_number",
        "reordered_buys",
        "flagged_buys",
    )


def user_product_features(pairs: DataFrame) -> DataFrame:
    return pairs.select(*PAIR, *PAIR_FEATURES)


def recency_by_order(pairs: DataFrame, users: DataFrame) -> DataFrame:
    """How late in the user's history the product was last bought, near 0 for
    long ago.  Kept beside the layers: ``last buy / total buys`` of the matrix
    is 1 for every pair, because the last place always equals the count."""
    return pairs.join(users.select("user_id", "user_total_orders"), "user_id").select(
        *PAIR,
        "user_product_run_length",
        round_ratio(F.col("last_order_number"), F.col("user_total_orders"), 4).alias("recency_ratio_by_order"),
    )


def user_order_totals(cleaned: DataFrame) -> DataFrame:
    """Number of prior orders and mean gap; the filled gap of 0 counts."""
    tenths = (F.col("days_since_prior_order") * 10).cast("bigint")
    return (
        cleaned.filter(F.col("eval_set") == "prior")
        .groupBy("user_id")
        .agg(
            F.max("order_number").alias("user_total_orders"),
            F.sum(tenths).alias("_tenths"),
            F.count("days_since_prior_order").alias("_gaps"),
        )
        .select(
            "user_id",
            "user_total_orders",
            round_ratio(F.col("_tenths"), F.col("_gaps") * 10, 4).alias("user_avg_days_between_orders"),
        )
    )


def user_features(cleaned: DataFrame, item_counts: DataFrame) -> DataFrame:
    """Users whose prior orders hold at least one item.  Both sides are grouped
    by user, so the join adds no shuffle."""
    return user_order_totals(cleaned).join(item_counts, "user_id")


def user_item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("user_id").agg(F.count("product_id").alias("user_total_items_bought"))


def user_item_counts_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same counts from the much smaller pair summary."""
    return pairs.groupBy("user_id").agg(F.sum("user_product_total_buys").alias("user_total_items_bought"))


def product_features(items: DataFrame) -> DataFrame:
    """Purchases and reorder rate per product; partial sums absorb hot products."""
    sums = items.groupBy("product_id").agg(
        F.count("*").alias("product_total_purchases"),
        F.sum(F.col("reordered").cast("bigint")).alias("_reordered"),
        F.count("reordered").alias("_flagged"),
    )
    return sums.select(
        "product_id",
        "product_total_purchases",
        round_ratio(F.col("_reordered"), F.col("_flagged"), 6).alias("product_reorder_rate"),
    )


def product_sums_of_pairs(pairs: DataFrame) -> DataFrame:
    """Sums per product from the pair summary; they add up over parts of it."""
    return pairs.groupBy("product_id").agg(
        F.sum("user_product_total_buys").alias("product_total_purchases"),
        F.sum("reordered_buys").alias("reordered_buys"),
        F.sum("flagged_buys").alias("flagged_buys"),
    )


def product_features_of_sums(sums: DataFrame) -> DataFrame:
    return sums.select(
        "product_id",
        "product_total_purchases",
        round_ratio(F.col("reordered_buys"), F.col("flagged_buys"), 6).alias("product_reorder_rate"),
    )


def product_features_of_pairs(pairs: DataFrame) -> DataFrame:
    """The product layer from the pair summary."""
    return product_features_of_sums(product_sums_of_pairs(pairs))


def joined_layers(pairs: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Pair, product and user features side by side.  The product layer is one
    row per catalogue entry: Spark broadcasts it when its measured size allows
    and otherwise splits hot products in the shuffled join."""
    return user_product_features(pairs).join(products, "product_id").join(users, "user_id")


def top_pairs(pairs: DataFrame, users: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The most bought pairs with all their features; ties by key."""
    return (
        joined_layers(pairs, users, products)
        .orderBy(F.desc("user_product_total_buys"), "user_id", "product_id")
        .limit(n)
        .select(
            *PAIR,
            "user_total_orders",
            "user_avg_days_between_orders",
            "user_total_items_bought",
            "product_total_purchases",
            "product_reorder_rate",
            "user_product_total_buys",
            "user_product_reorder_rate",
            "user_product_order_streak",
        )
    )
