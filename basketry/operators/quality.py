"""Checks as queries: (check_name, violations) rows or one row of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.numeric import percent_of
from basketry.schema import BASE_TABLES, DOW_FLAGS, EVAL_SETS, FOREIGN_KEYS, PRIMARY_KEYS, TEXT_LIMITS

Tables = dict[str, DataFrame]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _tall(table: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Several conditional counts in one scan, one row per check."""
    wide = table.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(counts.values())])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*rows)))


def row_counts(tables: Tables) -> DataFrame:
    return _stack([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]).orderBy("table_name")


def not_null_violations(tables: Tables) -> DataFrame:
    frames = []
    for name, schema in BASE_TABLES.items():
        required = [f.name for f in schema if not f.nullable]
        frames.append(_tall(tables[name], {f"{name}.{c}": F.col(c).isNull() for c in required}))
    return _stack(frames)


def duplicate_keys(df: DataFrame, keys: list[str], check_name: str) -> DataFrame:
    """Number of key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(check_name).alias("check_name"), "violations"
    )


def primary_key_violations(tables: Tables) -> DataFrame:
    return _stack([duplicate_keys(tables[t], keys, f"pk_{t}") for t, keys in PRIMARY_KEYS.items()])


def feature_key_violations(history: DataFrame, pairs: DataFrame) -> DataFrame:
    """Uniqueness the streak and the matrix rest on."""
    return _stack([
        duplicate_keys(history, ["user_id", "product_id", "order_number"], "user_product_order_number"),
        duplicate_keys(pairs, ["user_id", "product_id"], "user_product"),
    ])


def domain_violations(tables: Tables) -> DataFrame:
    """Values outside their declared range; a null is left to the null check."""
    orders = _tall(tables["orders"], {
        "orders.order_number": F.col("order_number") < 1,
        "orders.order_dow": ~F.col("order_dow").between(0, 6),
        "orders.order_hour_of_day": ~F.col("order_hour_of_day").between(0, 23),
        "orders.eval_set": ~F.col("eval_set").isin(*EVAL_SETS),
    })
    items = _tall(tables["order_products"], {
        "order_products.add_to_cart_order": F.col("add_to_cart_order") < 1,
        "order_products.reordered": ~F.col("reordered").isin(0, 1),
    })
    texts = [
        _tall(tables[t], {f"{t}.{c}": F.length(c) > limit}) for (t, c), limit in TEXT_LIMITS.items()
    ]
    return _stack([orders, items, *texts])


def foreign_key_violations(tables: Tables) -> DataFrame:
    """Child rows without a parent.  Children are counted per key first, so a
    hot key crosses the shuffle as one row."""
    frames = []
    for child, column, parent, key in FOREIGN_KEYS:
        per_key = (
            tables[child]
            .filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("_key"))
            .agg(F.count("*").alias("n"))
        )
        orphans = per_key.join(tables[parent].select(F.col(key).alias("_key")), "_key", "left_anti")
        frames.append(
            orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
                F.lit(f"{child}.{column}").alias("check_name"), "violations"
            )
        )
    return _stack(frames)


def null_gap_count(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.count_if(F.col("days_since_prior_order").isNull()).alias("null_count"))


def wrong_flag_count(cleaned: DataFrame) -> DataFrame:
    flags = reduce(Column.__add__, [F.col(flag) for flag in DOW_FLAGS])
    return cleaned.filter(flags != 1).agg(F.count("*").alias("rows_with_wrong_ohe"))


def share_by(df: DataFrame, column: str, count_name: str) -> DataFrame:
    """Rows per value and their percentage.  The total is a window over the
    grouped result: two rows for a 0/1 column."""
    counts = df.groupBy(column).agg(F.count("*").alias(count_name))
    total = F.sum(count_name).over(Window.partitionBy())
    return counts.withColumn("pct_of_total", percent_of(F.col(count_name), total)).orderBy(column)


def matrix_null_audit(matrix: DataFrame) -> DataFrame:
    # Names of the counts and the columns they watch.
    audited = {
        "null_total_buys": "user_product_total_buys",
        "null_up_reorder_rate": "user_product_reorder_rate",
        "null_streak": "user_product_order_streak",
        "null_user_orders": "user_total_orders",
        "null_avg_days": "user_avg_days_between_orders",
        "null_prod_purchases": "product_total_purchases",
        "null_prod_reorder_rate": "product_reorder_rate",
        "null_train_days": "train_days_since_prior",
    }
    return matrix.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in audited.items()])


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column in one scan, one row per column."""
    wide = _tall(df, {c: F.col(c).isNull() for c in columns})
    return wide.select(F.col("check_name").alias("feature"), F.col("violations").alias("null_count"))


def pair_uniqueness(matrix: DataFrame) -> DataFrame:
    """Rows against distinct pairs.  A pair counts as one value, so a pair with
    a null part is counted too.  The rows are reduced to pairs first."""
    per_pair = matrix.groupBy("user_id", "product_id").agg(F.count("*").alias("n"))
    return per_pair.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("unique_user_product_pairs"),
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("product_id").alias("unique_products"),
    )


def range_audit(matrix: DataFrame) -> DataFrame:
    """Values outside their range.  A streak of 0 is valid here (the last
    purchase is a break) and shows as bad, as the rule is stated."""

    def outside(column: str) -> Column:
        return F.count_if(~F.col(column).between(0, 1))

    return matrix.agg(
        outside("user_product_reorder_rate").alias("bad_up_reorder_rate"),
        outside("product_reorder_rate").alias("bad_prod_reorder_rate"),
        F.count_if(F.col("user_product_order_streak") < 1).alias("bad_streak"),
        outside("user_product_recency_ratio").alias("bad_recency_ratio"),
    )


def layer_difference(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that appear or vanish between two builds of a layer: rows of both
    are counted per value with a sign, and values that do not cancel remain."""
    signed = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    left = signed.groupBy(*before.columns).agg(F.sum("_n").alias("_n"))
    return left.agg(
        F.coalesce(F.sum(F.greatest(F.col("_n"), F.lit(0))), F.lit(0)).alias("added_rows"),
        F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0)).alias("removed_rows"),
    ).select(F.lit(name).alias("layer"), "added_rows", "removed_rows")
