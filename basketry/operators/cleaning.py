"""Cleaned orders: gaps filled, day of week one-hot encoded, weekend flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.calendar import dow_flags, is_weekend
from basketry.functions.numeric import portable_hash
from basketry.schema import GAP


def cleaned_orders(orders: DataFrame) -> DataFrame:
    """A null gap marks a first order and becomes 0.0; type and row count stay."""
    dow = F.col("order_dow")
    return orders.select(
        "order_id",
        "user_id",
        "eval_set",
        "order_number",
        "order_hour_of_day",
        F.coalesce("days_since_prior_order", F.lit(0).cast(GAP)).alias("days_since_prior_order"),
        *dow_flags(dow),
        is_weekend(dow).alias("is_weekend"),
        dow.alias("order_dow_raw"),
    )


def sample_rows(df: DataFrame, keys: list[str], n: int = 10, seed: int = 42) -> DataFrame:
    """``n`` rows at random, the same ones for any layout of the rows: those with
    the smallest hash of their key.  Each task keeps its best ``n``, and these are
    merged; there is no full sort."""
    return df.orderBy(portable_hash(seed, *keys), *keys).limit(n)
