"""Adding orders, and deleting orders and products without leaving line items behind."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.schema import BASE_TABLES
from basketry.sources.store import FeatureStore, Snapshot


def purge_orders(orders: DataFrame, order_products: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the given orders; their line items go with them."""
    doomed = ids.select("order_id")
    return (
        orders.join(doomed, "order_id", "left_anti"),
        order_products.join(doomed, "order_id", "left_anti"),
    )


def deletable_products(ids: DataFrame, order_products: DataFrame) -> DataFrame:
    """Those of the given products that no order holds.  Sold products are
    reduced to one row each before the join."""
    sold = order_products.groupBy("product_id").agg(F.count("*").alias("_sold"))
    return ids.select("product_id").join(sold, "product_id", "left_anti")


def extend_orders(
    store: FeatureStore,
    orders: DataFrame,
    items: DataFrame,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> Snapshot:
    """Publish base tables with new orders and their items, in one commit.

    Orders that were to be predicted until now, of users with a new order, become
    prior ones, so the orders are rewritten.  Items are added as files of their
    own.  ``check`` sees all base tables before the switch and may refuse it.
    """
    base = store.snapshot()
    known, kept = base.read("orders"), base.version("order_products")
    again = orders.select("user_id").distinct().withColumn("_again", F.lit(True))
    passed = F.when(F.col("_again"), F.lit("prior")).otherwise(F.col("eval_set"))
    old = known.join(again, "user_id", "left").withColumn("eval_set", passed).select(*known.columns)
    layout = {}
    if base.version("orders").buckets:
        count, by = base.version("orders").buckets
        layout = {"bucket_by": list(by), "buckets": count}
    drafts = [
        store.write_version("orders", old.unionByName(orders.select(*known.columns)), **layout),
        store.write_version("order_products", items.select(*kept.kind.names), keep=kept.parts),
    ]
    if check:
        check({t: base.read(t) for t in BASE_TABLES} | {d.layer: d.read() for d in drafts})
    return store.commit(*drafts, base=base, reads=["products"])
