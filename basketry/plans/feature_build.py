"""From base tables to the feature layers and the training matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketry.operators import features as f
from basketry.operators.cleaning import cleaned_orders
from basketry.operators.labels import training_matrix
from basketry.session import dealt, stage
from basketry.sources.store import Draft, FeatureStore, Snapshot


@dataclass
class Layers:
    pairs: DataFrame
    users: DataFrame
    products: DataFrame


def pair_layer(orders: DataFrame, order_products: DataFrame, by_order: bool = False) -> DataFrame:
    """The user-product layer with its sums, straight from the base tables.
    ``by_order`` says that both are stored by order and join as they lie."""
    count = order_products.count()
    lines = order_products.select("order_id", "product_id", "reordered")
    items = f.prior_items(lines if by_order else dealt(lines, count, "order_id"), cleaned_orders(orders))
    return f.pair_summary(f.purchase_history(items, count))


def build_layers(orders: DataFrame, order_products: DataFrame) -> Layers:
    """All layers from one pass over the line items.

    The join of items with orders and the only window run once, for the pair
    layer; the user and product layers are sums over its rows.  Each layer is
    written: several joins read it, and from its file size Spark knows before
    the join whether it may be broadcast, instead of after a shuffle of the pairs.
    """
    pairs = stage(pair_layer(orders, order_products), "pairs")
    users = f.user_features(cleaned_orders(orders), f.user_item_counts_of_pairs(pairs))
    return Layers(pairs, stage(users, "users"), stage(f.product_features_of_pairs(pairs), "products"))


def build_matrix(orders: DataFrame, order_products: DataFrame, layers: Layers | None = None) -> DataFrame:
    layers = layers or build_layers(orders, order_products)
    return training_matrix(
        cleaned_orders(orders), order_products, layers.pairs, layers.users, layers.products
    )


SOURCES = ("orders", "order_products")
PUBLISHED = ("user_product_features", "user_features", "product_features", "product_sums")


def sources(base: Snapshot | None) -> dict[str, int]:
    """Versions of the tables that layers are built from."""
    return {t: base.number(t) for t in SOURCES} if base else {}


def user_layout(folder: str, *keys: str) -> dict:
    """Files of a layer keyed by user: folders by a hash of the user, sorted
    inside, with Bloom filters, so one user is one folder and a row group of it."""
    return {"cluster_by": [folder, *keys], "partition_by": [folder], "find_by": ["user_id"]}


def publish_layers(
    store: FeatureStore,
    orders: DataFrame,
    order_products: DataFrame,
    user_folders: int = f.USER_FOLDERS,
    base: Snapshot | None = None,
) -> Snapshot:
    """Build and publish every layer, in one commit.  The layers keyed by user are
    spread over folders by a hash of the user and sorted inside, so a small batch
    of requests opens only the folders of its users.  Sums of the products are kept
    beside their ratios: a refresh adds to them."""
    folder, made = f.folder_column(user_folders), sources(base)

    count = order_products.count()

    def written(layer: str, df: DataFrame, **layout) -> Draft:
        return store.write_version(layer, df, built_from=made, **layout)

    pairs = written(
        "user_product_features",
        f.with_user_folder(pair_layer(orders, order_products, base is not None), folder),
        rows=count,
        **user_layout(folder, *f.PAIR),
    )
    summary = pairs.read()
    users = f.user_features(cleaned_orders(orders), f.user_item_counts_of_pairs(summary))
    users = written("user_features", f.with_user_folder(users, folder), **user_layout(folder, "user_id"))
    sums = written("product_sums", f.product_sums_of_pairs(summary), cluster_by=["product_id"])
    products = written("product_features", f.product_features_of_sums(sums.read()), cluster_by=["product_id"])
    return store.commit(pairs, users, sums, products)


def published_layers(at: FeatureStore | Snapshot) -> Layers:
    """The layers of one commit.  The product layer is broadcast to its joins if
    its stored row count allows it."""
    now = at.snapshot() if isinstance(at, FeatureStore) else at
    return Layers(now.read("user_product_features"), now.read("user_features"), now.read_small("product_features"))
