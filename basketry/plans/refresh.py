"""Refreshing published layers after orders were added, user folder by user folder."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import features as f
from basketry.operators.cleaning import cleaned_orders
from basketry.plans.feature_build import PUBLISHED, SOURCES, publish_layers, sources, user_layout
from basketry.session import stage
from basketry.sources.store import Draft, FeatureStore, Part, Snapshot

ORDER = ["order_id", "user_id", "order_number", "days_since_prior_order"]


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: folders of users in all and rewritten, files of the pair
    layer read and written, and whether everything was built anew."""

    folders: int
    rewritten: int
    files_read: int = 0
    files_written: int = 0
    rebuilt: bool = False


def _prior(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("eval_set") == "prior").select(*ORDER)


def order_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Prior orders that came (``change`` 1) or went (-1); one that is different
    now does both.  Equal rows cancel in one aggregation."""
    signed = _prior(before).withColumn("change", F.lit(-1)).unionByName(_prior(after).withColumn("change", F.lit(1)))
    return signed.groupBy(*ORDER).agg(F.sum("change").alias("change")).filter("change != 0")


def touched_users(changes: DataFrame, late: DataFrame, users: DataFrame) -> DataFrame:
    """``(user_id, again)``: users with changed orders.  If all of a user's changes are
    orders after the last one known, the layers can be extended; ``again`` marks the
    others: orders that went or came earlier, or items that came late."""
    came = changes.groupBy("user_id").agg(
        F.min(F.when(F.col("change") > 0, F.col("order_number"))).alias("first_new"), F.min("change").alias("least")
    )
    known = came.join(users.select("user_id", "user_total_orders"), "user_id", "left")
    earlier = F.coalesce(F.col("first_new") <= F.col("user_total_orders"), F.lit(False))
    marked = known.select("user_id", ((F.col("least") < 0) | earlier).alias("again"))
    both = marked.unionByName(late.select("user_id", F.lit(True).alias("again")))
    return both.groupBy("user_id").agg(F.max("again").alias("again"))


def refresh_layers(store: FeatureStore) -> Refreshed:
    """Bring the published layers to the current orders and items, in one commit.

    Change set: prior orders that differ between the version of the orders that
    the layers were built from and the current one, and items in files added
    since.  Only the folders of their users are read and rewritten; all other
    files of the user-keyed layers belong to the new version as they are.  Pairs of
    a user with new orders are merged with sums over those orders alone; product
    sums change by the difference of the rewritten pairs.  The result equals a
    rebuild.  If items were rewritten, not added, the layers are built anew.
    """
    now = store.snapshot()
    built = now.version("user_product_features")
    folders = {p.folder for p in built.parts}
    if built.built_from == sources(now):
        return Refreshed(len(folders), 0)
    folder = next(c.name for c in built.kind if c.name.startswith("user_mod_"))
    old = {t: store.version(t, built.built_from[t]) for t in SOURCES}
    lines = now.version("order_products")
    if set(_names(old["order_products"].parts)) - set(_names(lines.parts)):
        made = publish_layers(store, now.read("orders"), now.read("order_products"), int(folder.rsplit("_", 1)[1]), now)
        count = len(made.version("user_product_features").parts)
        return Refreshed(count, count, rebuilt=True)

    orders = now.read("orders")
    changes = stage(order_changes(store.read_parts(old["orders"]), orders), "changes")
    came = changes.filter("change > 0")
    added_parts = tuple(p for p in lines.parts if (p.gen, p.folder) not in _names(old["order_products"].parts))
    added_items = store.read_parts(replace(lines, parts=added_parts)).select("order_id").distinct()
    late = added_items.join(_prior(orders), "order_id").join(came.select("order_id"), "order_id", "left_anti").select("user_id").distinct()
    touched = stage(touched_users(changes, late, now.read("user_features")), "touched")

    numbers = f.with_user_folder(touched, folder).select(folder).distinct().collect()  # one number per folder
    names = {f"{folder}={r[0]}" for r in numbers}
    pairs_before, users_before = (now.read_folders(x, names).drop(folder) for x in PUBLISHED[:2])
    again = touched.filter("again").select("user_id")
    fresh = came.join(touched.filter("NOT again"), "user_id", "left_semi").drop("change")
    whole = _prior(orders).join(again, "user_id", "left_semi")
    needed = fresh.unionByName(whole).select("order_id", "user_id", "order_number")
    items = now.read("order_products").select("order_id", "product_id", "reordered").join(needed, "order_id")
    later = f.pair_summary(f.purchase_history(items))
    merged = f.merge_pairs(pairs_before.join(again, "user_id", "left_anti"), later)

    def drafted(layer: str, rows: DataFrame, *keys: str) -> Draft:
        kept = [p for p in now.version(layer).parts if p.folder not in names]
        count = now.version(layer).rows - sum(p.rows for p in kept)
        return store.write_version(
            layer, f.with_user_folder(rows, folder), built_from=sources(now), keep=kept, rows=count, **user_layout(folder, *keys)
        )

    pairs = drafted("user_product_features", merged, *f.PAIR)
    pairs_after = _own(pairs, names).drop(folder)
    mine = pairs_after.join(touched, "user_id", "left_semi")
    counted = f.user_features(
        cleaned_orders(orders.join(touched, "user_id", "left_semi")), f.user_item_counts_of_pairs(mine)
    )
    others = users_before.join(touched, "user_id", "left_anti")
    users = drafted("user_features", others.unionByName(counted), "user_id")

    sums = _product_sums(now, pairs_before, pairs_after)
    sums = store.write_version("product_sums", sums, cluster_by=["product_id"], built_from=sources(now))
    products = store.write_version(
        "product_features", f.product_features_of_sums(sums.read()), cluster_by=["product_id"], built_from=sources(now)
    )
    store.commit(pairs, users, sums, products, base=now, reads=SOURCES)
    everything = folders | names
    return Refreshed(len(everything), len(names), len(pairs_before.inputFiles()), len(pairs_after.inputFiles()))


def _names(parts: tuple[Part, ...]) -> set[tuple]:
    return {(p.gen, p.folder) for p in parts}


def _own(draft: Draft, names: set[str]) -> DataFrame:
    """The parts that a draft wrote itself."""
    written = tuple(p for p in draft.version.parts if p.folder in names)
    return draft.store.read_parts(replace(draft.version, parts=written))


def _product_sums(now: Snapshot, before: DataFrame, after: DataFrame) -> DataFrame:
    """Sums per product, changed by the difference of the rewritten pairs."""
    old, new = f.product_sums_of_pairs(before), f.product_sums_of_pairs(after)
    columns = [c for c in new.columns if c != "product_id"]
    gone = old.select("product_id", *[(-F.col(c)).alias(c) for c in columns])
    sums = now.read("product_sums").unionByName(gone).unionByName(new)
    return sums.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in columns]).filter("product_total_purchases > 0")
