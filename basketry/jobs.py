"""The phases as Spark jobs over one feature store.

    spark-submit basketry/jobs.py load   --store S --csv FOLDER
    spark-submit basketry/jobs.py build  --store S
    spark-submit basketry/jobs.py extend --store S --csv FOLDER   (orders.csv, order_products.csv of new orders)
    spark-submit basketry/jobs.py refresh --store S
    spark-submit basketry/jobs.py check  --store S
    spark-submit basketry/jobs.py train  --store S --model M
    spark-submit basketry/jobs.py serve  --store S --model M --requests R --out O
    spark-submit basketry/jobs.py stream --store S --model M --requests R --out O

Session, memory and the shared folder come from the cluster's configuration.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.operators import quality, retention  # noqa: E402
from basketry.operators.cleaning import cleaned_orders  # noqa: E402
from basketry.operators.classifier import GbtSettings  # noqa: E402
from basketry.operators.features import USER_FOLDERS, prior_items, purchase_history  # noqa: E402
from basketry.operators.recommend import product_catalog  # noqa: E402
from basketry.plans.feature_build import build_matrix, publish_layers, published_layers, sources  # noqa: E402
from basketry.plans.refresh import Refreshed, refresh_layers  # noqa: E402
from basketry.plans.serving import Serving, model_scorer  # noqa: E402
from basketry.plans.training import TrainingResult, train  # noqa: E402
from basketry.schema import BASE_TABLES, REQUEST, SEED, TARGET  # noqa: E402
from basketry.session import drop_scratch  # noqa: E402
from basketry.sources.csv_tables import load_base_tables  # noqa: E402
from basketry.sources.store import Draft, FeatureStore, Snapshot, load_model  # noqa: E402
from basketry.streaming.scoring import answer_stream, request_stream, serving_by_commit  # noqa: E402

# File names of the base tables.
CSV_FILES = {
    "aisles": "aisles.csv",
    "departments": "departments.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_products": ["order_products__prior.csv", "order_products__train.csv"],
}


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints, only the broken ones."""
    checks = quality.not_null_violations(tables)
    for more in (
        quality.primary_key_violations,
        quality.domain_violations,
        quality.foreign_key_violations,
    ):
        checks = checks.unionByName(more(tables))
    return checks.filter(F.col("violations") > 0)


# Orders and items are stored in buckets of their join key.
BUCKETED = {"orders": ["order_id"], "order_products": ["order_id"]}
BUCKETS = 200


def _written(store: FeatureStore, layer: str, df: DataFrame, buckets: int) -> Draft:
    if layer in BUCKETED:
        return store.write_version(layer, df, bucket_by=BUCKETED[layer], buckets=buckets)
    return store.write_version(layer, df)


def load(store: FeatureStore, folder: str, wide_keys: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """Publish the base tables of a CSV folder; a broken constraint stops the
    load.  The files are parsed once: checks run on the columnar copies, and a
    failed load leaves the published versions as they were for its readers.  All
    tables become current in one commit."""

    def at(names):
        return [f"{folder}/{n}" for n in names] if isinstance(names, list) else f"{folder}/{names}"

    raw = load_base_tables(store.spark, {t: at(names) for t, names in CSV_FILES.items()}, wide_keys)
    drafts = {t: _written(store, t, df, buckets) for t, df in raw.items()}
    broken = violations({t: draft.read() for t, draft in drafts.items()}).collect()
    if broken:
        raise ValueError("; ".join(f"{r.check_name}: {r.violations}" for r in broken))
    store.commit(*drafts.values())
    return quality.row_counts(base_tables(store))


def purge(store: FeatureStore, ids: DataFrame) -> None:
    """Delete orders with their line items: both tables are rewritten and become
    current together, unless one of them was changed meanwhile."""
    base = store.snapshot()
    orders, items = retention.purge_orders(base.read("orders"), base.read("order_products"), ids)
    buckets = base.version("orders").buckets[0]
    store.commit(
        _written(store, "orders", orders, buckets), _written(store, "order_products", items, buckets), base=base
    )


def delete_products(store: FeatureStore, ids: DataFrame) -> None:
    """Delete products; refused as a whole when one of them was ever sold, also
    while the deletion runs."""
    base = store.snapshot()
    listed = ids.select("product_id").distinct()
    sold = listed.exceptAll(retention.deletable_products(listed, base.read("order_products"))).count()
    if sold:
        raise ValueError(f"{sold} of the products have orders")
    left = store.write_version("products", base.read("products").join(listed, "product_id", "left_anti"))
    store.commit(left, base=base, reads=["order_products"])


def extend(store: FeatureStore, orders: DataFrame, items: DataFrame) -> None:
    """Add new orders with their items, such as a day's; a broken constraint stops it."""

    def checked(tables: dict[str, DataFrame]) -> None:
        broken = violations(tables).collect()
        if broken:
            raise ValueError("; ".join(f"{r.check_name}: {r.violations}" for r in broken))

    retention.extend_orders(store, orders, items, checked)


def checks(store: FeatureStore) -> list[DataFrame]:
    """Reports on the published tables, layers and matrix."""
    now = store.snapshot()
    tables, layers, matrix = base_tables(now), published_layers(now), now.read("training_matrix")
    clean = cleaned_orders(tables["orders"])
    history = purchase_history(prior_items(tables["order_products"], clean))
    return [
        quality.row_counts(tables),
        violations(tables),
        quality.null_gap_count(clean),
        quality.wrong_flag_count(clean),
        quality.share_by(clean, "is_weekend", "order_count"),
        quality.feature_key_violations(history, layers.pairs),
        quality.share_by(matrix, TARGET, "row_count"),
        quality.matrix_null_audit(matrix),
        quality.pair_uniqueness(matrix),
        quality.range_audit(matrix),
    ]


def base_tables(at: FeatureStore | Snapshot) -> dict[str, DataFrame]:
    now = at.snapshot() if isinstance(at, FeatureStore) else at
    return {t: now.read(t) for t in BASE_TABLES}


def build(store: FeatureStore, user_folders: int = USER_FOLDERS) -> DataFrame:
    """Publish the layers and the training matrix, all of one version of the tables."""
    base = store.snapshot()
    tables = base_tables(base)
    made = publish_layers(store, tables["orders"], tables["order_products"], user_folders, base)
    matrix = build_matrix(tables["orders"], tables["order_products"], published_layers(made))
    return store.publish("training_matrix", matrix, built_from=sources(base))


def refresh(store: FeatureStore) -> Refreshed:
    """Bring the layers up to the current tables; only folders of users with
    changed orders are rewritten."""
    return refresh_layers(store)


def fit(store: FeatureStore, model_path: str, settings: GbtSettings, one_user_in: int | None = None) -> TrainingResult:
    return train(store.read("training_matrix"), settings, one_user_in=one_user_in, model_path=model_path)


def serving_at(at: Snapshot, model, **options) -> Serving:
    """Serving from the layers and names of one commit."""
    names = product_catalog(*(at.read(t) for t in ("products", "aisles", "departments")))
    return Serving(published_layers(at), names, model_scorer(model), **options)


def open_serving(store: FeatureStore, model_path: str, **options) -> Serving:
    return serving_at(store.snapshot(), load_model(model_path), **options)


def serve(store: FeatureStore, model_path: str, requests: DataFrame, out: str) -> None:
    """Lists and summaries of a batch of requests."""
    serving = open_serving(store, model_path)
    serving.recommend(requests).write.mode("overwrite").parquet(f"{out}/recommendations")
    serving.summarize(requests).write.mode("overwrite").parquet(f"{out}/summaries")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["load", "build", "extend", "refresh", "check", "train", "serve", "stream"])
    parser.add_argument("--store", required=True)
    parser.add_argument("--csv")
    parser.add_argument("--wide-keys", action="store_true")
    parser.add_argument("--buckets", type=int, default=BUCKETS)
    parser.add_argument("--user-folders", type=int, default=USER_FOLDERS)
    parser.add_argument("--model")
    parser.add_argument("--rounds", type=int, default=GbtSettings.max_rounds)
    parser.add_argument("--one-user-in", type=int)
    parser.add_argument("--requests")
    parser.add_argument("--out")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"basketry-{args.command}").getOrCreate()
    store = FeatureStore(spark, args.store)
    if args.command == "load":
        load(store, args.csv, args.wide_keys, args.buckets).show(truncate=False)
    elif args.command == "extend":
        files = {t: f"{args.csv}/{CSV_FILES['orders']}" if t == "orders" else f"{args.csv}/order_products.csv" for t in BUCKETED}
        new = load_base_tables(spark, files, args.wide_keys)
        extend(store, new["orders"], new["order_products"])
    elif args.command == "refresh":
        print(refresh(store))
    elif args.command == "build":
        build(store, args.user_folders)
    elif args.command == "check":
        for report in checks(store):
            report.show(50, truncate=False)
    elif args.command == "train":
        result = fit(store, args.model, GbtSettings(max_rounds=args.rounds, seed=SEED), args.one_user_in)
        for table in (result.split, result.confusion, result.report, result.auc, result.importance):
            table.show(50, truncate=False)
    elif args.command == "serve":
        serve(store, args.model, spark.read.schema(REQUEST).parquet(args.requests), args.out)
    else:
        answer_stream(
            request_stream(spark, args.requests),
            serving_by_commit(store, load_model(args.model), serving_at, f"{args.out}/commits"),
            f"{args.out}/recommendations",
            f"{args.out}/checkpoint",
            summary_sink=f"{args.out}/summaries",
        ).awaitTermination()
    drop_scratch(spark)


if __name__ == "__main__":
    main()
