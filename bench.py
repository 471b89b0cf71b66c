"""Time the headline steps on one directory and print one JSON line.

Each step writes its whole result to a sink that discards it.  Base tables and
layers are written once, as a feature store does, and their writing is timed as
a step of its own.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from basketry.operators import classifier, evaluation, features, labels
from basketry.operators.cleaning import cleaned_orders
from basketry.operators.recommend import product_catalog, request_features
from basketry.plans.catalog import stand_in_scorer
from basketry.plans.feature_build import Layers, build_matrix, pair_layer
from basketry.plans.serving import Serving, model_scorer
from basketry.plans.training import VALIDATION_SHARE
from basketry.schema import SEED, TARGET, TEST_SHARE
from basketry.session import drop_scratch, local_session, stage
from basketry.sources.star import StarTables


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "basketry-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors' code paths
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    t = StarTables(spark, sf_dir)
    timed("load_orders", lambda: t.orders)
    timed("load_order_products", lambda: t.order_products)
    clean = cleaned_orders(t.orders)
    timed("cleaned_orders", lambda: consume(clean))
    prior = features.prior_items(t.order_products, clean)
    timed("prior_items", lambda: consume(prior))
    timed("purchase_history", lambda: consume(features.purchase_history(prior)))
    pairs = timed("pair_layer", lambda: stage(pair_layer(t.orders, t.order_products), "pairs"))
    users = timed(
        "user_layer",
        lambda: stage(features.user_features(clean, features.user_item_counts_of_pairs(pairs)), "users"),
    )
    products = timed("product_layer", lambda: stage(features.product_features_of_pairs(pairs), "products"))
    layers = Layers(pairs, users, products)
    matrix = timed(
        "training_matrix",
        lambda: stage(
            labels.with_split(
                labels.model_frame(build_matrix(t.orders, t.order_products, layers)), TEST_SHARE, VALIDATION_SHARE, SEED
            ),
            "matrix",
        ),
    )
    train, test = matrix.filter("split = 'train'"), matrix.filter("split = 'test'")
    weight = timed("class_balance", lambda: classifier.class_balance(train).first().scale_pos_weight)
    weighted = classifier.with_class_weight(train, weight)
    held_out = classifier.with_class_weight(matrix.filter("split = 'validation'"), weight)
    model = timed("gbt_fit", lambda: classifier.fit(weighted, held_out, classifier.GbtSettings()))
    scored = timed(
        "gbt_score", lambda: stage(classifier.score(model, test).select(TARGET, "reorder_prob"), "scored")
    )
    timed("confusion_matrix", lambda: consume(evaluation.confusion_matrix(scored)))
    auc = timed("roc_auc", lambda: evaluation.roc_auc(scored).first().auc)

    catalog = timed(
        "catalog", lambda: stage(product_catalog(t.products, t.aisles, t.departments), "catalog")
    )
    timed("request_features", lambda: consume(request_features(t.requests, pairs, users, products)))
    by_rule = Serving(layers, catalog, stand_in_scorer(1000))
    by_model = Serving(layers, catalog, model_scorer(model))
    timed("recommend_rule", lambda: consume(by_rule.recommend(t.requests)))
    timed("recommend_gbt", lambda: consume(by_model.recommend(t.requests)))
    timed("response_summary", lambda: consume(by_rule.summarize(t.requests)))

    asked = t.requests.count()
    print(json.dumps({
        "metric": "feature store build, training and serving",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "requests_per_sec": round(asked / seconds["recommend_gbt"], 1),
        "auc": round(auc, 6),
        "line_items": t.order_products.count(),
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
