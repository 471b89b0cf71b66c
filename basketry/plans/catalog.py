"""Every registered query: (session, table directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators import classifier, evaluation, features, labels, quality, recommend, retention
from basketry.operators.cleaning import cleaned_orders, sample_rows
from basketry.plans.feature_build import Layers, build_layers, build_matrix, pair_layer, publish_layers
from basketry.plans.refresh import refresh_layers
from basketry.plans.serving import Serving, lookup, model_scorer
from basketry.plans.training import VALIDATION_SHARE
from basketry.plans.workspace import Workspace, open_workspace
from basketry.schema import FEATURES, IDENTIFIERS, SEED, TARGET, TEST_SHARE
from basketry.session import TASK_ROWS, dealt, scratch_path, stage, task_count
from basketry.sources import star
from basketry.sources.csv_tables import load_base_tables, load_csv, write_csv
from basketry.sources.store import FeatureStore, column_catalogue
from basketry.streaming.scoring import answer_stream, request_stream

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and 16-bit numbers as 32-bit ones, for comparing
    results across engines."""

    def plain(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.ShortType):
            return F.col(f.name).cast("int").alias(f.name)
        return F.col(f.name)

    return df.select([plain(f) for f in df.schema])


def stand_in_points() -> Column:
    """A whole-number score from stored and request-time features, in place of
    the model where a result must be the same in any engine."""
    number = {c: F.col(c).cast("bigint") for c in FEATURES}
    return (
        number["user_product_total_buys"] * 10
        + number["user_product_order_streak"] * 15
        + (number["train_order_hour"] + number["train_order_dow"] * 3) % 40
        + F.floor(F.col("product_reorder_rate") * 100)
    )


def stand_in_scorer(scale: int) -> recommend.Scorer:
    """``points / (points + scale)``: below one for any number of points, so no
    score is cut off."""
    points = stand_in_points()
    return lambda rows: rows.withColumn("reorder_prob", points / (points + F.lit(float(scale))))


_star = open_workspace


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders for queries that read them once: nothing is written."""
    return star.orders(star.read_table(spark, sf_dir, "orders"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(_orders(spark, sf_dir))


def _prior_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _star(spark, sf_dir)
    return features.prior_items(t.order_products, cleaned_orders(t.orders))


def _layers(spark: SparkSession, sf_dir: str) -> tuple[Workspace, Layers]:
    t = _star(spark, sf_dir)
    return t, t.layers


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).matrix


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_split(_matrix(spark, sf_dir), TEST_SHARE, 0.0, SEED)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test part scored by the stand-in."""
    frame = labels.with_split(labels.model_frame(_matrix(spark, sf_dir)), TEST_SHARE, 0.0, SEED)
    test = frame.filter(F.col("split") == "test")
    return stand_in_scorer(100)(test).select("user_id", "product_id", TARGET, "reorder_prob")


def _serving(spark: SparkSession, sf_dir: str) -> tuple[Workspace, Serving]:
    t, layers = _layers(spark, sf_dir)
    return t, Serving(layers, t.catalog, stand_in_scorer(1000))


# --- loading and declared constraints ---------------------------------------


def base_orders(spark, sf_dir):
    return _orders(spark, sf_dir)


def base_order_products(spark, sf_dir):
    return _star(spark, sf_dir).order_products


def product_catalog(spark, sf_dir):
    t = _star(spark, sf_dir)
    return recommend.product_catalog(t.products, t.aisles, t.departments)


def csv_orders(spark, sf_dir):
    """Orders written as CSV and loaded back with their types."""
    orders, path = _orders(spark, sf_dir), scratch_path(spark, "orders-csv")
    write_csv(orders, path)
    return load_csv(spark, orders.schema, path)


def csv_order_products(spark, sf_dir):
    """Line items written as a prior file and a file of the rest, loaded as one."""
    t = _star(spark, sf_dir)
    prior_ids = t.orders.filter(F.col("eval_set") == "prior").select("order_id")
    prior_ids = dealt(prior_ids, t.order_products.count(), "order_id")
    paths = [scratch_path(spark, "prior-csv"), scratch_path(spark, "train-csv")]
    write_csv(t.order_products.join(prior_ids, "order_id", "left_semi"), paths[0])
    write_csv(t.order_products.join(prior_ids, "order_id", "left_anti"), paths[1])
    return load_base_tables(spark, {"order_products": paths}, wide_keys=True)["order_products"]


def table_row_counts(spark, sf_dir):
    return quality.row_counts(_star(spark, sf_dir).base_tables())


def not_null_violations(spark, sf_dir):
    return quality.not_null_violations(_star(spark, sf_dir).base_tables())


def pk_violations(spark, sf_dir):
    return quality.primary_key_violations(_star(spark, sf_dir).base_tables())


def pk_violations_of_lines(spark, sf_dir):
    """The key of raw lines, which is not unique in every data set."""
    lines = star.read_table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "pk_lineitem")


def fk_violations_after_purge(spark, sf_dir):
    """Foreign keys once the orders placed at midnight are gone but not their items."""
    tables = _star(spark, sf_dir).base_tables()
    kept = tables["orders"].filter("order_hour_of_day != 0")
    return quality.foreign_key_violations({**tables, "orders": kept})


def uncleaned_null_check(spark, sf_dir):
    return quality.null_gap_count(_orders(spark, sf_dir))


def fk_violations(spark, sf_dir):
    return quality.foreign_key_violations(_star(spark, sf_dir).base_tables())


def domain_violations(spark, sf_dir):
    return quality.domain_violations(_star(spark, sf_dir).base_tables())


def feature_key_violations(spark, sf_dir):
    history = features.purchase_history(_prior_items(spark, sf_dir))
    history = stage(history, "history")
    return quality.feature_key_violations(history, features.pair_summary(history))


def purge_orders(spark, sf_dir):
    """Line items left after every user's first order is purged."""
    t = _star(spark, sf_dir)
    _, items = retention.purge_orders(t.orders, t.order_products, t.orders.filter(F.col("order_number") == 1))
    return items.select("order_id", "product_id")


def deletable_products(spark, sf_dir):
    """Products free to delete once only test orders placed at midnight remain."""
    t = _star(spark, sf_dir)
    kept = (F.col("eval_set") == "test") & (F.col("order_hour_of_day") == 0)
    _, items = retention.purge_orders(t.orders, t.order_products, t.orders.filter(~kept))
    return retention.deletable_products(t.products, items)


# --- cleaning ---------------------------------------------------------------


def cleaned(spark, sf_dir):
    return _cleaned(spark, sf_dir)


def cleaned_columns(spark, sf_dir):
    return column_catalogue(_cleaned(spark, sf_dir)).select("ordinal_position", "column_name", "null_count")


def cleaned_null_check(spark, sf_dir):
    return quality.null_gap_count(_cleaned(spark, sf_dir))


def ohe_check(spark, sf_dir):
    return quality.wrong_flag_count(_cleaned(spark, sf_dir))


def weekend_share(spark, sf_dir):
    return quality.share_by(_cleaned(spark, sf_dir), "is_weekend", "order_count")


def cleaned_sample(spark, sf_dir):
    return sample_rows(_cleaned(spark, sf_dir), ["order_id"])


# --- feature layers ---------------------------------------------------------


def prior_items(spark, sf_dir):
    return _prior_items(spark, sf_dir)


def user_features(spark, sf_dir):
    t = _star(spark, sf_dir)
    clean = cleaned_orders(t.orders)
    return features.user_features(clean, features.user_item_counts(features.prior_items(t.order_products, clean)))


def product_features(spark, sf_dir):
    return features.product_features(_prior_items(spark, sf_dir))


def user_product_history(spark, sf_dir):
    return features.purchase_history(_prior_items(spark, sf_dir))


def user_product_features(spark, sf_dir):
    t = _star(spark, sf_dir)
    return features.user_product_features(pair_layer(t.orders, t.order_products))


def streak_run(spark, sf_dir):
    _, layers = _layers(spark, sf_dir)
    return features.recency_by_order(layers.pairs, layers.users)


def feature_spot_check(spark, sf_dir):
    _, layers = _layers(spark, sf_dir)
    return features.top_pairs(layers.pairs, layers.users, layers.products)


def joined_layers(spark, sf_dir):
    _, layers = _layers(spark, sf_dir)
    return features.joined_layers(layers.pairs, layers.users, layers.products)


def leakage_guard(spark, sf_dir):
    """Rows of each layer that change when every non-prior order is dropped."""
    t, full = _layers(spark, sf_dir)
    prior = t.orders.filter(F.col("eval_set") == "prior")
    bare = build_layers(prior, t.order_products)
    frames = [
        quality.layer_difference("user_product_features", full.pairs, bare.pairs),
        quality.layer_difference("user_features", full.users, bare.users),
        quality.layer_difference("product_features", full.products, bare.products),
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def published_layers(spark, sf_dir):
    """The product layer read from a store after a publish and a refresh."""
    t = _star(spark, sf_dir)
    store = FeatureStore(spark, scratch_path(spark, "store"))
    made = publish_layers(store, t.orders, t.order_products, user_folders=16)
    store.refresh(
        "product_features",
        lambda: features.product_features_of_pairs(made.read("user_product_features")),
        cluster_by=["product_id"],
    )
    version = store.current_version("product_features")
    return store.read("product_features").withColumn("version", F.lit(version))


def layer_statistics(spark, sf_dir):
    """Row counts and column statistics as stored with the published layers."""
    t = _star(spark, sf_dir)
    store = FeatureStore(spark, scratch_path(spark, "store"))
    made = publish_layers(store, t.orders, t.order_products, user_folders=16)
    stored = made.statistics("user_product_features", "user_features", "product_features")
    return stored.filter("column_name NOT LIKE 'user_mod%'")


def lookup_user(spark, sf_dir):
    """Published features of the user with the smallest id."""
    t, layers = _layers(spark, sf_dir)
    store = FeatureStore(spark, scratch_path(spark, "store"))
    made = publish_layers(store, t.orders, t.order_products)
    user_id = layers.users.agg(F.min("user_id")).first()[0]
    return lookup(made, user_id)


def refreshed_layers(spark, sf_dir):
    """The pair layer after a refresh.  It is first built without the last order of
    every user who placed it at midnight; then those orders come."""
    t = _star(spark, sf_dir)
    last = F.col("eval_set") != "prior"
    late = t.orders.filter(last & (F.col("order_hour_of_day") == 0))
    ends = late.select("user_id", F.col("order_number").alias("_last"), F.col("eval_set").alias("_side"))
    known = t.orders.join(ends, "user_id", "left").filter("_last IS NULL OR order_number < _last")
    before = F.when(F.col("order_number") == F.col("_last") - 1, F.col("_side")).otherwise(F.col("eval_set"))
    known = known.withColumn("eval_set", before).select(*t.orders.columns)
    new_items = t.order_products.join(late, "order_id", "left_semi")
    count = t.order_products.count()
    buckets = task_count(spark, count) if count > TASK_ROWS else 8
    store = FeatureStore(spark, scratch_path(spark, "store"))
    tables = {**t.base_tables(), "orders": known, "order_products": t.order_products.join(late, "order_id", "left_anti")}
    base = store.commit(*[
        store.write_version(name, df, **({"bucket_by": ["order_id"], "buckets": buckets} if "order_id" in df.columns else {}))
        for name, df in tables.items()
    ])
    publish_layers(store, base.read("orders"), base.read("order_products"), 64, base)
    retention.extend_orders(store, late, new_items)
    refresh_layers(store)
    return features.user_product_features(store.read("user_product_features"))


# --- labels and matrix ------------------------------------------------------


def train_order_context(spark, sf_dir):
    return labels.train_order_context(_cleaned(spark, sf_dir))


def train_items(spark, sf_dir):
    t = _star(spark, sf_dir)
    return labels.train_items(labels.train_order_context(cleaned_orders(t.orders)), t.order_products)


def candidate_pairs(spark, sf_dir):
    t = _star(spark, sf_dir)
    context = labels.train_order_context(cleaned_orders(t.orders))
    return labels.candidate_pairs(pair_layer(t.orders, t.order_products), context, t.order_products.count())


def training_matrix(spark, sf_dir):
    t, layers = _layers(spark, sf_dir)
    return build_matrix(t.orders, t.order_products, layers)


def model_frame(spark, sf_dir):
    return labels.model_frame(_matrix(spark, sf_dir))


def matrix_sample(spark, sf_dir):
    return _matrix(spark, sf_dir).orderBy(*IDENTIFIERS).limit(10)


def sampled_users(spark, sf_dir):
    """The matrix of every fourth user, the sample that training can be given."""
    return labels.sample_users(_matrix(spark, sf_dir), 4)


def label_distribution(spark, sf_dir):
    return quality.share_by(_matrix(spark, sf_dir), TARGET, "row_count")


def matrix_null_audit(spark, sf_dir):
    return quality.matrix_null_audit(_matrix(spark, sf_dir))


def matrix_pair_uniqueness(spark, sf_dir):
    return quality.pair_uniqueness(_matrix(spark, sf_dir))


def matrix_range_audit(spark, sf_dir):
    return quality.range_audit(_matrix(spark, sf_dir))


def feature_null_counts(spark, sf_dir):
    return quality.null_counts(_matrix(spark, sf_dir), FEATURES)


# --- split and evaluation ---------------------------------------------------


def group_split(spark, sf_dir):
    return evaluation.split_report(_split(spark, sf_dir))


def split_overlap(spark, sf_dir):
    return evaluation.split_overlap(_split(spark, sf_dir))


def split_shared_users(spark, sf_dir):
    split = stage(_split(spark, sf_dir).select("user_id", "split"), "split")
    both = evaluation.shared_users(split.filter("split = 'train'"), split.filter("split = 'test'"))
    return both.agg(F.count("*").alias("shared_users"))


def class_balance(spark, sf_dir):
    return classifier.class_balance(_matrix(spark, sf_dir))


def train_class_weight(spark, sf_dir):
    return classifier.class_balance(_split(spark, sf_dir).filter("split = 'train'"))


def user_split(spark, sf_dir):
    """The side of every user with candidates, as training assigns it."""
    matrix = labels.with_split(_matrix(spark, sf_dir), TEST_SHARE, VALIDATION_SHARE, SEED)
    return matrix.select("user_id", "split").distinct()


def exact_user_split(spark, sf_dir):
    """The side of every user with candidates, with exact shares of users."""
    matrix = labels.with_exact_split(_matrix(spark, sf_dir), TEST_SHARE, VALIDATION_SHARE, SEED)
    return matrix.select("user_id", "split").distinct()


def predictions(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.withColumn("predicted", evaluation.predicted_class(F.col("reorder_prob")))


def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(_scored(spark, sf_dir))


def classification_report(spark, sf_dir):
    return evaluation.classification_report(evaluation.confusion_matrix(_scored(spark, sf_dir)))


def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_scored(spark, sf_dir))


def score_cumulative_share(spark, sf_dir):
    """The importance report over a countable stand-in for gain: candidates of
    the positive class whose feature is above zero."""
    matrix = labels.model_frame(_matrix(spark, sf_dir))
    hits = matrix.agg(*[F.count_if((F.col(TARGET) == 1) & (F.col(c) > 0)).alias(c) for c in FEATURES])
    gains = hits.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("gain")) for c in FEATURES
            ])
        )
    )
    return classifier.importance_report(gains)


def gbt_evaluation(spark, sf_dir):
    result = _star(spark, sf_dir).trained
    auc = result.auc.first()
    return result.report.withColumns({"auc": F.lit(auc.auc), "tier": F.lit(auc.tier)})


def gbt_importance(spark, sf_dir):
    return _star(spark, sf_dir).trained.importance


def gbt_recommend(spark, sf_dir):
    t, layers = _layers(spark, sf_dir)
    return Serving(layers, t.catalog, model_scorer(t.trained.model)).recommend(t.requests)


# --- serving ----------------------------------------------------------------


def serving_requests(spark, sf_dir):
    return star.requests(star.read_table(spark, sf_dir, "events"))


def stored_features(spark, sf_dir):
    t, layers = _layers(spark, sf_dir)
    return recommend.stored_features(t.requests, layers.pairs, layers.users, layers.products)


def request_labels(spark, sf_dir):
    return recommend.request_labels(star.requests(star.read_table(spark, sf_dir, "events")))


def request_features(spark, sf_dir):
    t, layers = _layers(spark, sf_dir)
    return recommend.request_features(t.requests, layers.pairs, layers.users, layers.products)


def recommend_topn(spark, sf_dir):
    t, serving = _serving(spark, sf_dir)
    return serving.recommend(t.requests)


def response_summary(spark, sf_dir):
    t, serving = _serving(spark, sf_dir)
    return serving.summarize(t.requests)


def cross_user_summary(spark, sf_dir):
    t, serving = _serving(spark, sf_dir)
    rows = recommend.response_comparison(serving.summarize(t.requests), serving.recommend(t.requests))
    return rows.withColumn("avg_prob", F.round("avg_prob", 6)).withColumn("avg_streak", F.round("avg_streak", 6))


def stream_recommend(spark, sf_dir):
    """All requests arriving as files of a stream, answered batch by batch."""
    t, serving = _serving(spark, sf_dir)
    incoming, sink = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    t.requests.repartition(4).write.parquet(incoming)
    query = answer_stream(
        request_stream(spark, incoming, files_per_trigger=2),
        serving,
        sink,
        scratch_path(spark, "stream"),
        available_now=True,
    )
    query.awaitTermination()
    return spark.read.parquet(sink).drop("batch")


_RAW: dict[str, Query] = {
    "base_orders": base_orders,
    "base_order_products": base_order_products,
    "product_catalog": product_catalog,
    "csv_orders": csv_orders,
    "csv_order_products": csv_order_products,
    "table_row_counts": table_row_counts,
    "not_null_violations": not_null_violations,
    "pk_violations": pk_violations,
    "fk_violations": fk_violations,
    "fk_violations_after_purge": fk_violations_after_purge,
    "pk_violations_of_lines": pk_violations_of_lines,
    "uncleaned_null_check": uncleaned_null_check,
    "domain_violations": domain_violations,
    "feature_key_violations": feature_key_violations,
    "purge_orders": purge_orders,
    "deletable_products": deletable_products,
    "cleaned_orders": cleaned,
    "cleaned_columns": cleaned_columns,
    "cleaned_null_check": cleaned_null_check,
    "ohe_check": ohe_check,
    "weekend_share": weekend_share,
    "cleaned_sample": cleaned_sample,
    "prior_items": prior_items,
    "user_features": user_features,
    "product_features": product_features,
    "user_product_history": user_product_history,
    "user_product_features": user_product_features,
    "streak_run": streak_run,
    "joined_layers": joined_layers,
    "feature_spot_check": feature_spot_check,
    "leakage_guard": leakage_guard,
    "published_layers": published_layers,
    "layer_statistics": layer_statistics,
    "lookup_user": lookup_user,
    "refreshed_layers": refreshed_layers,
    "train_order_context": train_order_context,
    "train_items": train_items,
    "candidate_pairs": candidate_pairs,
    "training_matrix": training_matrix,
    "model_frame": model_frame,
    "matrix_sample": matrix_sample,
    "sampled_users": sampled_users,
    "label_distribution": label_distribution,
    "matrix_null_audit": matrix_null_audit,
    "matrix_pair_uniqueness": matrix_pair_uniqueness,
    "matrix_range_audit": matrix_range_audit,
    "feature_null_counts": feature_null_counts,
    "group_split": group_split,
    "split_overlap": split_overlap,
    "split_shared_users": split_shared_users,
    "class_balance": class_balance,
    "train_class_weight": train_class_weight,
    "user_split": user_split,
    "exact_user_split": exact_user_split,
    "predictions": predictions,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "score_cumulative_share": score_cumulative_share,
    "gbt_evaluation": gbt_evaluation,
    "gbt_importance": gbt_importance,
    "gbt_recommend": gbt_recommend,
    "serving_requests": serving_requests,
    "stored_features": stored_features,
    "request_labels": request_labels,
    "request_features": request_features,
    "recommend_topn": recommend_topn,
    "response_summary": response_summary,
    "cross_user_summary": cross_user_summary,
    "stream_recommend": stream_recommend,
}


def _published(query: Query) -> Query:
    return lambda spark, sf_dir: _plain(query(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _published(query) for name, query in _RAW.items()}
