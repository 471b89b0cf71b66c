"""Scoring requests and ranking each request's products."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.calendar import day_kind, day_name, dow_flags, is_weekend
from basketry.operators.features import joined_layers, user_product_features, with_user_folder
from basketry.operators.labels import derived_ratios
from basketry.schema import FEATURES, MIN_PROBABILITY, RECOMMENDATION
from basketry.session import dealt

# A scorer adds the column reorder_prob to rows that carry FEATURES as doubles.
Scorer = Callable[[DataFrame], DataFrame]

CONTEXT = ["user_id", "current_hour", "current_dow", "days_since_last_order"]
STORED = [c for c in FEATURES if not c.startswith("train_")]
# Contexts of one user that are scored in one group; a busier user is spread.
CONTEXTS_PER_SLICE = 256


def request_contexts(requests: DataFrame) -> DataFrame:
    """Requests that ask the same thing, once, with the longest list wanted.
    A user who repeats a request adds one row here, however often."""
    return requests.groupBy(*CONTEXT).agg(F.max("top_n").alias("top_n"))


def _asked_folders(asking: DataFrame, *layers: DataFrame) -> list[DataFrame]:
    """Published layers cut down to the folders of the asking users, named when
    the plan is made; other layers as they are.  One small number per folder,
    at most, reaches the driver."""
    cut = []
    for layer in layers:
        column = next((c for c in layer.columns if c.startswith("user_mod_")), None)
        if column:
            found = with_user_folder(asking.select("user_id"), column).select(column).distinct().collect()
            layer = layer.filter(F.col(column).isin(sorted(r[0] for r in found if r[0] is not None))).drop(column)
        cut.append(layer)
    return cut


def stored_features(
    asking: DataFrame, pairs: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """Stored features of the asking users' pairs, with the ratios taken at read
    time.  Pairs of other users are dropped before any feature joins them."""
    pairs, users = _asked_folders(asking, pairs, users)
    ids = asking.select("user_id").distinct()
    mine = joined_layers(pairs.join(ids, "user_id", "left_semi"), users, products)
    return mine.withColumns(derived_ratios()).select("user_id", "product_id", *STORED)


def lookup_user(pairs: DataFrame, users: DataFrame, products: DataFrame, user_id: int) -> DataFrame:
    """Features of one user, most bought first.  The filter reaches the scans;
    on published layers one folder is opened and other row groups are skipped."""
    pairs, users = _asked_folders(pairs.sparkSession.range(1).select(F.lit(user_id).alias("user_id")), pairs, users)
    own = F.col("user_id") == user_id
    mine = joined_layers(pairs.filter(own), users.filter(own), products).withColumns(derived_ratios())
    return mine.select("product_id", *STORED).orderBy(F.desc("user_product_total_buys"), "product_id")


def context_features(
    contexts: DataFrame, pairs: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per context and product the user bought before.

    Pairs meet the asking users before anything multiplies.  A user
    with many contexts is spread over slices: their pairs are repeated per
    slice, everyone else's stay single, and the join key is (user, slice).
    Tasks follow the rows to be made, from the mean number of pairs a user has.
    A ``request_id`` beside the context is carried along.
    """
    pairs, users = _asked_folders(contexts, pairs, users)
    named = [c for c in contexts.columns if c == "request_id"]
    asked, known, held = contexts.count(), max(1, users.count()), pairs.count()
    made, met = held * asked // known, min(held, held * asked // known)
    asking = contexts.groupBy("user_id").agg(
        F.ceil(F.count("*") / CONTEXTS_PER_SLICE).cast("int").alias("_slices")
    )
    context_hash = F.xxhash64("current_hour", "current_dow", "days_since_last_order", *named)
    spread = contexts.join(asking, "user_id").withColumn("_slice", F.pmod(context_hash, F.col("_slices")).cast("int"))
    candidates = (
        dealt(user_product_features(pairs), met, "user_id")
        .join(users.join(asking, "user_id"), "user_id")
        .join(products, "product_id")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_slices")
    )
    joined = dealt(candidates, made, "user_id", "_slice").join(spread.drop("_slices"), ["user_id", "_slice"])
    dow = F.col("current_dow")
    request_time = {
        "train_order_number": F.col("user_total_orders") + 1,
        "train_order_hour": F.col("current_hour"),
        "train_days_since_prior": F.coalesce("days_since_last_order", "user_avg_days_between_orders"),
        "train_order_dow": dow,
        "train_is_weekend": is_weekend(dow),
    }
    flagged = joined.withColumns({**derived_ratios(), **request_time})
    return flagged.select(
        *named, *CONTEXT, "_slice", "top_n", "product_id", *FEATURES[:17], *dow_flags(dow, "train_is_dow_")
    )


def request_features(
    requests: DataFrame, pairs: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """The scored rows spelled out per request.  Requests meet the pairs themselves,
    so no wide row is shuffled to get back to them."""
    asked = requests.select("request_id", *CONTEXT, "top_n")
    return context_features(asked, pairs, users, products).select("request_id", "user_id", "product_id", *FEATURES)


def _back_to_requests(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Give each request the rows of its context; nulls match nulls."""
    left, right = requests.alias("q"), answers.alias("a")
    same = F.lit(True)
    for c in CONTEXT:
        same = same & F.col(f"q.{c}").eqNullSafe(F.col(f"a.{c}"))
    kept = [F.col(f"a.{c}") for c in answers.columns if c not in CONTEXT]
    return left.join(right, same).select("q.*", *kept)


def product_catalog(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with aisle and department names.  Both name tables have a
    16-bit key and labels of at most 100 characters, a bound for the broadcast."""
    return (
        products.join(F.broadcast(aisles), "aisle_id")
        .join(F.broadcast(departments), "department_id")
        .select(
            "product_id",
            "product_name",
            F.col("aisle").alias("aisle_name"),
            F.col("department").alias("department_name"),
        )
    )


def recommend(
    requests: DataFrame,
    pairs: DataFrame,
    users: DataFrame,
    products: DataFrame,
    catalog: DataFrame,
    scorer: Scorer,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """The best products of every request, in one job for all requests.

    Products are ranked by probability and product id.  The rank filter also
    carries the longest list any request wants as a constant, so Spark keeps
    only that many rows per context while it ranks.  Scores below the cut-off
    have the last ranks, so they are dropped after it: a filter before it would
    be pushed under the score and evaluate the model twice.  Names join the
    ranked rows, and lists go back to requests last.
    """
    longest = requests.agg(F.max("top_n")).first()[0] or 0
    rows = context_features(request_contexts(requests), pairs, users, products)
    features = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    shown = [
        F.col("user_product_total_buys").alias("total_buys"),
        F.col("user_product_order_streak").alias("order_streak"),
        F.col("product_reorder_rate").alias("product_rate"),
    ]
    scored = scorer(rows.select(*CONTEXT, "_slice", "top_n", "product_id", *shown, *features))
    place = Window.partitionBy("user_id", "_slice", *CONTEXT[1:]).orderBy(F.desc("reorder_prob"), "product_id")
    ranked = (
        scored.select(
            *CONTEXT, "_slice", "top_n", "product_id", "reorder_prob", "total_buys", "order_streak", "product_rate"
        )
        .withColumn("rank", F.row_number().over(place))
        .filter((F.col("rank") <= longest) & (F.col("rank") <= F.col("top_n")))
        .filter(F.col("reorder_prob") >= min_probability)
        .drop("_slice", "top_n")
    )
    named = ranked.join(catalog.select("product_id", "product_name"), "product_id", "left").withColumn(
        "product_name", F.coalesce("product_name", F.lit("Unknown"))
    )
    wanted = requests.select("request_id", *CONTEXT, F.col("top_n").alias("_wanted"))
    return (
        _back_to_requests(wanted, named)
        .filter(F.col("rank") <= F.col("_wanted"))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECOMMENDATION])
    )


def candidate_counts(
    requests: DataFrame, pairs: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """Scorable products per asking user, before any cut-off."""
    pairs, users = _asked_folders(requests, pairs, users)
    asking = requests.select("user_id").distinct()
    return (
        pairs.select("user_id", "product_id")
        .join(asking, "user_id", "left_semi")
        .join(products.select("product_id"), "product_id", "left_semi")
        .groupBy("user_id")
        .agg(F.count("*").alias("candidates_scored"))
        .join(users.select("user_id"), "user_id", "left_semi")
    )


def response_summary(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates per request; a user without history has none."""
    return requests.select("request_id", "user_id").join(counts, "user_id", "left").select(
        "request_id", F.coalesce("candidates_scored", F.lit(0).cast("bigint")).alias("candidates_scored")
    )


def response_comparison(summary: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Per request: candidates, mean probability and mean streak of its list."""
    lists = recommendations.groupBy("request_id").agg(
        F.count("*").alias("listed"),
        F.avg("reorder_prob").alias("avg_prob"),
        F.avg("order_streak").alias("avg_streak"),
    )
    return summary.join(lists, "request_id", "left").select(
        "request_id",
        "candidates_scored",
        F.coalesce("listed", F.lit(0).cast("bigint")).alias("listed"),
        "avg_prob",
        "avg_streak",
    )


def request_labels(requests: DataFrame) -> DataFrame:
    """How a request is described to a reader."""
    dow = F.col("current_dow")
    given = F.concat(F.bround("days_since_last_order").cast("bigint").cast("string"), F.lit(" days, as given"))
    return requests.select(
        "request_id",
        day_name(dow).alias("day_name"),
        day_kind(dow).alias("day_kind"),
        F.coalesce(given, F.lit("mean of earlier orders")).alias("gap_label"),
    )
