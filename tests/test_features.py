import random
from decimal import ROUND_HALF_UP, Decimal

from conftest import rows
from builders import make_orders, small_world
from pyspark.sql import functions as F

from basketry.functions.calendar import day_kind, day_name
from basketry.functions.numeric import bucket_1000, percent_of, round_ratio
from basketry.operators import features as f
from basketry.operators.cleaning import cleaned_orders, sample_rows
from basketry.plans.feature_build import build_layers


def test_cleaning(spark):
    orders = make_orders(spark, [
        (1, 1, "prior", 1, 0, 8, None),
        (2, 1, "prior", 2, 1, 8, 15),
        (3, 1, "prior", 3, 6, 8, 30),
    ])
    clean = cleaned_orders(orders)
    assert len(clean.columns) == 15
    assert dict(clean.dtypes)["days_since_prior_order"] == "decimal(5,1)"
    flags = [f"is_dow_{d}" for d in range(7)]
    got = rows(clean, "order_id", "days_since_prior_order", "is_weekend", *flags)
    assert got == [
        (1, Decimal("0.0"), 1, 1, 0, 0, 0, 0, 0, 0),
        (2, Decimal("15.0"), 1, 0, 1, 0, 0, 0, 0, 0),
        (3, Decimal("30.0"), 0, 0, 0, 0, 0, 0, 0, 1),
    ]


def test_a_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(5000).withColumn("key", F.when(F.col("id") % 100 != 0, F.col("id")))
    picked = rows(sample_rows(df, ["key", "id"], 20))
    assert len(picked) == 20 and picked == rows(sample_rows(df.repartition(7).sortWithinPartitions(F.desc("id")), ["key", "id"], 20))
    assert picked != rows(sample_rows(df, ["key", "id"], 20, seed=1))
    text = sample_rows(df, ["key", "id"], 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_round_ratio(spark):
    df = spark.sql("SELECT * FROM VALUES (2, 3), (5, 2), (-5, 2), (1, 0), (0, 7), (-1, 9) AS t(a, b)")
    got = [tuple(r) for r in df.select(round_ratio(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [(1.0,), (3.0,), (-3.0,), (None,), (0.0,), (0.0,)]
    six = df.limit(1).select(round_ratio(F.col("a"), F.col("b"), 6)).first()[0]
    assert six == 0.666667
    assert df.limit(1).select(percent_of(F.col("a"), F.col("b"))).first()[0] == 66.67


def test_mean_gap_counts_the_filled_zero(spark):
    orders = make_orders(spark, [
        (1, 1, "prior", 1, 0, 0, None),
        (2, 1, "prior", 2, 0, 0, 10),
        (3, 1, "prior", 3, 0, 0, 20),
    ])
    assert rows(f.user_order_totals(cleaned_orders(orders))) == [(1, 3, 10.0)]


def test_mean_gap_is_rounded_once(spark):
    gaps = [None, 0.6] + [0.0] * 9
    orders = make_orders(spark, [(i, 1, "prior", i, 0, 0, g) for i, g in enumerate(gaps, 1)])
    assert f.user_order_totals(cleaned_orders(orders)).first().user_avg_days_between_orders == 0.0545


def test_six_digit_rate_and_train_order_left_out(spark):
    orders, items = small_world(spark)
    prior = f.prior_items(items, cleaned_orders(orders))
    assert rows(f.product_features(prior)) == [(10, 4, 0.5), (11, 2, 0.0), (12, 1, 0.0)]
    pairs = f.pair_summary(f.purchase_history(prior))
    rate = {(r.user_id, r.product_id): r.user_product_reorder_rate for r in pairs.collect()}
    assert rate[(1, 10)] == 0.666667
    assert (1, 99) not in rate and (2, 13) not in rate


def test_user_without_items_is_not_in_the_user_layer(spark):
    orders, items = small_world(spark)
    clean = cleaned_orders(orders)
    users = f.user_features(clean, f.user_item_counts(f.prior_items(items, clean)))
    assert rows(users) == [(1, 3, 10.0, 5), (2, 1, 0.0, 1), (3, 1, 0.0, 1)]


def test_layers_summed_from_pairs_equal_those_from_items(spark):
    orders, items = small_world(spark)
    clean = cleaned_orders(orders)
    prior = f.prior_items(items, clean)
    layers = build_layers(orders, items)
    assert rows(layers.users) == rows(f.user_features(clean, f.user_item_counts(prior)))
    assert rows(layers.products) == rows(f.product_features(prior))


def test_dropping_later_orders_changes_no_layer(spark):
    orders, items = small_world(spark)
    full = build_layers(orders, items)
    bare = build_layers(orders.filter("eval_set = 'prior'"), items)
    for a, b in [(full.pairs, bare.pairs), (full.users, bare.users), (full.products, bare.products)]:
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_recency_by_order_and_top_pairs(spark):
    orders, items = small_world(spark)
    layers = build_layers(orders, items)
    table = f.recency_by_order(layers.pairs, layers.users).collect()
    recency = {(r.user_id, r.product_id): r.recency_ratio_by_order for r in table}
    assert recency[(1, 11)] == 0.3333 and recency[(1, 10)] == 1.0
    top = f.top_pairs(layers.pairs, layers.users, layers.products, 2).collect()
    assert [(r.user_id, r.product_id) for r in top] == [(1, 10), (1, 11)]


def test_unknown_day_has_no_name(spark):
    df = spark.createDataFrame([(0,), (6,), (9,), (None,)], "d int")
    got = [tuple(r) for r in df.select(day_name(F.col("d")), day_kind(F.col("d"))).collect()]
    assert got == [("Saturday", "Weekend"), ("Friday", "Weekday"), ("?", "Weekday"), ("?", "Weekday")]


def test_round_ratio_equals_decimal_rounding(spark):
    rng = random.Random(5)
    cases = [(rng.randint(-(10**9), 10**9), rng.randint(1, 10**6)) for _ in range(500)]
    cases += [(a, b) for a in range(-20, 21) for b in (1, 2, 8, 40, 3200)]
    df = spark.createDataFrame(cases, "a long, b long")
    for digits in (0, 2, 4, 6):
        got = df.select("a", "b", round_ratio(F.col("a"), F.col("b"), digits).alias("q")).collect()
        for a, b, q in got:
            exact = (Decimal(a) / Decimal(b)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert q == float(exact), (a, b, digits)


def test_hash_buckets_equal_plain_arithmetic(spark):
    def by_hand(key, seed):
        state = (key % 2147483648 * 1103515245 + 12345) % 2147483648
        state = ((state + seed) % 2147483648 * 1103515245 + 12345) % 2147483648
        return state // 65536 % 1000

    keys = [0, 1, 2, 999, 2**31 - 1, 2**31, 2**40 + 7, 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for seed in (0, 42, 2**31 - 1):
        got = [r[0] for r in df.select(bucket_1000(F.col("k"), seed)).collect()]
        assert got == [by_hand(k, seed) for k in keys]
