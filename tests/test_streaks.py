import random

import pytest
from conftest import rows
from builders import make_items, make_orders
from pyspark.sql import functions as F

from basketry.operators import sequence
from basketry.operators.cleaning import cleaned_orders
from basketry.operators.features import pair_summary, prior_items, purchase_history

# Orders bought in -> total buys, streak, run length, first and last place.
CASES = [
    ([1, 2, 3], (3, 3, 3, 1, 3)),
    ([1, 2, 3, 5, 6], (5, 1, 2, 1, 5)),
    ([1, 2, 5], (3, 0, 1, 1, 3)),
    ([4], (1, 1, 1, 1, 1)),
    ([1, 3, 5], (3, 0, 1, 1, 3)),
]
SUMMARY = [
    "user_product_total_buys",
    "user_product_order_streak",
    "user_product_run_length",
    "user_product_first_buy_number",
    "user_product_last_buy_number",
]


def world(spark, bought):
    """One user per list of order numbers, always product 7."""
    orders, items = [], []
    for user, numbers in enumerate(bought, start=1):
        for n in range(1, max(numbers) + 1):
            orders.append((user * 10000 + n, user, "prior", n))
            if n in numbers:
                items.append((user * 10000 + n, 7, 0))
    return prior_items(make_items(spark, items), cleaned_orders(make_orders(spark, orders)))


def by_hand(numbers):
    """Total, streak, run length, walking the purchases one by one."""
    streak, run, previous = 0, 0, None
    for n in sorted(numbers):
        if previous is not None and n - previous > 1:
            streak, run = 0, 1
        else:
            streak, run = streak + 1, run + 1
        previous = n
    return len(numbers), streak, run, 1, len(numbers)


@pytest.mark.parametrize("wide", [False, True])
def test_streak_cases(spark, wide, monkeypatch):
    monkeypatch.setattr(sequence, "SLICE_LENGTH", 2)
    items = world(spark, [numbers for numbers, _ in CASES])
    if wide:
        items = items.withColumn("order_number", F.col("order_number").cast("int"))
    got = rows(pair_summary(purchase_history(items)), "user_id", *SUMMARY)
    assert got == [(user, *want) for user, (_, want) in enumerate(CASES, start=1)]


@pytest.mark.parametrize("slice_length", [1, 3, 7, 4096])
def test_sliced_history_equals_a_walk(spark, slice_length, monkeypatch):
    monkeypatch.setattr(sequence, "SLICE_LENGTH", slice_length)
    rng = random.Random(slice_length)
    bought = [sorted(rng.sample(range(1, 41), rng.randint(1, 40))) for _ in range(25)]
    items = world(spark, bought).withColumn("order_number", F.col("order_number").cast("int"))
    history = purchase_history(items)
    want = []
    for user, numbers in enumerate(bought, start=1):
        want += [(user, n, place, numbers[place - 2] if place > 1 else None) for place, n in enumerate(numbers, 1)]
    columns = ["user_id", "order_number", "buy_sequence", "prev_order_number_for_product"]
    assert rows(history, *columns) == sorted(want, key=repr)
    got = rows(pair_summary(history), "user_id", *SUMMARY)
    assert got == sorted([(u, *by_hand(numbers)) for u, numbers in enumerate(bought, 1)], key=repr)


def test_a_16_bit_order_number_needs_one_shuffle(spark):
    items = world(spark, [[1, 2], [1]])
    flat = spark.createDataFrame(items.collect(), items.schema)
    plan = pair_summary(purchase_history(flat))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
