import random

import pytest

from basketry.operators import classifier, evaluation
from basketry.schema import TARGET


def scored(spark, pairs):
    return spark.createDataFrame(pairs, f"{TARGET} int, reorder_prob double")


def test_confusion_counts_a_half_as_positive(spark):
    got = evaluation.confusion_matrix(scored(spark, [(0, 0.2), (0, 0.5), (1, 0.4), (1, 0.9)])).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 1, 1, 1)


def auc_by_pairs(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("pairs, want", [
    ([(0, 0.2), (0, 0.5), (1, 0.4), (1, 0.9)], 0.75),
    ([(0, 0.3), (1, 0.3), (0, 0.3)], 0.5),
    ([(0, 0.1), (1, 0.3)], 1.0),
])
def test_auc_cases(spark, pairs, want):
    assert evaluation.roc_auc(scored(spark, pairs)).first().auc == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    # Most scores crowd into a sliver, some tie, some repeat.
    pairs = [
        (rng.randint(0, 1), rng.choice([0.5, rng.random(), 0.5 + rng.random() / 1e9])) for _ in range(700)
    ]
    assert evaluation.roc_auc(scored(spark, pairs)).first().auc == pytest.approx(auc_by_pairs(pairs), abs=1e-12)


def test_auc_needs_both_classes(spark):
    assert evaluation.roc_auc(scored(spark, [(1, 0.3), (1, 0.4)])).first().auc is None


def test_tiers(spark):
    df = spark.createDataFrame([(0.9,), (0.85,), (0.8,), (0.75,), (0.1,)], "auc double")
    got = [r[0] for r in df.select(evaluation.auc_tier(df.auc)).collect()]
    assert got == ["EXCELLENT", "EXCELLENT", "GOOD", "FAIR", "NEEDS REVIEW"]


def test_report(spark):
    counts = spark.createDataFrame([(50, 10, 5, 35)], "tn long, fp long, fn long, tp long")
    got = {r.label: r for r in evaluation.classification_report(counts).collect()}
    assert got["1"].precision == pytest.approx(35 / 45) and got["1"].recall == pytest.approx(35 / 40)
    assert got["0"].f1 == pytest.approx(100 / 115) and got["0"].support == 60
    assert got["accuracy"].precision == 0.85
    assert got["weighted avg"].recall == pytest.approx(0.85)
    empty = spark.createDataFrame([(3, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    assert {r.label: r.f1 for r in evaluation.classification_report(empty).collect()}["1"] == 0.0


def test_class_weight(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, f"{TARGET} int")
    got = classifier.class_balance(df).first()
    assert (got.positives, got.negatives, got.positive_rate, got.scale_pos_weight) == (3, 9, 0.25, 3.0)
    weights = classifier.with_class_weight(df, 3.0).groupBy(TARGET).sum(classifier.WEIGHT).collect()
    assert {r[0]: r[1] for r in weights} == {0: 9.0, 1: 9.0}


def test_importance_report(spark):
    gains = spark.createDataFrame([("a", 1.0), ("b", 6.0), ("c", 0.0), ("d", 3.0)], "feature string, gain double")
    got = [tuple(r) for r in classifier.importance_report(gains).orderBy("rank").collect()]
    assert got == [
        (1, "b", 6.0, 60.0, 60.0, True),
        (2, "d", 3.0, 30.0, 90.0, False),
        (3, "a", 1.0, 10.0, 100.0, False),
        (4, "c", 0.0, 0.0, 100.0, False),
    ]


def test_best_round_has_patience():
    assert classifier.best_round([5, 4, 3, 3.5, 3.2, 2.9, 4], 3) == (6, False)
    assert classifier.best_round([5, 4, 3, 3.5, 3.2, 3.1, 1], 3) == (3, True)
    assert classifier.best_round([1.0], 3) == (1, False)
