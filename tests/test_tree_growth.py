"""Trees grown from packed rows, against plain numpy over all rows."""

import glob

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import functions as F

from basketry.operators import classifier, tree_growth as t
from basketry.schema import FEATURES, TARGET
from basketry.session import ship_package

PAIRS = [(0.0, 1.0), (1.0, 2.5)]


@pytest.fixture(scope="module")
def table():
    draw = np.random.default_rng(7)
    n = 3000
    features = np.stack([draw.integers(0, 2, n), draw.normal(size=n), np.zeros(n), draw.integers(0, 50, n), draw.exponential(size=n)], 1)
    label = (draw.random(n) < np.where(features[:, 3] > 30, 0.7, 0.2) + 0.1 * (features[:, 1] > 0)).astype(float)
    return features, label, np.where(label == 1, 2.5, 1.0), draw.normal(size=n) / 4


def frame(spark, table):
    features, label, weight, margin = table
    lines = [(x.tolist(), float(a), float(b), float(c)) for x, a, b, c in zip(features, label, weight, margin)]
    return spark.createDataFrame(lines, "features array<double>, label double, weight double, margin double")


def rows_of(spark, table, layout, tasks, row_share=1.0):
    ship_package(spark)
    df = frame(spark, table).repartition(tasks)
    return t.Rows(t.packed(df, layout, PAIRS, False), t.packed(df.limit(100), layout, PAIRS, True), layout, PAIRS, row_share)


def plain_tree(x, residual, weight, layout, depth, min_rows):
    """Prediction of each row, all splits tried on whole columns."""
    answer = np.full(len(x), (residual * weight).sum() / weight.sum())
    best = (0.0, None)
    for f, cut in enumerate(layout.cuts if depth else []):
        for c in cut:
            left = x[:, f] <= c
            if min(left.sum(), (~left).sum()) < min_rows:
                continue
            fall = sum((residual[s] * weight[s]).sum() ** 2 / weight[s].sum() for s in (left, ~left)) - (residual * weight).sum() ** 2 / weight.sum()
            if fall > best[0] + 1e-9:
                best = (fall, left)
    if best[1] is not None:
        for side in (best[1], ~best[1]):
            answer[side] = plain_tree(x[side], residual[side], weight[side], layout, depth - 1, min_rows)
    return answer


@pytest.mark.parametrize("gathered", [0, 128])
def test_a_tree_is_the_plain_one(spark, table, monkeypatch, gathered):
    """However its sums are added up."""
    monkeypatch.setattr(t, "GATHERED", gathered)
    x, label, weight, margin = table
    layout = t.Layout.of([t.cuts(*np.unique(x[:, f], return_counts=True), 16) for f in range(5)])
    rows = rows_of(spark, table, layout, 5)
    tree = rows.tree(t.Growing(4, 1.0, 20, 1), rows.root(1)[0])
    wanted = plain_tree(x, t.residuals(np.where(label == 1, 1.0, -1.0), margin), weight, layout, 4, 20)
    tables = t.levels(tree, layout)
    place = t.walked(layout.pack(x), tables)
    found = np.array([t.leaves(tree, len(tables))[p].prediction for p in place])
    assert found == pytest.approx(wanted, rel=1e-9)
    model = DecisionTreeRegressionModel(t.model_of(tree, layout, "tree"))
    assert [model.predict(Vectors.dense(line)) for line in x[:50]] == pytest.approx(found[:50], rel=1e-12)
    rows.move(tree, 0.5, False)
    _, loss = rows.root(2)
    moved = np.concatenate(rows.parts[0].map(lambda b: b.margin).collect())
    assert sorted(moved) == pytest.approx(sorted(margin + 0.5 * found), rel=1e-9) and 0 < loss < 2
    rows.moved()
    rows.close()


def test_rows_are_drawn_again_alike(spark, table):
    """A lost task draws the same rows; another tree draws others."""
    layout = t.Layout.of([t.cuts(*np.unique(table[0][:, f], return_counts=True), 16) for f in range(5)])
    rows = rows_of(spark, table, layout, 3, row_share=0.8)
    size = [rows._split_sums(rows.root(seed)[0])[0][2, 0].sum() for seed in (1, 1, 2)]
    assert size[0] == size[1] != size[2] and all(0.7 * 3000 < n < 0.9 * 3000 for n in size)
    rows.close()


def test_values_are_counted_over_all_rows(spark, table, monkeypatch):
    """Exact while few; by ranks when more than are held."""
    ship_package(spark)
    df = frame(spark, table).repartition(4)
    for (values, counts), column in zip(t.value_counts(df, 5), table[0].T):
        wanted = np.unique(column, return_counts=True)
        assert values.tolist() == wanted[0].tolist() and counts.tolist() == wanted[1].tolist()
    values, counts = t.merged(np.arange(10_000.0), np.ones(10_000))
    assert len(values) <= t.HELD and counts.sum() == 10_000 and values[-1] == 9999
    assert values.tolist() == (counts.cumsum() - 1).tolist()
    assert t.value_counts(df.limit(0), 2)[0][0].size == 0


def test_cuts():
    few = t.cuts(np.array([1.0, 2.0, 5.0]), np.array([9.0, 1.0, 1.0]), 4)
    assert few.tolist() == [1.5, 3.5]
    many = t.cuts(np.arange(100.0), np.ones(100), 4)
    assert many.tolist() == [24.5, 49.5, 74.5]
    near = np.array([1.0, np.nextafter(1.0, 2)])
    cut = t.cuts(near, np.ones(2), 4)
    assert np.searchsorted(cut, near).tolist() == [0, 1]
    assert len(t.cuts(np.array([3.0]), np.ones(1), 4)) == 0


def boosting(spark, depth):
    weighted = spark.range(600).select(
        (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias(TARGET),
        *[F.pmod(F.xxhash64("id", F.lit(c)), F.lit(9)).cast("double").alias(c) for c in FEATURES],
        F.lit(1.0).alias(classifier.WEIGHT),
    )
    rows = classifier.assembler().transform(weighted).select("features", TARGET, classifier.WEIGHT)
    settings = classifier.GbtSettings(max_depth=depth)
    return classifier.Boosting(classifier._booster(settings, 1).fit(rows), rows, rows, settings)


def test_a_step_is_one_pass_a_level(spark):
    """One job a level and one that moves the margins; no pass that prepares the rows again."""
    growing = boosting(spark, depth=3)
    try:
        spark.sparkContext.setJobGroup("one step", "")
        growing.step()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one step")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        growing.close()
    assert len(jobs) <= 3


def test_only_the_last_margins_are_kept(spark, monkeypatch):
    monkeypatch.setattr(classifier, "STORED_ROUNDS", 1)
    growing, kept = boosting(spark, depth=2), []
    for _ in range(3):
        growing.step()
        kept.append(growing.rows.written)
    here = [[bool(glob.glob(f"{path.removeprefix('file:')}/part-*")) for path in paths] for paths in kept]
    assert here == [[False, False], [False, False], [True, True]]
    growing.close()
    assert not any(glob.glob(f"{path.removeprefix('file:')}/part-*") for path in kept[-1])
