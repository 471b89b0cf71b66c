import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.operators import classifier
from basketry.plans.serving import model_scorer
from basketry.plans.training import train
from basketry.schema import FEATURES, IDENTIFIERS, TARGET
from basketry.sources.store import load_model

SETTINGS = classifier.GbtSettings(max_rounds=8, max_depth=3, patience=3)


@pytest.fixture(scope="module")
def matrix(spark):
    """400 users with 10 products; many buys and a long streak make a reorder likely."""
    base = spark.range(4000).select(
        F.floor(F.col("id") / 10).alias("user_id"),
        (F.col("id") % 10).cast("int").alias("product_id"),
        F.floor(F.col("id") / 10).alias("train_order_id"),
        (F.pmod(F.xxhash64("id"), F.lit(20))).alias("buys"),
        (F.pmod(F.xxhash64(F.col("id") + 1), F.lit(10))).alias("noise"),
    )
    label = (F.col("buys") + F.col("noise") > 18).cast("int").alias(TARGET)
    signal = {"user_product_total_buys": F.col("buys"), "train_order_hour": F.col("noise") * 0 + 3}
    return base.select(
        *IDENTIFIERS,
        label,
        *[signal.get(c, F.pmod(F.xxhash64("user_id", F.lit(c)), F.lit(7))).cast("double").alias(c) for c in FEATURES],
    )


@pytest.fixture(scope="module")
def result(spark, matrix, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    return train(matrix, SETTINGS, model_path=path), path


def test_a_planted_signal_is_found(result):
    auc = result[0].auc.first().auc
    assert 0.8 < auc <= 1.0
    top = result[0].importance.orderBy("rank").first()
    assert top.feature == "user_product_total_buys" and top["rank"] == 1


def test_importance_adds_up(result):
    table = result[0].importance.collect()
    assert len(table) == len(FEATURES)
    assert sum(r.gain_pct for r in table) == pytest.approx(100)
    unused = {r.feature: r.gain for r in table}["train_order_hour"]
    assert unused == 0.0


def test_probabilities_and_reload(spark, matrix, result):
    trained, path = result
    frame = matrix.limit(200)
    scored = model_scorer(trained.model)(frame)
    assert scored.columns == [*frame.columns, "reorder_prob"]
    low, high = scored.agg(F.min("reorder_prob"), F.max("reorder_prob")).first()
    assert 0.0 <= low < high <= 1.0
    again = model_scorer(load_model(path))(frame)
    assert rows(again, "user_id", "product_id", "reorder_prob") == rows(scored, "user_id", "product_id", "reorder_prob")


def test_confusion_covers_the_test_part(result):
    counts = result[0].confusion.first()
    sides = {r.split: r.row_count for r in result[0].split.collect()}
    assert sum(counts) == sides["test"] and set(sides) == {"train", "validation", "test"}


def test_one_user_in_four(matrix):
    few = train(matrix, classifier.GbtSettings(max_rounds=2, max_depth=2), validation_share=0.0, one_user_in=4)
    sides = {r.split: r.unique_users for r in few.split.collect()}
    assert sum(sides.values()) == 100 and "validation" not in sides


@pytest.fixture(scope="module")
def parts(matrix):
    """Weighted training rows and rows of other users."""
    weighted = classifier.with_class_weight(matrix, 1.5)
    return weighted.filter("user_id % 4 != 0"), weighted.filter("user_id % 4 = 0")


def grown(parts, monkeypatch, **settings):
    """A fit, the rounds it fitted and the losses it saw."""
    fitted, losses = [], []
    one_tree, booster, step = classifier._one_tree, classifier._booster, classifier.Boosting.step
    monkeypatch.setattr(classifier, "_one_tree", lambda s, m: fitted.append(1) or one_tree(s, m))
    monkeypatch.setattr(classifier, "_booster", lambda s, n: fitted.append(n) or booster(s, n))
    monkeypatch.setattr(classifier.Boosting, "step", lambda self: losses.append(step(self)) or losses[-1])
    model = classifier.booster_of(classifier.fit(*parts, classifier.GbtSettings(max_depth=2, **settings)))
    monkeypatch.undo()
    return model, sum(fitted), losses


def test_growth_goes_on_from_the_ensemble(parts, monkeypatch):
    monkeypatch.setattr(classifier, "STORED_ROUNDS", 2)
    short, fitted, _ = grown(parts, monkeypatch, max_rounds=5, patience=2)
    long, more, losses = grown(parts, monkeypatch, max_rounds=8, patience=2)
    assert (fitted, more) == (5, 8)  # every tree once
    assert len(short.trees) == 5 and len(long.trees) == 8
    assert [t.toDebugString.split("\n", 1)[1] for t in short.trees] == [t.toDebugString.split("\n", 1)[1] for t in long.trees[:5]]
    held_out = classifier.assembler().transform(parts[1])
    assert long.evaluateEachIteration(held_out)[3:] == pytest.approx(losses, rel=1e-9)
    assert long.treeWeights == [1.0, *[0.1] * 7]


def test_growth_ends_with_patience_and_is_cut(parts, monkeypatch):
    """Labels of the validation rows are turned round, so their loss only rises."""
    train_rows, held_out = parts
    against = held_out.withColumn(TARGET, 1 - F.col(TARGET))
    model, fitted, _ = grown((train_rows, against), monkeypatch, max_rounds=50, patience=3)
    assert len(model.trees) == 1 and fitted == 4


def test_growth_keeps_the_best_of_later_rounds(parts, monkeypatch):
    """From the sixth round on the loss is made to rise."""
    step, seen = classifier.Boosting.step, []

    def worse(self):
        seen.append(step(self))
        return seen[-1] if len(seen) < 4 else 9.0 + len(seen)

    monkeypatch.setattr(classifier.Boosting, "step", worse)
    model = classifier.booster_of(classifier.fit(*parts, classifier.GbtSettings(max_depth=2, max_rounds=50, patience=2)))
    assert len(model.trees) == 6 and len(seen) == 5
