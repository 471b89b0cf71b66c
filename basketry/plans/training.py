"""Training from a matrix to a fitted model and its report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import classifier as c
from basketry.operators import evaluation as e
from basketry.operators.labels import model_frame, sample_users, with_exact_split
from basketry.schema import SEED, TEST_SHARE
from basketry.session import stage
from basketry.sources.store import save_model

VALIDATION_SHARE = 0.10


@dataclass
class TrainingResult:
    model: PipelineModel
    split: DataFrame
    confusion: DataFrame
    report: DataFrame
    auc: DataFrame
    importance: DataFrame


def train(
    matrix: DataFrame,
    settings: c.GbtSettings = c.GbtSettings(),
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE,
    one_user_in: int | None = None,
    model_path: str | None = None,
) -> TrainingResult:
    """Prepare, split by user, weight, fit, evaluate and save.

    Users fall into three parts: the number of rounds is chosen on the
    validation part, and the test part is used for the report alone.
    """
    frame = with_exact_split(
        model_frame(sample_users(matrix, one_user_in)), test_share, validation_share, SEED
    )
    frame = stage(frame, "matrix", partition_by=["split"])
    part = {name: frame.filter(F.col("split") == name) for name in ("train", "validation", "test")}
    weight = c.class_balance(part["train"]).first()["scale_pos_weight"] or 1.0
    train_rows = c.with_class_weight(part["train"], weight)
    held_out = c.with_class_weight(part["validation"], weight) if validation_share > 0 else None
    model = c.fit(train_rows, held_out, settings)
    if model_path:
        save_model(model, model_path)
    scored = stage(c.score(model, part["test"]).select("user_id", "product_id", c.TARGET, "reorder_prob"), "scored")
    confusion = e.confusion_matrix(scored)
    return TrainingResult(
        model=model,
        split=e.split_report(frame),
        confusion=confusion,
        report=e.classification_report(confusion),
        auc=e.roc_auc(scored),
        importance=c.importance_report(c.feature_gains(model, frame)),
    )
