"""Split report, confusion matrix, class report and exact ranking quality."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.schema import AUC_LOWEST_TIER, AUC_TIERS, CLASS_THRESHOLD, TARGET
from basketry.session import stage

SCORE_RANGES = 512


def split_report(split: DataFrame) -> DataFrame:
    """Rows and users per side.  Rows are reduced to users before the count, so
    a busy user crosses the shuffle once per task."""
    per_user = split.groupBy("split", "user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy("split").agg(
        F.sum("n").alias("row_count"), F.count("*").alias("unique_users")
    )


def split_overlap(split: DataFrame) -> DataFrame:
    """Users found on more than one side; 0 when the split is sound."""
    sides = split.select("user_id", "split").distinct().groupBy("user_id").agg(F.count("*").alias("n"))
    return sides.agg(F.count_if(F.col("n") > 1).alias("overlapping_users"))


def shared_users(left: DataFrame, right: DataFrame) -> DataFrame:
    """The users two parts have in common."""
    return left.select("user_id").intersect(right.select("user_id"))


def predicted_class(prob: Column, threshold: float = CLASS_THRESHOLD) -> Column:
    return (prob >= threshold).cast("int")


def confusion_matrix(scored: DataFrame, threshold: float = CLASS_THRESHOLD) -> DataFrame:
    actual = F.col(TARGET) == 1
    said = predicted_class(F.col("reorder_prob"), threshold) == 1
    return scored.agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / F.nullif(whole, F.lit(0).cast("bigint"))).otherwise(0.0)


def classification_report(confusion: DataFrame) -> DataFrame:
    """Five rows from one row of counts: both classes, accuracy and averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    per_class = confusion.select(
        _ratio(tn, tn + fn).alias("p0"),
        _ratio(tn, tn + fp).alias("r0"),
        _ratio(tn * 2, tn * 2 + fn + fp).alias("f0"),
        (tn + fp).alias("s0"),
        _ratio(tp, tp + fp).alias("p1"),
        _ratio(tp, tp + fn).alias("r1"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        (tp + fn).alias("s1"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
    )
    s0, s1 = F.col("s0"), F.col("s1")
    rows = s0 + s1

    def macro(m: str) -> Column:
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m: str) -> Column:
        total = F.col(f"{m}0") * s0 + F.col(f"{m}1") * s1
        return F.when(rows != 0, total / F.nullif(rows, F.lit(0).cast("bigint"))).otherwise(0.0)

    accuracy = F.col("accuracy")
    return per_class.select(
        F.inline(
            F.array(
                line("0", F.col("p0"), F.col("r0"), F.col("f0"), s0),
                line("1", F.col("p1"), F.col("r1"), F.col("f1"), s1),
                line("accuracy", accuracy, accuracy, accuracy, rows),
                line("macro avg", macro("p"), macro("r"), macro("f"), rows),
                line("weighted avg", weighted("p"), weighted("r"), weighted("f"), rows),
            )
        )
    )


def _score_range(per_score: DataFrame) -> DataFrame:
    """Cut the distinct scores into ranges of about equal size, however they
    cluster.  Only the edges, at most ``SCORE_RANGES``, reach the driver."""
    steps = [i / SCORE_RANGES for i in range(1, SCORE_RANGES)]
    edges = sorted(set(per_score.approxQuantile("reorder_prob", steps, 0.25 / SCORE_RANGES)))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="reorder_prob", outputCol="_range")
    return cut.transform(per_score)


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs
    ranked rightly, a tie counting half.

    Rows collapse to one per distinct score.  Each positive needs the negatives
    scored below it: those in lower ranges come from a window over one row per
    range, those in its own range from a window inside it, so no task sorts all
    scores.  Counts stay whole numbers up to the last division.
    """
    counts = scored.groupBy("reorder_prob").agg(
        F.count_if(F.col(TARGET) == 1).cast("decimal(38,0)").alias("pos"),
        F.count_if(F.col(TARGET) == 0).cast("decimal(38,0)").alias("neg"),
    )
    per_score = stage(counts, "scores")
    ranged = _score_range(per_score)
    up_to_here = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(F.sum("neg").alias("_neg")).select(
        "_range", F.coalesce(F.sum("_neg").over(up_to_here), F.lit(0)).alias("_lower")
    )
    inside = Window.partitionBy("_range").orderBy("reorder_prob").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    # Twice the number of rightly ranked pairs, so that a tie counts 1.
    pairs = (
        ranged.withColumn("_inside", below.cast("decimal(38,0)"))
        .join(F.broadcast(ranges), "_range")
        .agg(
            F.sum(F.col("pos") * 2 * (F.col("_inside") + F.col("_lower")) + F.col("pos") * F.col("neg"))
            .cast("double")
            .alias("_won"),
            F.sum("pos").cast("double").alias("_pos"),
            F.sum("neg").cast("double").alias("_neg"),
        )
    )
    area = F.when(
        (F.col("_pos") > 0) & (F.col("_neg") > 0), F.col("_won") / (F.col("_pos") * F.col("_neg") * 2)
    )
    return pairs.select(area.alias("auc")).withColumn("tier", auc_tier(F.col("auc")))


def auc_tier(auc: Column) -> Column:
    named = F.lit(AUC_LOWEST_TIER)
    for floor, name in reversed(AUC_TIERS):
        named = F.when(auc >= floor, name).otherwise(named)
    return named
