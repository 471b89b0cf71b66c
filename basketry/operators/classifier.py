"""Class-weighted gradient-boosted trees on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.tree_growth import Growing, Layout, Node, Rows, cuts, model_of, packed, value_counts
from basketry.schema import FEATURES, SEED, TARGET
from basketry.session import TASK_ROWS, shared_folder, ship_package

WEIGHT = "class_weight"


@dataclass(frozen=True)
class GbtSettings:
    """Fixed values where the meaning carries over to Spark's trees.  The
    regularisation terms have no counterpart, and the minimum gain is on another
    scale, so it stays at its default."""

    max_rounds: int = 500
    max_depth: int = 6
    step_size: float = 0.1
    row_share: float = 0.8
    feature_share: float = 0.8
    min_rows_per_node: int = 10
    patience: int = 30
    max_bins: int = 32
    seed: int = SEED
    extra: dict = field(default_factory=dict)


def class_balance(matrix: DataFrame) -> DataFrame:
    """Positives, negatives, positive rate and the weight that evens them out."""
    counts = matrix.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(TARGET) == 1).alias("positives"),
        F.count_if(F.col(TARGET) == 0).alias("negatives"),
    )
    return counts.select(
        "*",
        (F.col("positives") / F.nullif(F.col("total_rows"), F.lit(0).cast("bigint"))).alias("positive_rate"),
        (F.col("negatives") / F.nullif(F.col("positives"), F.lit(0).cast("bigint"))).alias("scale_pos_weight"),
    )


def with_class_weight(df: DataFrame, scale_pos_weight: float) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(TARGET) == 1, F.lit(float(scale_pos_weight))).otherwise(1.0))


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def _booster(settings: GbtSettings, rounds: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol=TARGET,
        featuresCol="features",
        weightCol=WEIGHT,
        lossType="logistic",
        maxIter=rounds,
        maxDepth=settings.max_depth,
        stepSize=settings.step_size,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.feature_share),
        minInstancesPerNode=settings.min_rows_per_node,
        maxBins=settings.max_bins,
        seed=settings.seed,
        # Trees are shallow: walking them again costs less than a cached table
        # of node ids.  Boosting state is checkpointed every ten rounds.
        cacheNodeIds=False,
        checkpointInterval=10,
        **settings.extra,
    )


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Number of rounds to keep, the lowest loss seen before ``patience`` rounds
    went by without a lower one, and whether they did go by."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def spread(rows: DataFrame, count: int) -> DataFrame:
    """Rows in at least as many partitions as there are cores and about ``TASK_ROWS``
    in each at most: boosting reads them several times for every tree, so one
    exchange is soon paid back, and what a task reads does not grow with the rows."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-count // TASK_ROWS))
    if rows.rdd.getNumPartitions() >= wanted:
        return rows
    if count <= TASK_ROWS:
        return rows.repartition(wanted)
    # dealt by place: without a key, Spark would sort whole rows before it deals them
    return rows.withColumn("_place", F.monotonically_increasing_id()).repartition(wanted, "_place").drop("_place")


def ensemble(trees: list, weights: list[float], like: GBTClassificationModel) -> GBTClassificationModel:
    """A boosted model of the given trees (models inside the JVM)."""
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    held, factors = gateway.new_array(kind, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        held[i], factors[i] = tree, float(weight)
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(like.uid, held, factors)
    for param in ("featuresCol", "labelCol", "weightCol", "maxDepth", "stepSize"):
        made.set(made.getParam(param), like._java_obj.getOrDefault(like._java_obj.getParam(param)))
    return GBTClassificationModel(made)


MARGIN = "_margin"
STORED_ROUNDS = 10  # rounds between writes of the margins
PACKED_TASKS = 16  # tasks of unpacked rows that make one of packed rows, about 100 MB
PAIRS = 256  # of label and weight; a class has one weight


def _one_tree(settings: GbtSettings, round_: int) -> Growing:
    return Growing(
        max_depth=settings.max_depth,
        feature_share=settings.feature_share,
        min_rows=settings.min_rows_per_node,
        seed=settings.seed + round_,
    )


class Boosting:
    """An ensemble that goes on growing from where it is.

    Rows are packed once (``tree_growth``), with their margin, the ensemble's answer
    so far.  A step fits one tree to the residuals and adds its answers to the
    margins; every ``STORED_ROUNDS`` steps the rows are written, so no lineage gets
    long and nothing depends on an executor's memory.
    """

    def __init__(self, start: GBTClassificationModel, rows: DataFrame, held_out: DataFrame, settings: GbtSettings):
        spark = rows.sparkSession
        ship_package(spark)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_folder(spark))
        self.settings, self.start = settings, start
        self.grown: list[Node] = []
        pairs = rows.select(TARGET, WEIGHT).union(held_out.select(TARGET, WEIGHT)).distinct().limit(PAIRS + 1).collect()
        if len(pairs) > PAIRS:
            raise ValueError("more weights than a class weight has")
        pairs = sorted((float(label), float(weight)) for label, weight in pairs)
        array = vector_to_array("features").alias("features")
        values = value_counts(rows.select(array), len(FEATURES))
        self.layout = Layout.of([cuts(*v, settings.max_bins) for v in values])
        margin = vector_to_array("rawPrediction")[1].alias("margin")
        label, weight = F.col(TARGET).cast("double").alias("label"), F.col(WEIGHT).alias("weight")
        blocks = []
        for df, least in ((rows, spark.sparkContext.defaultParallelism), (held_out, 1)):
            made = packed(start.transform(df).select(array, label, weight, margin), self.layout, pairs, df is held_out)
            tasks = max(least, -(-df.count() // (PACKED_TASKS * TASK_ROWS)))
            blocks.append(made.coalesce(tasks, shuffle=made.getNumPartitions() < tasks))
        self.rows = Rows(*blocks, self.layout, pairs, settings.row_share)
        self.at_root, _ = self.rows.root(settings.seed + self._rounds())

    def _rounds(self) -> int:
        return self.start.getNumTrees + len(self.grown)

    def close(self) -> None:
        self.rows.close()

    def step(self) -> float:
        """Grow by one tree and return the loss on the validation rows."""
        growing = _one_tree(self.settings, self._rounds())
        tree = self.rows.tree(growing, self.at_root)
        self.grown.append(tree)
        self.rows.move(tree, self.settings.step_size, write=len(self.grown) % STORED_ROUNDS == 0)
        # the pass over the new margins also serves the next tree's root
        self.at_root, loss = self.rows.root(growing.seed + 1)
        self.rows.moved()
        return loss

    def trees(self, rounds: int) -> tuple[list, list[float]]:
        """The first trees of the ensemble (models inside the JVM) and their weights."""
        first, weights = list(self.start._java_obj.trees())[:rounds], [float(w) for w in self.start.treeWeights][:rounds]
        more = [model_of(tree, self.layout, self.start.uid) for tree in self.grown[: rounds - len(first)]]
        return first + more, weights + [self.settings.step_size] * len(more)


def fit(train: DataFrame, validation: DataFrame | None, settings: GbtSettings) -> PipelineModel:
    """Fit on weighted rows.  The number of rounds is chosen on users that are
    in neither the training nor the test part: growth ends ``patience`` rounds
    after the lowest validation loss, and the ensemble is cut to the round that had
    it.  No tree is fitted twice and none beyond those rounds.

    The first ``patience + 1`` rounds, which are needed in any case, are one fit;
    later ones continue its ensemble tree by tree.
    """
    vectors = assembler()
    plain = vectors.transform(train).select("features", TARGET, WEIGHT)
    rows = spread(plain, train.count())
    if validation is None:
        return PipelineModel(stages=[vectors, _booster(settings, settings.max_rounds).fit(rows)])
    held_out = vectors.transform(validation).select("features", TARGET, WEIGHT)
    first = _booster(settings, min(settings.max_rounds, settings.patience + 1)).fit(rows)
    losses = list(first.evaluateEachIteration(held_out))
    rounds, settled = best_round(losses, settings.patience)
    trees, weights = list(first._java_obj.trees())[:rounds], list(first.treeWeights)[:rounds]
    if not settled and len(losses) < settings.max_rounds:
        growing = Boosting(first, plain, held_out, settings)
        while not settled and len(losses) < settings.max_rounds:
            losses.append(growing.step())
            rounds, settled = best_round(losses, settings.patience)
        growing.close()
        trees, weights = growing.trees(rounds)
    return PipelineModel(stages=[vectors, ensemble(trees, weights, first)])


def booster_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``reorder_prob``, the probability of class 1, on every executor."""
    scored = model.transform(rows)
    return scored.withColumn("reorder_prob", vector_to_array("probability")[1]).select(
        *rows.columns, "reorder_prob"
    )


def feature_gains(model: PipelineModel, like: DataFrame) -> DataFrame:
    """Gain per feature as rows; a feature no tree uses has gain 0."""
    gains = list(booster_of(model).featureImportances.toArray())
    gains += [0.0] * (len(FEATURES) - len(gains))  # an ensemble of given trees ends with the last feature it uses
    rows = [(name, float(gain)) for name, gain in zip(FEATURES, gains)]
    return like.sparkSession.createDataFrame(rows, "feature string, gain double")


def importance_report(gains: DataFrame) -> DataFrame:
    """Rank, share and running share of gain.  One row per feature, so one
    window partition holds them all."""
    by_gain = Window.orderBy(F.desc("gain"), "feature")
    running = by_gain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("gain").over(Window.partitionBy())

    def share(part: Column) -> Column:
        return F.when(total > 0, part * 100.0 / total).otherwise(0.0)

    return gains.select(
        F.row_number().over(by_gain).alias("rank"),
        "feature",
        F.col("gain").cast("double").alias("gain"),
        share(F.col("gain")).alias("gain_pct"),
        share(F.sum("gain").over(running)).alias("gain_pct_cum"),
    ).withColumn("in_top_80", F.col("gain_pct_cum") <= 80)
