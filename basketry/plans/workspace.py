"""Base tables, layers and matrix of one table directory, built once.

The queries over a directory share what they have in common, as readers of a
materialized layer do: each part is written on first use and read afterwards.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.recommend import product_catalog
from basketry.plans.feature_build import Layers, build_layers, build_matrix
from basketry.plans.training import TrainingResult, train
from basketry.session import scratch_exists, stage
from basketry.sources.star import StarTables

INPUTS = ("orders", "lineitem", "part", "events")


class Workspace(StarTables):
    @cached_property
    def layers(self) -> Layers:
        return build_layers(self.orders, self.order_products)

    @cached_property
    def matrix(self) -> DataFrame:
        return stage(build_matrix(self.orders, self.order_products, self.layers), "matrix")

    @cached_property
    def trained(self) -> TrainingResult:
        return train(self.matrix)

    @cached_property
    def catalog(self) -> DataFrame:
        return stage(product_catalog(self.products, self.aisles, self.departments), "catalog")


def files_state(spark: SparkSession, paths: list[str]) -> tuple:
    """Number, size, latest change and a hash of the input files, from the file
    listing alone: the content column is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return tuple(
        files.agg(
            F.count("*"),
            F.sum("length"),
            F.max("modificationTime").cast("string"),
            F.bit_xor(F.xxhash64("path", "length", "modificationTime")),
        ).first()
    )


_open: dict[tuple[str, str], tuple[tuple, Workspace]] = {}


def open_workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a directory; a new one when a file in it has changed,
    its intermediates were dropped, or the application is another one."""
    key = (spark.sparkContext.applicationId, sf_dir)
    state = files_state(spark, [f"{sf_dir}/{name}.parquet" for name in INPUTS])
    known, workspace = _open.get(key, (None, None))
    if known != state or ("orders" in vars(workspace) and not scratch_exists(spark)):
        workspace = Workspace(spark, sf_dir)
        _open[key] = (state, workspace)
    return workspace
