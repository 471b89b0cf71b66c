"""Typed CSV files, loaded whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schema import BASE_TABLES, with_wide_keys


def load_csv(spark: SparkSession, schema: T.StructType, paths: str | Sequence[str]) -> DataFrame:
    """Header, comma, double quotes; an empty field is null.  A value that does
    not fit its type fails the load instead of turning into null."""
    table = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("nullValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(paths)
    )
    if "eval_set" in schema.names:
        table = table.withColumn("eval_set", F.trim("eval_set"))
    return table


def load_base_tables(
    spark: SparkSession,
    files: dict[str, str | Sequence[str]],
    wide_keys: bool = False,
) -> dict[str, DataFrame]:
    """The five tables from their files; line items come as two files, prior
    and train, read as one table."""
    schemas = {name: with_wide_keys(s) if wide_keys else s for name, s in BASE_TABLES.items()}
    return {name: load_csv(spark, schemas[name], paths) for name, paths in files.items()}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
