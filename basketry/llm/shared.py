"""Helpers that several operators of this package use."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_path, ship_package, stage  # noqa: F401


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, read it back, and let Spark delete
    the shuffle files of the plans that are no longer referenced."""
    kept = stage(df, f"llm-{label}")
    release(df.sparkSession)
    return kept


def release(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the driver has collected the objects
    that refer to them; ask for that now, not when the driver's heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete what ``save`` wrote, once nothing reads it any more."""
    for df in frames:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"llm-{label}")


def fold(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


SLOT_BITS = 24  # of the bitmap of ``possible``: at most 2**18 rows of 64, whatever the input


def possible(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` (long) may be in ``ids``, a table of one column
    of longs: all that are, and of the others those whose hash meets one.  Before a
    join with few ids: only these rows are shuffled for it."""

    def slot(name: str) -> F.Column:
        return F.shiftrightunsigned(F.xxhash64(name), 64 - SLOT_BITS)

    bit = F.expr("shiftleft(1L, cast(_slot & 63 as int))")
    held = ids.select(slot(ids.columns[0]).alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    there = (F.shiftright("_slot", 6) == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0)
    return df.withColumn("_slot", slot(column)).join(F.broadcast(held), there, "left_semi").drop("_slot")
