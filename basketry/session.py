"""Session settings for local runs, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import basketry


def local_session(cpus: str = "*", name: str = "basketry") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    partitions = "8" if cpus == "*" else cpus
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local run without that setting gets a temporary folder: on a cluster
    a driver-local folder would be lost to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediates."""
    return f"{shared_folder(spark)}/basketry/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_path_and_system(spark: SparkSession):
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_exists(spark: SparkSession) -> bool:
    path, system = _scratch_path_and_system(spark)
    return system.exists(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediates; call it after the last action."""
    path, system = _scratch_path_and_system(spark)
    system.delete(path, True)


# Rows that one task sorts or numbers, about.
TASK_ROWS = 1 << 18


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows, no fewer than the session plans for a shuffle: of two
    sides of a join, Spark keeps the layout with more."""
    planned = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(-(-rows // TASK_ROWS), int(planned or spark.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows dealt out by ``keys``, about ``TASK_ROWS`` a task.

    Spark merges partitions by their compressed bytes, down to one per core, while
    sorts and windows hold them unpacked.  A number of tasks that follows the
    rows bounds what a task holds at any size.  Few rows are left to Spark.
    Where one side of a join is dealt out, the other follows; for a semi or anti
    join that must be the right side, as Spark moves the join below the left one's.
    """
    if rows <= TASK_ROWS:
        return df
    return df.repartition(task_count(df.sparkSession, rows), *keys)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    For a relation used by several branches: it is computed once, its lineage
    ends in a file that survives the loss of executors, and later plans know
    its real size when they choose between a broadcast and a shuffle.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does, once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(basketry.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="basketry-")) / "basketry.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
