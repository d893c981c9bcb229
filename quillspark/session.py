"""Session helpers: shared folders, the package on the executors, and input tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "_quillspark_shipped"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parent
    target = Path(os.path.realpath(tempfile.mkdtemp(prefix="quillspark-"))) / "quillspark.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    setattr(context, _SHIPPED, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where it is unset (tests) a local one."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute df once into the shared folder; later reads survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Bytes of a table below which its rows are left where they were read, and of a split.
SPREAD_BYTES, SPLIT_BYTES = 2 << 20, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a dataset folder.

    A small table that comes in fewer files than half the cores is dealt to all cores once; a table that fills
    the cores with splits, as any large one does, is read as it lies. Filters and columns still reach the scan.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if SPREAD_BYTES <= size < cores * SPLIT_BYTES and 2 * len(df.inputFiles()) <= cores:
        return df.repartition(cores)
    return df
