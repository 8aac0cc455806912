"""Shared storage of a session: checkpoints that cut lineage, and prepared tables."""

from __future__ import annotations

import functools
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sftframe-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors and is never computed twice."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@functools.cache
def _archive() -> str:
    package = Path(__file__).parent
    return shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)


@functools.cache
def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, for jobs whose functions use it there."""
    spark.sparkContext.addPyFile(_archive())
