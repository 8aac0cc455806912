"""A local session for tests, checks and the bench; it makes its prepared tables afresh."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from sftframe.session import shared_folder
from sftframe.sources.cache import FOLDER_SETTING


def local_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sftframe")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(FOLDER_SETTING, f"{shared_folder(spark)}/prepared-{uuid.uuid4().hex}")
    return spark
