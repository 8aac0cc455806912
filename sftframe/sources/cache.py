"""Reuse of prepared tables: each is written once per state of its source files, options and code."""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sftframe.session import shared_folder

FOLDER_SETTING = "spark.sftframe.preparedDir"


def prepared_folder(spark: SparkSession) -> str:
    return spark.conf.get(FOLDER_SETTING, None) or f"{shared_folder(spark)}/prepared"


def _located(spark: SparkSession, text: str):
    """The path and the file system it is on, local or remote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def source_state(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """A hash over name, size and change time of every file of each path, so that a replaced file is noticed."""
    state = {}
    for text in paths:
        path, files = _located(spark, text)
        found, listed = files.listFiles(path, True), []
        while found.hasNext():
            one = found.next()
            listed.append((one.getPath().toString(), one.getLen(), one.getModificationTime()))
        state[text] = hashlib.sha256(json.dumps(sorted(listed)).encode()).hexdigest()
    return state


@functools.cache
def code_state() -> str:
    """Hash of this package, so that tables written by other code are not taken up again."""
    package = Path(__file__).parents[1]
    files = sorted(package.rglob("*.py"))
    return hashlib.sha256(b"".join(path.read_bytes() for path in files)).hexdigest()


def fingerprint(spark: SparkSession, name: str, paths: list[str], options: dict) -> str:
    parts = [name, code_state(), source_state(spark, paths), options]
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:20]


def _finished(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete tables in the folder."""
    pattern, files = _located(spark, f"{folder}/*.done")
    return sorted(found.getPath().getName().removesuffix(".done") for found in files.globStatus(pattern) or [])


def reuse(
    spark: SparkSession,
    name: str,
    paths: list[str],
    options: dict,
    build: Callable[[], DataFrame],
    root: str | None = None,
) -> DataFrame:
    """Read the prepared table ``name`` if it is already there, else build and write it first.

    Every writer has a folder of its own and marks it when it is complete.  Half-written tables are therefore
    never read, and writers do not disturb each other or readers.
    """
    folder = f"{root or prepared_folder(spark)}/{name}-{fingerprint(spark, name, paths, options)}"
    finished = _finished(spark, folder)
    if not finished:
        finished = [uuid.uuid4().hex]
        build().write.parquet(f"{folder}/{finished[0]}")
        mark, files = _located(spark, f"{folder}/{finished[0]}.done")
        files.create(mark).close()
    return spark.read.parquet(f"{folder}/{finished[0]}")
