"""Intermediate results as written tables in the cluster's shared folder.

A staged frame is computed once, is read back column by column, and survives lost
executors, as its lineage starts at the files.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_run: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a temporary one in local mode only."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="matchboard-")
    spark.conf.set(_SETTING, folder)
    return folder


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for what is staged inside, removed at the end, also after a failure."""
    path = scratch_path(spark, "run")
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    base = _run.get() or f"{shared_folder(spark)}/matchboard"
    return f"{base}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return a frame that reads it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
