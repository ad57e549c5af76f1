"""Shared working folder for tables that have to be written and read again.

A cluster names the folder in ``spark.checkpoint.dir``.  Where that is unset, the folder lies
below the warehouse, which every session has and which its executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one.

    A result may still read it when the caller is done, so nothing removes it: clear the shared
    folder with the application, as for checkpoints.
    """
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


# The public setting that removes a query's shuffle files when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# How many files a task may write at once, so that rows need no sort by partition.
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def open_together(spark: SparkSession, files: int) -> AbstractContextManager[None]:
    """A partitioned write of that many files a task keeps them all open; beyond it, Spark sorts the rest."""
    return _setting(spark, _WRITERS, str(files))


def short_timestamps(spark: SparkSession) -> AbstractContextManager[None]:
    """Parquet files get timestamps as 64-bit numbers, Spark's own precision, instead of 96 bits."""
    return _setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the shared folder, with the lineage cut.

    The table outlives lost executors, and whatever reads it twice computes nothing twice.  Shuffle
    files behind it go as soon as it is complete; ``df`` itself, if it is used again, is computed anew.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with _setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
