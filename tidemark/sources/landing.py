"""Landing folders: ``<base>/<timestamp>/<table>.csv``, one full dump per timestamp."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import scan_csv

# Folder names, hour and minute may lack a leading zero.
FOLDER_PATTERN = r"\d{4}-\d{2}-\d{2}T\d{1,2}-\d{1,2}"

SNAPSHOT_TS = "__snapshot_ts"


def folder_time(path: Column, table: str) -> Column:
    """The time in the name of the folder directly above the table, NULL when it is named otherwise."""
    text = F.regexp_extract(path, rf"/({FOLDER_PATTERN})/{re.escape(table)}\.csv(/[^/]*)?$", 1)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'H-m"))


def list_snapshots(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One row per landing folder of ``table``: folder path, table path and time.

    The binary source only lists files here, since their content is not selected.
    """
    files = f"{base.rstrip('/')}/*/{table}.csv"
    try:
        paths = spark.read.format("binaryFile").load(files).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no landing folder with {table}.csv in {base}") from error
    table_path = F.regexp_extract("path", rf"^(.*/{re.escape(table)}\.csv)(/.*)?$", 1)
    return (
        paths.select(table_path.alias("table_path"))
        .withColumn(SNAPSHOT_TS, folder_time(F.col("table_path"), table))
        .filter(F.col(SNAPSHOT_TS).isNotNull())
        .distinct()
    )


def latest_snapshot_path(spark: SparkSession, base: str, table: str) -> str:
    """Table path in the newest landing folder; one value reaches the driver."""
    newest = list_snapshots(spark, base, table).agg(F.max_by("table_path", SNAPSHOT_TS)).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no timestamp folder with {table}.csv in {base}")
    return newest


def latest_snapshot(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest dump; older folders are not read."""
    return scan_csv(spark, latest_snapshot_path(spark, base, table))


def all_snapshots(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Every dump, stacked, with the folder's time in ``__snapshot_ts``."""
    try:
        rows = scan_csv(spark, f"{base.rstrip('/')}/*/{table}.csv", file_column="__file")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no landing folder with {table}.csv in {base}") from error
    timed = rows.withColumn(SNAPSHOT_TS, folder_time(F.col("__file"), table)).drop("__file")
    return timed.filter(F.col(SNAPSHOT_TS).isNotNull())
