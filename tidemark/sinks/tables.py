"""Parquet tables with a fixed schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..contracts import TableContract, apply_comments, assert_compatible, empty_table
from ..operators.history import current_records


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of the table at ``path``, or None when there is none yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    allow_schema_change: bool = False,
) -> None:
    """Write ``df``; a schema other than the given or the existing one is rejected."""
    if schema is not None:
        assert_compatible(df, schema)
    if not allow_schema_change:
        present = existing_schema(df.sparkSession, path)
        if present is not None:
            assert_compatible(df, present)
    df.write.mode(mode).parquet(path)


def save_named_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    contract: TableContract | None = None,
    allow_schema_change: bool = False,
) -> None:
    """Write a table of the catalog; a schema other than the existing one is rejected.

    With a contract, the table and its columns get the contract's comments.  A table cannot be
    overwritten by what is read from it.
    """
    catalog = df.sparkSession.catalog
    if catalog.tableExists(name) and not allow_schema_change:
        assert_compatible(df, df.sparkSession.read.table(name).schema)
    df.write.format("parquet").mode(mode).saveAsTable(name)
    if contract is not None:
        apply_comments(df.sparkSession, contract, name)


def save_for_lookup(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Write a table of the catalog laid out for look-ups by ``key`` (``explore.key_lookup``).

    Rows go by the key's hash into ``buckets`` files, in key order within each.  A look-up of one key
    lists and opens its one file alone, and there the row groups whose range and Bloom filter admit the
    key; a join by the key moves only the other side.  Choose ``buckets`` for files of some hundred MB.
    The key is to be unique or nearly so: rows of one key share a file, as do those without one.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    # Parquet leaves the filter out where a dictionary holds the column, which serves no unique key.
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.enable.dictionary#{key}", "false")
    writer.saveAsTable(name, path=path)


def declare_table(spark: SparkSession, contract: TableContract, path: str, name: str) -> None:
    """Give the table at ``path`` a name in the catalog, with its comments; dropping it leaves the files."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
        apply_comments(spark, contract, name)


def create_if_missing(spark: SparkSession, contract: TableContract, path: str, scd2: bool = False) -> bool:
    """Write an empty typed table unless there is one; tells whether it was created."""
    if existing_schema(spark, path) is not None:
        return False
    empty_table(spark, contract, scd2).write.parquet(path)
    return True


def save_quarantine(quarantined: DataFrame, path: str, n_rows: int | None = None) -> bool:
    """Replace the quarantine when rows were rejected; a clean run leaves the last one alone.

    Pass the count from ``quality.row_counts`` if it is known, to save the look-up.
    """
    if n_rows == 0 or (n_rows is None and quarantined.isEmpty()):
        return False
    quarantined.write.mode("overwrite").parquet(path)
    return True


def save_current_and_history(history: DataFrame, path: str) -> None:
    """Write the history, then its current rows as read back, so its plan runs once."""
    history.write.mode("overwrite").parquet(f"{path}/history")
    written = history.sparkSession.read.schema(history.schema).parquet(f"{path}/history")
    current_records(written).write.mode("overwrite").parquet(f"{path}/current")


def save_gold(main: DataFrame, dedup: DataFrame, main_path: str, dedup_path: str) -> None:
    save_table(main, main_path)
    save_table(dedup, dedup_path)
