"""Business filters, one row per group, and look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .history import CURRENT, META
from .typing import select_columns


def business_filter(df: DataFrame, equals: Mapping[str, object], current_only: bool = True) -> DataFrame:
    """All equalities must hold; a NULL drops the row.  The scan sees every predicate."""
    if current_only:
        df = df.filter(F.col(CURRENT) == F.lit(True))
    for name, value in equals.items():
        df = df.filter(F.col(name) == value)
    return df


def select_gold(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return select_columns(df.drop(*META), list(columns))


def dedup_first(df: DataFrame, by: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each group in the given order.

    A rank filter of 1 lets Spark keep one row per group before the shuffle as well.
    """
    first = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").drop("__rank")


def transform_gold(
    df: DataFrame,
    equals: Mapping[str, object],
    columns: Sequence[str],
    dedup_by: Sequence[str],
    dedup_columns: Sequence[str],
    order_by: Sequence[str | Column],
) -> tuple[DataFrame, DataFrame]:
    """(all filtered rows, first row per group)."""
    kept = business_filter(df, equals)
    return select_gold(kept, columns), select_columns(dedup_first(kept, dedup_by, order_by), list(dedup_columns))


def enrich_lookup(df: DataFrame, lookup: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join with a code table, ``on`` mapping own columns to unique columns of the table.

    No broadcast is forced: Spark broadcasts the table if its size allows, and otherwise
    splits hot codes on the left.
    """
    renamed = lookup.select(
        *[F.col(theirs).alias(f"__on_{i}") for i, theirs in enumerate(on.values())],
        *[c for c in lookup.columns if c not in on.values()],
    )
    same = [F.col(mine) == F.col(f"__on_{i}") for i, mine in enumerate(on)]
    return df.join(renamed, same, "left").drop(*[f"__on_{i}" for i in range(len(on))])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
