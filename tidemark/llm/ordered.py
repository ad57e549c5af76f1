"""Row numbers and running totals over one global order, without a single-task window.

Rows are dealt by ranges of the order and written once; a small total per range then turns
positions within a range into positions in the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored

# Totals by range are broadcast up to this many ranges; more are joined by shuffle.
BROADCAST_RANGES = 100_000


def running(df: DataFrame, order: list[str], value: str, label: str) -> DataFrame:
    """``df`` with ``row_before`` and ``value_before``: count and sum of ``value`` over all rows before.

    ``order`` should decide between all rows that differ; rows equal in it may come in any order,
    but the order is drawn once and written, so every later read sees the same one.  NULLs come
    first.  The columns ``__range``, ``row_before`` and ``value_before`` must be free.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = stored(
        ranged.withColumn("__row", F.count(F.lit(1)).over(inside)).withColumn(
            "__sum", F.coalesce(F.sum(value).over(inside), F.lit(0))
        ),
        label,
    )
    totals = stored(ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__v")), label)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = totals.select(
        "__range",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"),
        F.coalesce(F.sum("__v").over(before), F.lit(0)).alias("__v"),
    )
    if totals.count() <= BROADCAST_RANGES:
        totals = F.broadcast(totals)
    return ranged.join(totals, "__range").select(
        *df.columns,
        (F.col("__n") + F.col("__row")).alias("row_before"),
        (F.col("__v") + F.col("__sum")).alias("value_before"),
    )
