"""Minimax contiguous partition: ordered atomic groups into shards of the smallest capacity.

Groups stand in one order and are never split.  The capacity is the smallest for which cutting
greedily needs no more than the given number of shards, found by binary search.  Every greedy step
is a look-up in the running total of the group sizes.  The driver never holds that total: it
holds blocks, each a run of groups between two totals, and splits only blocks that a look-up hits
between two groups, by one grouped job for all of them, until no look-up is open.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .ordered import running

# Blocks of the first division; each later job divides every block that it splits into 2**SPLIT_BITS.
BLOCKS = 1 << 14
SPLIT_BITS = 6


class _Blocks:
    """Runs of groups by the running total before them: ``start -> (end, cell, bits, groups)``."""

    def __init__(self, groups: DataFrame, total: int) -> None:
        self.groups = groups
        bits = max(0, (max(1, total) // BLOCKS).bit_length())
        self.blocks = {row[0]: row[1:] for row in self._cells(groups, bits)}
        self._sort()

    @staticmethod
    def _cells(groups: DataFrame, bits: int):
        cell = F.shiftright("start", bits) if bits else F.col("start")
        cells = groups.groupBy(cell.alias("cell")).agg(
            F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"), F.count(F.lit(1)).alias("n")
        )
        return [(r["start"], r["end"], r["cell"], bits, r["n"]) for r in cells.collect()]

    def _sort(self) -> None:
        self.starts = sorted(self.blocks)
        self.open: set[int] = set()

    def cut(self, x: int, up: bool = False) -> int:
        """The last border at or before ``x`` (``up``: the first one at or after it); borders are group starts and the end."""
        i = bisect.bisect_right(self.starts, x) - 1
        start = self.starts[i]
        end, _, _, n = self.blocks[start]
        if x in (start, end):
            return x
        if x > end:  # beyond everything
            return end
        if n > 1:
            self.open.add(start)
        return end if up else start

    def split(self) -> bool:
        """Divide the blocks that look-ups have hit; False if there were none."""
        if not self.open:
            return False
        by_bits: dict[int, list[int]] = {}
        for start in self.open:
            _, cell, bits, _ = self.blocks.pop(start)
            by_bits.setdefault(bits, []).append(cell)
        for bits, cells in by_bits.items():
            cell = F.shiftright("start", bits) if bits else F.col("start")
            for row in self._cells(self.groups.filter(cell.isin(cells)), max(0, bits - SPLIT_BITS)):
                self.blocks[row[0]] = row[1:]
        self._sort()
        return True


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Capacity and the totals at which shards 1, 2, ... start.

    ``groups`` has ``start`` (total of the sizes before, distinct) and ``size`` (1 or more).  Among
    the cuts that keep the smallest capacity, each shard stops once it holds an even part of what
    is left, so that none stays empty while others are full.
    """
    found = groups.agg(F.sum("size"), F.max("size")).first()
    if found[0] is None:
        return 0, [0] * (shards - 1)
    total, largest = int(found[0]), int(found[1])
    blocks = _Blocks(groups, total)

    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(shards):
            at = blocks.cut(at + capacity)
            if at >= total:
                return True
        return False

    while True:
        low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
        while low < high:
            middle = (low + high) // 2
            if fits(middle):
                high = middle
            else:
                low = middle + 1
        earliest = [total]  # from the end: the least total at which the shards after a cut can hold the rest
        for _ in range(shards - 1):
            earliest.append(blocks.cut(max(0, earliest[-1] - low), up=True))
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            even = blocks.cut(at + -(-(total - at) // left), up=True)
            at = min(blocks.cut(at + low), max(even, earliest[left - 1]))
            cuts.append(at)
        if not blocks.split():
            return low, cuts


def shard(rows: DataFrame, key: str, order: str, size: str, shards: int = 16) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within a shard).

    Rows with the same ``key`` are one atomic group.  Groups are ordered by their least ``order``
    value (NULL first), then by key; rows of a group by ``order``.  Sizes are 1 or more.  A group
    above an even part stays whole and makes the capacity.  No rows give no rows.  The columns
    ``shard``, ``slot``, ``row_before``, ``value_before`` and those starting with ``__`` must be free.
    """
    least = rows.groupBy(key).agg(F.min(order).alias("__first"), F.max(F.col(order).isNull()).alias("__null"))
    least = least.withColumn("__first", F.when(~F.col("__null"), F.col("__first"))).drop("__null")
    least = stored(least, "groups")  # written, so that adaptive execution can split the rows of a hot group
    placed = running(rows.join(least, key), ["__first", key, order], size, "shards")
    placed = stored(placed, "shards")
    groups = stored(
        placed.groupBy("__first", key).agg(F.min("value_before").alias("start"), F.sum(size).alias("size")), "groups"
    )
    _, cuts = minimax_cuts(groups, shards)
    # Cuts are group borders, so the total before a row decides for its whole group.
    at = F.col("value_before")
    number = sum((F.when(at >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    placed = placed.withColumn("shard", number)
    first = placed.groupBy("shard").agg(F.min("row_before").alias("__zero"))  # one row a shard
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("row_before") - F.col("__zero"))
        .select(*rows.columns, "shard", "slot")
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Size is the UTF-8 bytes of the text (NULL: none) plus 1; equal texts are one group, NULL as an
    empty one.  The law is ``bytes``: no other contiguous partition has a smaller largest shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("text_key"),
    )
    rows = stored(rows, "sizes")
    return shard(rows, "text_key", "doc_id", "size", shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
