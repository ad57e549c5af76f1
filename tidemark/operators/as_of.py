"""Facts next to the version that was valid at their time.

An equality join on the key alone holds every fact of a key against every version of it.  That is
fine for keys with few versions.  The versions of other keys are cut, in time order, into blocks of a
few versions each; facts look up the block of their time, and the join is on key and block, with the
bounds checked after.  So a fact meets a bounded number of versions, however many its key has, and
there is no nested-loop join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .history import FROM, META, TO

# Versions of a block; keys with no more than these are joined as they are.
BLOCK = 16


def _number(starts: Column, before: Column, inclusive: bool) -> Column:
    """How many block starts lie before a time, or at it."""
    return F.size(F.filter(starts, lambda s: s <= before if inclusive else s < before))


def block_starts(history: DataFrame, keys: Sequence[str], block: int = BLOCK) -> DataFrame:
    """``__starts``, the times at which the second and later blocks begin, of each key with several.

    Keys are counted before the shuffle, and only keys with more versions than a block holds are put in order.
    """
    if block < 1:
        raise ValueError("a block holds one version at least")
    versions = history.select(*keys, FROM).filter(reduce(and_, [F.col(c).isNotNull() for c in (*keys, FROM)]))
    large = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > block)
    large = large.select(*[F.col(k).alias(f"__large_{i}") for i, k in enumerate(keys)])
    # The versions are on the left, where adaptive execution can split them.
    wanted = versions.join(large, [F.col(k) == F.col(f"__large_{i}") for i, k in enumerate(keys)], "left_semi")
    in_order = Window.partitionBy(*keys).orderBy(FROM)
    placed = wanted.withColumn("__place", F.row_number().over(in_order) - 1)
    firsts = placed.filter((F.col("__place") > 0) & (F.col("__place") % block == 0))
    return firsts.groupBy(*keys).agg(F.sort_array(F.collect_list(FROM)).alias("__starts"))


def facts_as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    at: str | Column,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    how: str = "left",
    block: int = BLOCK,
) -> DataFrame:
    """``facts`` with the columns of the version of their key that is valid at their time.

    ``keys`` maps the facts' columns to the history's, ``at`` is the facts' time, ``columns`` of the
    history are added under ``prefix``, by default all but keys and history columns.  A version is
    valid from ``__valid_from`` up to, but not at, ``__valid_to``.  ``how`` is ``left``, facts without
    a version show NULLs, or ``inner``.  A NULL key or time has no version.  Where versions of a key
    overlap, a fact comes once for each of them.

    Facts are the left side of the join, which adaptive execution splits where a key is hot.  The
    history is read twice or more: give a written one.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join 'left' or 'inner', not {how!r}")
    on = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    theirs = list(on.values())
    shown = [c for c in history.columns if c not in (*META, *theirs)] if columns is None else list(columns)
    twice = sorted({f"{prefix}{c}" for c in shown} & set(facts.columns))
    if twice:
        raise ValueError(f"facts already have {twice}: give a prefix")
    time = (F.col(at) if isinstance(at, str) else at).cast("timestamp")
    starts = stored(block_starts(history, theirs, block), "blocks")  # so that its true size decides the joins
    left = facts.withColumn("__at", time)
    right = history.filter(F.col(FROM).isNotNull()).select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(theirs)],
        F.col(FROM).alias("__from"),
        F.col(TO).alias("__to"),
        *[F.col(c).alias(f"{prefix}{c}") for c in shown],
    )
    same = [F.col(mine) == F.col(f"__key_{i}") for i, mine in enumerate(on)]
    valid = (F.col("__from") <= F.col("__at")) & (F.col("__to").isNull() | (F.col("__at") < F.col("__to")))
    if not starts.isEmpty():
        named = starts.select(*[F.col(k).alias(f"__of_{i}") for i, k in enumerate(theirs)], "__starts")

        def with_starts(df: DataFrame, names: Sequence[str]) -> DataFrame:
            return df.join(named, [F.col(c) == F.col(f"__of_{i}") for i, c in enumerate(names)], "left")

        of_fact = F.coalesce(_number(F.col("__starts"), F.col("__at"), True), F.lit(0))
        left = with_starts(left, list(on)).withColumn("__block", of_fact).select(*facts.columns, "__at", "__block")
        first = _number(F.col("__starts"), F.col("__from"), True)
        last = F.when(F.col("__to").isNull(), F.size("__starts")).otherwise(_number(F.col("__starts"), F.col("__to"), False))
        # A version is in every block that its time reaches into.
        blocks = F.when(F.col("__starts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(first, F.greatest(first, last)))
        kept = right.columns
        right = with_starts(right, [f"__key_{i}" for i in range(len(on))])
        right = right.select(*kept, F.explode(blocks).alias("__in_block"))
        same.append(F.col("__block") == F.col("__in_block"))
    joined = left.join(right, reduce(and_, [*same, valid]), how)
    return joined.select(*facts.columns, *[f"{prefix}{c}" for c in shown])
