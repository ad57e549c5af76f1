"""A snapshot that arrives after later ones: its place in a history that is already built."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import assert_compatible
from ..functions.hashing import row_hash_of
from ..functions.typing import as_timestamp
from ..scratch import stored
from . import history as h


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = F.raise_error(F.lit(f"a late snapshot needs complete keys: {', '.join(keys)}"))
    return df.withColumns({k: F.coalesce(F.col(k), missing.cast(df.schema[k].dataType)) for k in keys})


def touched_keys(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], ts: datetime | str, compared: Sequence[str]) -> DataFrame:
    """Keys of which the history holds another state at ``ts`` than the snapshot; one join on hashes.

    Columns and types must be the history's, keys complete and unique in the snapshot.
    """
    assert_compatible(snapshot, history.select(*[c for c in history.columns if c not in h.META]).schema)
    own = row_hash_of([F.col(c) for c in compared])
    repeated = F.raise_error(F.lit(f"{h.REPEATED}: a snapshot repeats a key: {', '.join(keys)}")).cast("string")
    # Grouped by the join's keys, so the guard needs no shuffle of its own.
    new = _complete(snapshot, keys).groupBy(*keys)
    new = new.agg(F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(own)).alias("__new"))
    old = _complete(h.as_of(history, ts), keys).select(*keys, F.col(h.HASH).alias("__old"))
    return old.join(new, list(keys), "full").filter(~F.col("__old").eqNullSafe(F.col("__new"))).select(*keys)


def _in_snapshots(rows: DataFrame, data: Sequence[str], times: Column) -> DataFrame:
    """Every version as the rows of the snapshots that it was valid in, with their time as ``__at``."""
    valid = F.filter(times, lambda t: (t >= F.col(h.FROM)) & (F.col(h.TO).isNull() | (t < F.col(h.TO))))
    unknown = F.raise_error(F.lit("a version begins at a time that is not among the snapshots' times")).cast("array<timestamp>")
    valid = F.when(F.array_contains(times, F.col(h.FROM)), valid).otherwise(unknown)
    return rows.select(*data, F.explode(valid).alias("__at"))


def splice(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    ts: datetime | str,
    times: Sequence[datetime | str],
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    processed_time: Column | datetime | str | None = None,
    touched: DataFrame | None = None,
    stored_hash: bool = False,
) -> DataFrame:
    """The history as if the late snapshot of ``ts`` had been applied in its turn.

    ``times`` are those of all snapshots in the history, empty ones as well; without them it would
    be open whether a key that is absent in between was deleted.  Keys whose state at ``ts``
    is the snapshot's keep their versions as they are.  Those of the others are laid out by snapshot
    and replayed with the late one among them; a key has at most one such row per time.

    ``ts`` may also lie before or after all others.  It must not be one of them, columns and types must be
    the history's, keys complete and unique in the snapshot; anything else is an error.  Of
    columns that are not compared a history knows the value at the start of a version only, and so
    does the result.  An empty snapshot ends every version that was valid then.

    Who has the ``touched_keys`` stored already passes them.  ``stored_hash`` trusts the history's
    ``__row_hash`` to be over the same columns; then it is computed for the late rows alone.
    """
    spark = history.sparkSession
    data = [c for c in history.columns if c not in h.META]
    known = F.array(*[as_timestamp(t) for t in times]).cast("array<timestamp>")
    if spark.range(1).select(F.array_contains(known, as_timestamp(ts))).first()[0]:
        raise ValueError(f"the history holds a snapshot of {ts} already")
    compared = h.comparison_columns(data, keys, tracking, exclude)
    if touched is None:
        # Written, so that its true size decides how the three joins with it are done.
        touched = stored(touched_keys(history, snapshot, keys, ts, compared), "touched")
    kept = history.join(touched, list(keys), "left_anti")
    carried = [*data, h.HASH] if stored_hash else data
    before = _in_snapshots(history.join(touched, list(keys), "left_semi"), carried, known)
    late = snapshot.join(touched, list(keys), "left_semi")
    late = (h.row_hash(late, compared) if stored_hash else late).select(*carried, as_timestamp(ts).alias("__at"))
    stacked = before.unionByName(late)
    replayed = h.replay(stacked, keys, "__at", [*times, ts], tracking, exclude, processed_time, stored_hash)
    return kept.unionByName(replayed.select(*history.columns))
