"""Change detection between full snapshots, and type 2 history.

A key that has left the snapshot is deleted; a key that comes back starts again at
version 1.  Keys are unique within a snapshot (``quality.split_unique`` sets repeated
ones aside).  A NULL key equals nothing, so every snapshot deletes and inserts it anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import HISTORY_COLUMNS
from ..functions.hashing import row_hash_of, stable_bucket
from ..functions.typing import as_timestamp
from ..scratch import stored

FROM, TO, CURRENT, OPERATION, PROCESSED, HASH, VERSION = HISTORY_COLUMNS
INSERT, UPDATE, DELETE, NO_CHANGE = "INSERT", "UPDATE", "DELETE", "NO_CHANGE"
META = list(HISTORY_COLUMNS)

# What the message of a repeated key begins with.
REPEATED = "REPEATED_KEY"

_NULL_KEY_BUCKETS = 4096


def comparison_columns(
    columns: Sequence[str] | DataFrame,
    keys: Sequence[str],
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> list[str]:
    """Tracked columns, all by default, without excluded ones, keys and history columns."""
    names = columns.columns if isinstance(columns, DataFrame) else list(columns)
    left_out = {*exclude, *keys, *META}
    return [c for c in (tracking or names) if c not in left_out]


def row_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn(HASH, row_hash_of([F.col(c) for c in columns]))


def _now(processed_time: Column | datetime | str | None) -> Column:
    return F.current_timestamp() if processed_time is None else as_timestamp(processed_time)


def _no_time() -> Column:
    return F.lit(None).cast("timestamp")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _bucket_for_null_keys(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """Zero for complete keys.  Rows without a key match nothing, so they may go anywhere.

    ``columns`` only spread them; all of them are read, so give those that are read anyway.
    """
    return F.when(_any_null(keys), stable_bucket([F.col(c) for c in columns], _NULL_KEY_BUCKETS)).otherwise(0)


def _side(
    df: DataFrame, prefix: str, keys: Sequence[str], hashed: Sequence[str], with_hash: bool = True
) -> DataFrame:
    return df.select(
        *[F.col(c).alias(f"{prefix}{c}") for c in df.columns],
        *([row_hash_of([F.col(c) for c in hashed]).alias(f"{prefix}hash")] if with_hash else []),
        _bucket_for_null_keys(keys, [*keys, *hashed]).alias(f"{prefix}bucket"),
        F.lit(True).alias(f"{prefix}here"),
    )


def _full_join(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    hashed: Sequence[str],
    complete_keys: bool = False,
    stored_hash: bool = False,
    keys_unique: bool = False,
) -> DataFrame:
    """One row per key, with ``old_`` and ``new_`` columns side by side.

    Plain columns, not structs, so that columns nobody asks for are pruned on both sides.
    A stored hash travels once.  If equal values also mean equal hashes, the new hash is not computed
    before the join but after it, and only where a compared value differs or there is no old row.
    When no key is NULL, the keys alone decide the partitioning, which a bucketed table
    may already have.
    """
    matched = keys if complete_keys else [*keys, "bucket"]
    same = [F.col(f"old_{c}") == F.col(f"new_{c}") for c in matched]
    late_hash = stored_hash and _equal_hashes(old, new, hashed)
    right = _side(new, "new_", keys, hashed, with_hash=not late_hash)
    if not keys_unique:
        right = _refuse_repeated(right, [f"new_{k}" for k in keys], [f"new_{c}" for c in matched])
    joined = _side(old, "old_", keys, hashed, with_hash=not stored_hash).join(right, same, "full_outer")
    if stored_hash:
        joined = joined.withColumn("old_hash", F.col(f"old_{HASH}"))
    if late_hash:
        alike = [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in hashed]
        both = F.col("old_here") & F.col("new_here")
        fresh = F.when(F.col("new_here"), row_hash_of([F.col(f"new_{c}") for c in hashed]))
        joined = joined.withColumn("new_hash", F.when(reduce(and_, alike, both), F.col("old_hash")).otherwise(fresh))
    return joined


def _equal_hashes(old: DataFrame, new: DataFrame, hashed: Sequence[str]) -> bool:
    """Whether equal values of these columns always have equal texts, and so equal hashes.

    Not so for floats (zero has two texts), for collated text, and for columns of two types.
    """
    before, now = _types(old), _types(new)
    return all(before[c] == now[c] and _one_text(now[c]) for c in hashed)


def _one_text(kind: T.DataType) -> bool:
    plain = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return kind == T.StringType() or isinstance(kind, plain)


def _refuse_repeated(df: DataFrame, keys: Sequence[str], partitioned: Sequence[str]) -> DataFrame:
    """The same rows; the second row of a complete key is an error.

    Rows are numbered within the partitioning and order that the join needs anyway, so there is no
    further shuffle or sort, and a repeated key is met by its second row, not after all of them.
    """
    nth = F.row_number().over(Window.partitionBy(*partitioned).orderBy(*partitioned))
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k.removeprefix('new_')}="), F.col(k).cast("string")) for k in keys])
    error = F.raise_error(F.concat(F.lit(f"{REPEATED}: rows share the key "), shown)).cast("boolean")
    alone = F.when((F.col("__nth") == 1) | _any_null(keys), True).otherwise(error)
    return df.withColumn("__nth", nth).filter(alone).drop("__nth")


def _status(compared: Sequence[str], compare: str) -> Column:
    if compare == "hash":
        differs = F.col("old_hash") != F.col("new_hash")
    elif compare == "columns":
        same = [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in compared]
        differs = ~reduce(and_, same, F.lit(True))
    else:
        raise ValueError(f"compare by 'hash' or 'columns', not {compare!r}")
    return (
        F.when(F.col("old_here").isNull(), INSERT)
        .when(F.col("new_here").isNull(), DELETE)
        .when(differs, UPDATE)
        .otherwise(NO_CHANGE)
    )


def detect_changes(
    new: DataFrame,
    old: DataFrame | None,
    keys: Sequence[str],
    compared: Sequence[str] | None = None,
    compare: str = "hash",
    all_columns: bool = False,
    keys_unique: bool = False,
) -> DataFrame:
    """Keys, compared columns, ``__operation`` and ``__row_hash`` of every changed key.

    Values are the new ones, NULLs included; a deleted key shows its last ones.  A key that ``new``
    repeats is an error; who knows that there is none passes ``keys_unique``.
    """
    compared = comparison_columns(new, keys) if compared is None else list(compared)
    if old is None:
        return row_hash(new, compared).withColumn(OPERATION, F.lit(INSERT))
    shown = new.columns if all_columns else [*keys, *compared]
    old = _completed(old, _types(new)).select(*shown)
    gone = F.col("new_here").isNull()
    return (
        _full_join(old, new.select(*shown), keys, compared, keys_unique=keys_unique)
        .withColumn(OPERATION, _status(compared, compare))
        .filter(F.col(OPERATION) != NO_CHANGE)
        .select(
            *[F.when(gone, F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in shown],
            F.col(OPERATION),
            F.coalesce("new_hash", "old_hash").alias(HASH),
        )
    )


def new_keys(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key has no row in ``old``."""
    known = old.select(*[F.col(k).alias(f"__known_{i}") for i, k in enumerate(keys)])
    return new.join(known, [F.col(k) == F.col(f"__known_{i}") for i, k in enumerate(keys)], "left_anti")


def changed_rows(new: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key was inserted or updated."""
    touched = changes.filter(F.col(OPERATION).isin(INSERT, UPDATE)).select(
        *[F.col(k).alias(f"__touched_{i}") for i, k in enumerate(keys)]
    )
    return new.join(touched, [F.col(k) == F.col(f"__touched_{i}") for i, k in enumerate(keys)], "left_semi")


def add_scd2_columns(
    df: DataFrame,
    ts: Column | datetime | str,
    is_current: bool = True,
    version: int | None = 1,
    operation: str = INSERT,
    processed_time: Column | datetime | str | None = None,
) -> DataFrame:
    """Open validity from ``ts``; version ``None`` keeps the frame's own."""
    added = {
        FROM: as_timestamp(ts),
        TO: _no_time(),
        CURRENT: F.lit(is_current),
        OPERATION: F.lit(operation),
        PROCESSED: _now(processed_time),
    }
    if version is not None:
        added[VERSION] = F.lit(version)
    return df.withColumns(added)


def create_history_records(
    df: DataFrame,
    operation: str,
    ts: Column | datetime | str,
    version: int = 1,
    processed_time: Column | datetime | str | None = None,
) -> DataFrame:
    """Stamp every row with one operation; deletions are closed at once."""
    deleted = operation == DELETE
    stamped = add_scd2_columns(df, ts, not deleted, version, operation, processed_time)
    return stamped.withColumn(TO, as_timestamp(ts)) if deleted else stamped


def initial_load(
    new: DataFrame,
    keys: Sequence[str],
    ts: Column | datetime | str,
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    processed_time: Column | datetime | str | None = None,
) -> DataFrame:
    hashed = row_hash(new, comparison_columns(new, keys, tracking, exclude))
    stamped = add_scd2_columns(hashed, ts, processed_time=processed_time)
    return stamped.select(*new.columns, *META)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def _completed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Add the columns that only the other side has: they were NULL here."""
    absent = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def next_versions(
    open_rows: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ts: Column | datetime | str,
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    processed_time: Column | datetime | str | None = None,
    compare: str = "hash",
    complete_keys: bool = False,
    stored_hash: bool = False,
    keys_unique: bool = False,
) -> DataFrame:
    """What becomes of the open rows when ``new`` arrives: unchanged, closed and added rows.

    A single full outer join detects, classifies and numbers.  Each joined row then becomes
    one or two history rows, so neither side is read or shuffled twice.

    ``stored_hash`` trusts the open rows' ``__row_hash`` instead of computing it again.  That
    holds as long as the same columns are compared; an unchanged row gets the hash over the
    columns compared now.  A key that ``new`` repeats is an error, unless ``keys_unique`` says that
    there is none.
    """
    compared = comparison_columns(new, keys, tracking, exclude)
    old_types = {c: t for c, t in _types(open_rows).items() if c not in META}
    target = {**old_types, **{c: t for c, t in _types(new).items() if c not in old_types}}
    old, new = _completed(open_rows, target), _completed(new, target)

    status, added, at, now = F.col("__status"), F.col("__added"), as_timestamp(ts), _now(processed_time)
    stays, closes = status == NO_CHANGE, ~added & (status != NO_CHANGE)
    rows = (
        F.when(status == UPDATE, F.array(F.lit(False), F.lit(True)))
        .when(status == INSERT, F.array(F.lit(True)))
        .otherwise(F.array(F.lit(False)))
    )

    def pick(new_value: Column, old_value: Column) -> Column:
        return F.when(added, new_value).otherwise(old_value)

    meta = {
        FROM: pick(at, F.col(f"old_{FROM}")),
        TO: F.when(closes, at).when(~added, F.col(f"old_{TO}")),
        CURRENT: added | stays,
        OPERATION: pick(status, F.when(status == DELETE, DELETE).otherwise(F.col(f"old_{OPERATION}"))),
        PROCESSED: F.when(~added & stays, F.col(f"old_{PROCESSED}")).otherwise(now),
        HASH: pick(F.col("new_hash"), F.when(stays, F.col("old_hash")).otherwise(F.col(f"old_{HASH}"))),
        VERSION: pick(F.coalesce(F.col(f"old_{VERSION}"), F.lit(0)) + 1, F.col(f"old_{VERSION}")),
    }
    return (
        _full_join(old, new, keys, compared, complete_keys, stored_hash, keys_unique)
        .withColumn("__status", _status(compared, compare))
        .withColumn("__added", F.explode(rows))
        .select(
            *[pick(F.col(f"new_{c}").cast(t), F.col(f"old_{c}")).alias(c) for c, t in target.items()],
            *[meta[m].cast(ddl).alias(m) for m, (ddl, _) in HISTORY_COLUMNS.items()],
        )
    )


def _exact_sum(value: Column) -> Column:
    """The sum of longs as a decimal, 0 for none.

    Sums of three pieces of 22 and 21 bits are longs, which cost a fraction of a sum of decimals and hold
    more rows than any table has.
    """
    pieces = [F.shiftright(value, 42), F.shiftright(value, 21).bitwiseAND(F.lit(0x1FFFFF)), value.bitwiseAND(F.lit(0x1FFFFF))]
    high, middle, low = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)") for p in pieces]
    return ((high * F.lit(1 << 21) + middle) * F.lit(1 << 21) + low).cast("decimal(30,0)")


def fingerprint(keys: Sequence[str], row_hash_: Column, where: Column | None = None) -> dict[str, Column]:
    """Aggregates that are equal for equal sets of keys and row hashes, in whatever order.

    A count and two sums of independent 64-bit hashes; partial sums travel, never rows.  Give the row
    hash as a column of its own, or it is computed once per sum.
    """
    counted = F.lit(True) if where is None else where
    mixed = [F.xxhash64(*keys, row_hash_), F.xxhash64(F.lit(7919), row_hash_, *keys)]
    sums = [_exact_sum(F.when(counted, m)) for m in mixed]
    keyless = F.count_if(counted & _any_null(keys)) if keys else F.count_if(counted)
    return {"n_open": F.count_if(counted), "n_keyless": keyless, "print_1": sums[0].cast("string"), "print_2": sums[1].cast("string")}


def is_open() -> Column:
    return F.coalesce(F.col(CURRENT), F.lit(False))


def apply_snapshot(
    history: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    ts: Column | datetime | str,
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    processed_time: Column | datetime | str | None = None,
    compare: str = "hash",
    keys_unique: bool = False,
) -> DataFrame:
    """The full history after ``new``; closed rows pass by without a shuffle.

    The history is read for its open and for its closed rows, so between snapshots keep it
    in a table (``HistoryStore``, ``scratch.stored``); for many snapshots at once see ``replay``.
    A key that ``new`` repeats is an error where there is a history to join; a first load takes the
    rows as they come.
    """
    if history is None:
        return initial_load(new, keys, ts, tracking, exclude, processed_time)
    versions = next_versions(
        history.filter(is_open()), new, keys, ts, tracking, exclude, processed_time, compare, keys_unique=keys_unique
    )
    return versions.unionByName(history.filter(~is_open()), allowMissingColumns=True)


def process(
    new: DataFrame,
    history: DataFrame | None,
    keys: Sequence[str],
    ts: Column | datetime | str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(current rows, full history) after ``new``, at ``ts`` or now."""
    full = apply_snapshot(history, new, keys, F.current_timestamp() if ts is None else ts, **options)
    return current_records(full), full


def current_records(history: DataFrame) -> DataFrame:
    return history.filter(is_open()).drop(*META)


def filter_current(history: DataFrame) -> DataFrame:
    return history.filter(is_open())


def as_of(history: DataFrame, ts: Column | datetime | str) -> DataFrame:
    """Versions valid at ``ts``."""
    at = as_timestamp(ts)
    return history.filter((F.col(FROM) <= at) & (F.col(TO).isNull() | (at < F.col(TO))))


def merge_histories(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stack two histories; per key exactly one row is current, one with the latest ``__valid_from``.

    Ties go to the higher version, then to ``new``, then to the greater values of the other
    columns; of rows that are equal in everything, one.  Equal rows are counted before the shuffle
    and put back at the end.  The latest time of a key, and then the best of the few rows that have
    it, come from aggregates that are joined back, so a key with very many rows is neither sorted
    nor buffered in one task, as a window over it would be.  The counted rows are written first,
    as three steps read them.
    """
    both = existing.withColumn("__side", F.lit(0)).unionByName(
        new.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    columns = [c for c in both.columns if c != "__side"]
    kept = [c for c in columns if c != CURRENT]
    # What was current before does not matter, so rows that differ in that alone are equal.
    both = stored(both.groupBy(*kept, "__side").agg(F.count(F.lit(1)).alias("__copies")), "both")
    by_key = [F.col(k).alias(f"__latest_{i}") for i, k in enumerate(keys)]
    same_key = [F.col(k).eqNullSafe(F.col(f"__latest_{i}")) for i, k in enumerate(keys)]
    latest = both.groupBy(*by_key).agg(F.max(FROM).alias("__latest_from"))
    tied = both.join(latest, [*same_key, F.col(FROM).eqNullSafe(F.col("__latest_from"))], "left_semi")
    # Maps cannot be compared; their text can.
    others = [
        F.col(c).cast("string") if both.schema[c].dataType.typeName() in ("map", "variant") else F.col(c)
        for c in kept
        if c not in (*keys, FROM, VERSION)
    ]
    rank = F.struct(F.col(VERSION), F.col("__side"), *[c.alias(f"c{i}") for i, c in enumerate(others)])
    best = tied.groupBy(*by_key).agg(F.max(rank).alias("__best"), F.max(FROM).alias("__best_from"))
    first = F.col(FROM).eqNullSafe(F.col("__best_from")) & rank.eqNullSafe(F.col("__best"))
    marks = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("__copies")), lambda i: first & (i == 1))
    return both.join(best, same_key, "inner").withColumn(CURRENT, F.explode(marks)).select(*columns)


def _calendar(instants: DataFrame) -> DataFrame:
    """Time and following time of every snapshot, from distinct ``__us``.

    The window runs within calendar years; the last time of a year is followed by the first of the
    next year that has any, from a frame with one row per year.
    """
    placed = instants.withColumn("__year", F.year(F.timestamp_micros("__us")))
    years = placed.groupBy("__year").agg(F.min("__us").alias("__first"))
    years = years.select("__year", F.lead("__first").over(Window.orderBy("__year")).alias("__next_year"))
    following = F.lead("__us").over(Window.partitionBy("__year").orderBy("__us"))
    placed = placed.withColumn("__following", following).join(years, "__year")
    return placed.select(
        F.col("__us").alias("__known_us"),
        F.timestamp_micros("__us").alias("__t"),
        F.coalesce("__following", "__next_year").alias("__next_us"),
    )


def _fail(message: str, kind: str) -> Column:
    return F.raise_error(F.lit(message)).cast(kind)


def replay(
    snapshots: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    times: Sequence[datetime | str] | None = None,
    tracking: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    processed_time: Column | datetime | str | None = None,
    stored_hash: bool = False,
) -> DataFrame:
    """The history of stacked snapshots in one pass, as if each had been applied in turn.

    All windows share one partitioning and ordering: one shuffle and one sort.  A key has at most
    one row per snapshot, so a window group is no longer than the list of times; a repeated key in
    a snapshot is an error, and ``quality.split_unique(snapshots, [*keys, ts_col])`` sets such rows
    aside.  Pass the times if they are known, such as from the landing folders; an empty snapshot
    is only seen that way, and the pass over the time column is saved.  A row whose time is NULL or
    not among the given ones is an error.  ``stored_hash`` trusts the rows' ``__row_hash`` instead of computing it.
    """
    spark = snapshots.sparkSession
    instant = F.unix_micros(F.col(ts_col).cast("timestamp"))
    if times is None:
        instants = snapshots.select(instant.alias("__us")).dropna().distinct()
    else:
        given = spark.createDataFrame([(str(t),) for t in times], "t string")
        instants = given.select(F.unix_micros(F.col("t").cast("timestamp")).alias("__us")).distinct()
    # Written, so that its true size decides how it is joined.
    calendar = stored(_calendar(instants), "calendar")
    data = [c for c in snapshots.columns if c != ts_col and not (stored_hash and c == HASH)]
    compared = comparison_columns(data, keys, tracking, exclude)
    unknown = _fail(f"a row's {ts_col} is NULL or not one of the snapshots' times", "bigint")
    placed = (
        (snapshots if stored_hash else row_hash(snapshots, compared))
        .withColumn("__us", instant)
        .join(calendar, F.col("__us") == F.col("__known_us"), "left")
        .withColumn("__us", F.coalesce("__known_us", unknown))
    )

    # Rows without a key stand alone; their own buckets keep them out of one huge group.
    no_key = _any_null(keys)
    placed = placed.withColumn("__bucket", _bucket_for_null_keys(keys, [*keys, *compared, "__us"]))
    in_order = Window.partitionBy(*keys, "__bucket").orderBy("__us")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, after = F.lag("__us").over(in_order), F.lead("__us").over(in_order)
    repeated = _fail(f"a snapshot repeats a key: {', '.join(keys)}", "boolean")
    followed = F.lag("__next_us").over(in_order)
    marked = (
        placed.withColumns(
            {
                "__appears": F.when(~no_key & (before == F.col("__us")), repeated).otherwise(
                    no_key | before.isNull() | ~followed.eqNullSafe(F.col("__us"))
                ),
                "__before": F.lag(HASH).over(in_order),
                "__last_seen": no_key | after.isNull() | ~after.eqNullSafe(F.col("__next_us")),
                "__next": F.timestamp_micros("__next_us"),
            }
        )
        .withColumn("__starts", F.col("__appears") | (F.col("__before") != F.col(HASH)))
        .withColumn("__starts_so_far", F.count_if("__starts").over(so_far))
        # Only the first row of a version and the last row before a gap matter from here on.
        .filter(F.col("__starts") | F.col("__last_seen"))
    )
    appeared_at = F.max(F.when(F.col("__appears"), F.col("__starts_so_far"))).over(so_far)
    next_starts = F.lead("__starts").over(in_order)
    next_end = F.lead(F.when(F.col("__starts"), F.col("__t")).otherwise(F.col("__next"))).over(in_order)
    closed = F.col(TO).isNotNull()
    return (
        marked.withColumns(
            {
                VERSION: (F.col("__starts_so_far") - appeared_at + 1).cast("int"),
                TO: F.when(F.col("__last_seen"), F.col("__next")).otherwise(next_end),
                "__gone": F.col("__last_seen") | ~next_starts,
            }
        )
        .filter("__starts")
        .select(
            *data,
            F.col("__t").alias(FROM),
            F.col(TO),
            (~closed).alias(CURRENT),
            F.when(closed & F.col("__gone"), DELETE)
            .when(F.col(VERSION) == 1, INSERT)
            .otherwise(UPDATE)
            .alias(OPERATION),
            _now(processed_time).alias(PROCESSED),
            F.col(HASH),
            F.col(VERSION),
        )
    )


def invariant_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a history rule, with the rule's name and number of rows.

    The rules on single rows and the count of open rows are one aggregate per key.  The chain rule
    looks up each version's predecessor by an equality join on key, version and time, so that a key
    with very many rows spreads over tasks.  Overlaps, rows that begin before the one before them
    has ended, need the rows of a key in order.  A key of a sound history has at most one row per
    time, so keys with more rows than there are times in all are reported by their count instead
    (``more_rows_than_times``) and stay out of that window.

    The history is read several times: give a written one (``scratch.stored``).
    """
    facts = history.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], FROM, TO, is_open().alias(CURRENT), VERSION
    )
    key_cols = [f"__k{i}" for i in range(len(keys))]
    row_rule = (
        F.when(F.col(CURRENT) & F.col(TO).isNotNull(), "current_is_open")
        .when(~F.col(CURRENT) & F.col(TO).isNull(), "closed_has_end")
        .when(~F.col(CURRENT) & (F.col(FROM) >= F.col(TO)), "starts_before_end")
        .when(F.col(VERSION).isNull() | (F.col(VERSION) < 1), "version_is_positive")
    )
    rules = ["current_is_open", "closed_has_end", "starts_before_end", "version_is_positive"]
    n_times = facts.agg(F.count_distinct(FROM))
    per_key = (
        facts.withColumn("rule", row_rule)
        .groupBy(*key_cols)
        .agg(
            F.count_if(CURRENT).alias("one_current_per_key"),
            *[F.count_if(F.col("rule") == r).alias(r) for r in rules],
            F.count(F.lit(1)).alias("more_rows_than_times"),
        )
        .withColumn("one_current_per_key", F.when(F.col("one_current_per_key") > 1, F.col("one_current_per_key")))
        .withColumn(
            "more_rows_than_times",
            F.when(F.col("more_rows_than_times") > n_times.scalar(), F.col("more_rows_than_times")),
        )
    )
    named = ["one_current_per_key", *rules, "more_rows_than_times"]
    rows = per_key.unpivot(key_cols, named, "rule", "n_rows").filter("n_rows > 0")
    earlier = facts.select(
        *[F.col(c).alias(f"{c}_e") for c in key_cols],
        (F.col(VERSION) + 1).alias("__follows"),
        F.col(TO).alias("__ended"),
    )
    chain = (
        facts.filter(F.col(VERSION) > 1)
        .join(
            earlier,
            [
                *[F.col(c).eqNullSafe(F.col(f"{c}_e")) for c in key_cols],
                F.col(VERSION) == F.col("__follows"),
                F.col(FROM) == F.col("__ended"),
            ],
            "left_anti",
        )
        .groupBy(*key_cols)
        .agg(F.count("*").alias("n_rows"))
        .withColumn("rule", F.lit("follows_previous_version"))
    )
    hot = per_key.filter("more_rows_than_times > 0").select(*[F.col(c).alias(f"{c}_h") for c in key_cols])
    calm = facts.join(hot, [F.col(c).eqNullSafe(F.col(f"{c}_h")) for c in key_cols], "left_anti")
    complete = reduce(and_, [F.col(c).isNotNull() for c in key_cols])
    in_order = Window.partitionBy(*key_cols).orderBy(FROM, F.col(TO).asc_nulls_last(), VERSION)
    ended = F.lag(F.coalesce(TO, F.lit("9999-12-31").cast("timestamp"))).over(in_order)
    overlap = (
        calm.filter(complete)
        .withColumn("__overlaps", F.col(FROM) < ended)
        .filter("__overlaps")
        .groupBy(*key_cols)
        .agg(F.count("*").alias("n_rows"))
        .withColumn("rule", F.lit("versions_do_not_overlap"))
    )
    found = rows.unionByName(chain).unionByName(overlap)
    return found.select(*[F.col(c).alias(k) for c, k in zip(key_cols, keys)], "rule", "n_rows")


def altered_closed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Closed rows of ``before`` that ``after`` no longer holds; none in a sound history."""
    closed = before.filter(~is_open())
    return closed.exceptAll(after.select(*closed.columns).filter(~is_open()))
