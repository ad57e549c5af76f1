"""History kept as parquet: closed rows are appended, open rows rewritten per run.

A run writes ``rows/gen=N`` once, partitioned by ``__is_current``, and then adds a line to
``commits``.  Readers take the open rows of the last committed run and the closed rows of
all runs up to it, and list no other folders.  No path is read and overwritten in one job, and a
run that died before its commit line is invisible: the next try overwrites it.  One writer at a time.

Closed rows are never rewritten but for a snapshot that comes late (``splice``): versions closed long ago
may end at another time then.  Such a run holds the whole history, and its commit line, like
all later ones, names it as the first run whose closed rows count.

Each commit line holds a fingerprint of the open rows, counted while they were written.  A snapshot
with the same one changes nothing: its commit line refers to the rows of the run before, and no rows
are read, joined or written.

With ``buckets`` set, runs are written as Spark bucketed tables over the same folders.  The
open rows then join the next snapshot where they are, and only the snapshot is shuffled.  A bucket
is one task's work, so a snapshot of more than ``BUCKET_ROWS`` rows a bucket doubles their number, as often as
need be; that run reads the open rows as plain files, and later ones find them in buckets again.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import SchemaMismatch, TableContract, empty_table
from ..functions.typing import as_timestamp
from ..operators import history as h
from ..operators import late
from ..operators.quality import RepeatedKey, require_unique
from ..scratch import open_together, short_timestamps, stored
from .tables import existing_schema

# The most rows of a snapshot that a bucket is to hold.
BUCKET_ROWS = 500_000

_PRINT = "n_open bigint, n_keyless bigint, print_1 string, print_2 string"
_COMMIT = f"gen int, at timestamp, buckets int, keys array<string>, hashed array<string>, rows_gen int, closed_from int, {_PRINT}"
_PRINT_NAMES = [c.split()[0] for c in _PRINT.split(", ")]


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _rows_gen(commit: Row) -> int:
    """The run whose folder holds the open rows; lines of older stores do not name it."""
    return commit["gen"] if commit["rows_gen"] is None else commit["rows_gen"]


def _closed_from(commit: Row | None) -> int:
    """The first run whose closed rows count."""
    return 0 if commit is None else commit["closed_from"] or 0


@contextmanager
def _repeated_key() -> Iterator[None]:
    """The error of a task that met a repeated key, as the driver's own."""
    try:
        yield
    except Exception as error:
        message = re.search(rf"{h.REPEATED}: (.*?)(?: SQLSTATE|\n|$)", str(error))
        if message is None:
            raise
        raise RepeatedKey(message[1]) from error


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class HistoryStore:
    """The last ``keep`` runs keep their rows: two at least, for readers at work; None keeps all."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, keep: int | None = 2):
        if keep is not None and keep < 2:
            raise ValueError("keep the open rows of at least two runs")
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.least_buckets = buckets
        self.keep = keep

    # --- commits -----------------------------------------------------------------------

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def last_commit(self) -> Row | None:
        """The last complete run: its number, time and bucketing."""
        commits = self._commits()
        return None if commits is None else commits.orderBy(F.desc("gen")).first()

    def has_commit(self, ts: datetime | str) -> bool:
        """Whether the snapshot of that time is already in the history."""
        commits = self._commits()
        return commits is not None and not commits.filter(F.col("at") == as_timestamp(ts)).isEmpty()

    def times(self) -> list[datetime]:
        """The times of all snapshots in the history, in order; one value per snapshot."""
        commits = self._commits()
        if commits is None:
            return []
        return [r["at"] for r in commits.filter(F.col("at").isNotNull()).select("at").distinct().orderBy("at").collect()]

    def is_late(self, ts: datetime | str) -> bool:
        """Whether the history holds a later snapshot."""
        commits = self._commits()
        return commits is not None and not commits.filter(F.col("at") > as_timestamp(ts)).isEmpty()

    def exists(self) -> bool:
        return self.last_commit() is not None

    def _add_commit(
        self,
        gen: int,
        at: Column,
        keys: Sequence[str] = (),
        hashed: Sequence[str] = (),
        rows_gen: int | None = None,
        found: Mapping[str, object] | None = None,
        closed_from: int = 0,
        buckets: int | None = None,
    ) -> None:
        kinds = dict(c.split() for c in _PRINT.split(", "))
        prints = [F.lit((found or {}).get(n)).cast(kind).alias(n) for n, kind in kinds.items()]
        line = self.spark.range(1).select(
            F.lit(gen).alias("gen"),
            at.alias("at"),
            F.lit((self.buckets if buckets is None else buckets) or 0).alias("buckets"),
            _texts(keys).alias("keys"),
            _texts(hashed).alias("hashed"),
            F.lit(gen if rows_gen is None else rows_gen).alias("rows_gen"),
            F.lit(closed_from).alias("closed_from"),
            *prints,
        )
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    # --- reading -----------------------------------------------------------------------

    def _data_fields(self, last: Row) -> list[T.StructField]:
        # Columns are only ever added, so the last run knows them all, unless it was empty.
        newest = existing_schema(self.spark, f"{self.path}/rows/gen={_rows_gen(last)}")
        known = newest or existing_schema(self.spark, f"{self.path}/rows")
        return [f for f in known.fields if f.name not in ("gen", h.CURRENT)]

    def _rows_in(self, folders: str, layout: T.StructType) -> DataFrame:
        """Rows below ``rows`` in the given folders; a run without such rows has no folder."""
        reader = self.spark.read.schema(layout).option("basePath", f"{self.path}/rows")
        try:
            return reader.parquet(f"{self.path}/rows/{folders}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], layout)

    def _read(self, last: Row | None, open_only: bool) -> DataFrame:
        """Open rows of the last run and the closed rows up to it; other open rows are not even listed."""
        if last is None:
            raise LookupError(f"no history at {self.path}")
        fields = self._data_fields(last)
        layout = T.StructType([*fields]).add("gen", T.IntegerType()).add(h.CURRENT, T.StringType())
        data = [f.name for f in fields if f.name not in h.META]

        def shaped(rows: DataFrame, flag: bool) -> DataFrame:
            return rows.withColumn(h.CURRENT, F.lit(flag)).select(*data, *h.META)

        open_rows = shaped(self._rows_in(f"gen={_rows_gen(last)}/{h.CURRENT}=true", layout), True)
        if open_only:
            return open_rows
        closed = self._rows_in(f"gen=*/{h.CURRENT}=false", layout)
        closed = closed.filter(F.col("gen").between(_closed_from(last), last["gen"]))
        return open_rows.unionByName(shaped(closed, False))

    def read_open(self) -> DataFrame:
        return self._read(self.last_commit(), open_only=True)

    def read_all(self) -> DataFrame:
        return self._read(self.last_commit(), open_only=False)

    def current_records(self) -> DataFrame:
        return self.read_open().drop(*h.META)

    def schema(self) -> T.StructType:
        return self.read_all().schema

    def _declare(
        self,
        name: str,
        fields: list[T.StructField],
        keys: Sequence[str],
        buckets: int,
        folder: str,
        partitioned: bool,
    ) -> None:
        """A bucketed external table over a folder; dropping it leaves the files."""
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        clustered = ", ".join(_quoted(k) for k in keys)
        by = f"PARTITIONED BY ({h.CURRENT})" if partitioned else ""
        location = folder.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} "
            f"CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def _open_folder(self, gen: int) -> str:
        return f"{self.path}/rows/gen={gen}/{h.CURRENT}=true"

    def _open_table(self, last: Row) -> str:
        return "tidemark_open_" + hashlib.md5(self._open_folder(_rows_gen(last)).encode()).hexdigest()

    def _read_open_bucketed(self, last: Row) -> DataFrame:
        fields, name = self._data_fields(last), self._open_table(last)
        self._declare(name, fields, last["keys"], last["buckets"], self._open_folder(_rows_gen(last)), partitioned=False)
        data = [f.name for f in fields if f.name not in h.META]
        return self.spark.read.table(name).withColumn(h.CURRENT, F.lit(True)).select(*data, *h.META)

    # --- writing -----------------------------------------------------------------------

    def _commit(
        self,
        rows: DataFrame,
        gen: int,
        ts: datetime | str,
        keys: Sequence[str],
        hashed: Sequence[str] = (),
        in_buckets: bool = False,
        closed_from: int = 0,
    ) -> None:
        folder = f"{self.path}/rows/gen={gen}"
        counted = Observation()
        prints = h.fingerprint(keys, F.col(h.HASH), h.is_open())
        rows = rows.observe(counted, *[c.alias(n) for n, c in prints.items()])
        if self.buckets:
            if not in_buckets:
                # One task per bucket, so that each bucket becomes one file.
                rows = rows.repartition(self.buckets, *keys)
            last_column = [f for f in rows.schema if f.name == h.CURRENT]
            fields = [f for f in rows.schema if f.name != h.CURRENT] + last_column
            name = f"tidemark_write_{uuid.uuid4().hex}"
            self._declare(name, fields, keys, self.buckets, folder, partitioned=True)
            try:
                with open_together(self.spark, 2), short_timestamps(self.spark):
                    rows.select(*[f.name for f in fields]).write.insertInto(name, overwrite=True)
            finally:
                self.spark.sql(f"DROP TABLE {name}")
        else:
            # A dictionary of values that are all different is built in vain.
            distinct = [h.HASH, *keys] if len(keys) == 1 else [h.HASH]
            plain = {f"parquet.enable.dictionary#{c}": "false" for c in distinct}
            with open_together(self.spark, 2), short_timestamps(self.spark):
                rows.write.options(**plain).mode("overwrite").partitionBy(h.CURRENT).parquet(folder)
        self._add_commit(gen, as_timestamp(ts), keys, hashed, found=counted.get, closed_from=closed_from)
        self._free_before(gen)

    def _free_before(self, gen: int) -> None:
        """Give up rows that none of the last ``keep`` runs up to ``gen`` refers to."""
        if self.keep is not None and gen > self.keep:
            kept = self._commits().filter(F.col("gen") > gen - self.keep)
            opened, closed = F.min(F.coalesce("rows_gen", "gen")), F.min(F.coalesce("closed_from", F.lit(0)))
            opened, closed = kept.agg(opened, closed).first()
            self._empty_rows("true", opened - 1)
            if closed:
                self._empty_rows("false", closed - 1)

    def _empty_rows(self, flag: str, last: int) -> None:
        """Give up the open or closed rows of all runs up to ``last``, which later runs hold."""
        layout = T.StructType().add("gen", T.IntegerType()).add(h.CURRENT, T.StringType())
        held = self._rows_in(f"gen=*/{h.CURRENT}={flag}", layout).filter(F.col("gen") <= last)
        for row in held.select("gen").distinct().toLocalIterator():  # usually the one that has just become old
            folder = f"{self.path}/rows/gen={row['gen']}/{h.CURRENT}={flag}"
            schema = existing_schema(self.spark, folder)
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)

    def _comparable(self, last: Row, keys: list[str], hashed: list[str]) -> bool:
        """Whether the last run's fingerprint is over these keys and columns."""
        return last["print_1"] is not None and last["keys"] == list(keys) and last["hashed"] == hashed

    def _unchanged(self, last: Row, found: Mapping[str, object]) -> bool:
        """Whether the open rows have the snapshot's keys and hashes."""
        # Rows without a key are replaced by every snapshot.
        return found["n_keyless"] == 0 and all(found[n] == last[n] for n in _PRINT_NAMES)

    def _commit_unchanged(self, last: Row, gen: int, ts: datetime | str) -> None:
        folder = f"{self.path}/rows/gen={gen}"
        for flag in ("true", "false"):  # what a run that died may have left
            left = existing_schema(self.spark, f"{folder}/{h.CURRENT}={flag}")
            if left is not None:
                self.spark.createDataFrame([], left).write.mode("overwrite").parquet(f"{folder}/{h.CURRENT}={flag}")
        found = {n: last[n] for n in _PRINT_NAMES}
        # The rows stay as the last run laid them out.
        self._add_commit(
            gen, as_timestamp(ts), last["keys"], last["hashed"], _rows_gen(last), found, _closed_from(last), last["buckets"]
        )
        self._free_before(gen)

    def create(self, contract: TableContract) -> bool:
        """An empty typed history, unless there is one."""
        if self.exists():
            return False
        # An empty partitioned write leaves no files, so the schema is written unpartitioned.
        empty = empty_table(self.spark, contract, scd2=True).drop(h.CURRENT)
        for flag in ("true", "false"):
            empty.write.mode("overwrite").parquet(f"{self.path}/rows/gen=0/{h.CURRENT}={flag}")
        self._add_commit(0, F.lit(None).cast("timestamp"))
        return True

    def _fit_buckets(self, last: Row | None, n_new: int | None, new: DataFrame | None = None) -> None:
        """The buckets asked for, doubled until the greater of the open rows and the snapshot fits them."""
        if self.least_buckets:
            n_new = new.count() if n_new is None else n_new
            n_rows = max(n_new, 0 if last is None else last["n_open"] or 0)
            self.buckets = self.least_buckets
            while n_rows > self.buckets * BUCKET_ROWS:
                self.buckets *= 2

    def _only_created(self, last: Row) -> bool:
        """Whether there are no rows to join yet; in buckets, the join also asks for complete keys."""
        return last["gen"] == 0 and not self.buckets

    def _in_layout(self, rows: DataFrame, last: Row) -> DataFrame:
        """The columns of the last run, NULL where absent, then the others, then those of the history."""
        known = {f.name: f.dataType for f in self._data_fields(last) if f.name not in h.META}
        added = [c for c in rows.columns if c not in known and c not in h.META]
        absent = [F.lit(None).cast(t).alias(c) for c, t in known.items() if c not in rows.columns]
        return rows.select("*", *absent).select(*known, *added, *h.META)

    def _same_layout(self, last: Row, keys: list[str]) -> bool:
        return bool(self.buckets) and last["buckets"] == self.buckets and last["keys"] == list(keys)

    def next_rows(
        self,
        last: Row,
        new: DataFrame,
        keys: list[str],
        ts: datetime | str,
        tracking: Sequence[str] | None = None,
        exclude: Sequence[str] = (),
        **options,
    ) -> DataFrame:
        """Rows of the run after ``last``; its hashes are used again if they cover the same columns."""
        hashed = h.comparison_columns(new, keys, tracking, exclude)
        options.update(tracking=tracking, exclude=exclude, stored_hash=last["hashed"] == hashed)
        if not self.buckets:
            return h.next_versions(self._read(last, open_only=True), new, keys, ts, **options)
        # Rows without a key would all meet in one bucket; they belong in quarantine.
        missing = F.raise_error(F.lit(f"a bucketed history needs complete keys: {', '.join(keys)}"))
        new = new.withColumns({k: F.coalesce(F.col(k), missing.cast(new.schema[k].dataType)) for k in keys})
        same = self._same_layout(last, keys)
        if not (same and options.get("keys_unique")):
            new = new.repartition(self.buckets, *keys)  # the partitioning of the join, for the key guard too
        # In another layout the open rows move as well, so that the join gives the new buckets.
        old = self._read_open_bucketed(last) if same else self._read(last, open_only=True).repartition(self.buckets, *keys)
        return h.next_versions(old, new, keys, ts, complete_keys=True, **options)

    def merge(
        self,
        new: DataFrame,
        keys: list[str],
        ts: datetime | str,
        tracking: Sequence[str] | None = None,
        exclude: Sequence[str] = (),
        keys_unique: bool = False,
        n_new: int | None = None,
        **options,
    ) -> int:
        """Apply a snapshot and return the run's number.

        A time before the last run's, a column of another type, and a repeated key are errors.  The
        first load counts keys, per key before the shuffle; later ones find a repeated key within the
        join.  Who knows that there is none passes ``keys_unique``.

        A snapshot that changes nothing only adds a commit line.  It is known by ``history.fingerprint``,
        which takes a scan of keys and compared columns, and is computed only for a snapshot of as many rows
        as are open; pass their number as ``n_new`` where it is known.
        """
        last = self.last_commit()
        self._guard(new, ts, last)
        hashed = h.comparison_columns(new, keys, tracking, exclude)
        if last is None or self._only_created(last):
            if not keys_unique:
                require_unique(new, keys)
            self._fit_buckets(last, n_new, new)
            first = h.initial_load(new, keys, ts, tracking, exclude, options.get("processed_time"))
            self._commit(first if last is None else self._in_layout(first, last), 1, ts, keys, hashed)
            return 1
        gen = last["gen"] + 1
        if options.get("compare", "hash") == "hash" and self._comparable(last, keys, hashed):
            n_new = new.count() if n_new is None else n_new
            if n_new == last["n_open"]:
                prints = h.fingerprint(keys, F.col(h.HASH))
                found = h.row_hash(new, hashed).agg(*[c.alias(n) for n, c in prints.items()]).first().asDict()
                if self._unchanged(last, found):
                    self._commit_unchanged(last, gen, ts)
                    return gen
        self._fit_buckets(last, n_new, new)
        rows = self.next_rows(last, new, keys, ts, tracking, exclude, keys_unique=keys_unique, **options)
        with _repeated_key():
            self._commit(rows, gen, ts, keys, hashed, bool(self.buckets), _closed_from(last))
        if self._same_layout(last, keys):
            # The files stay; only the name for reading them in buckets goes.
            self.spark.sql(f"DROP TABLE IF EXISTS {self._open_table(last)}")
        return gen

    def splice(
        self,
        new: DataFrame,
        keys: list[str],
        ts: datetime | str,
        tracking: Sequence[str] | None = None,
        exclude: Sequence[str] = (),
        processed_time: Column | datetime | str | None = None,
    ) -> int:
        """Apply a snapshot that comes late as if it had come in its turn; return the run's number.

        One join of hashes finds the keys that it changes.  If there are none, only a commit line is
        added; otherwise the versions of those keys are replayed (``late.splice``, whose conditions
        hold) and the history is written once as this run, in one scan.  The rows of earlier runs are
        given up when ``keep`` runs no longer need them.  A history taken over by ``append`` does not
        know all its times; a version that begins at an unknown one is an error.
        """
        last = self.last_commit()
        if last is None or not self.is_late(ts):
            raise ValueError(f"the history at {self.path} holds no snapshot later than {ts}")
        if self.has_commit(ts):
            raise ValueError(f"the history at {self.path} holds a snapshot of {ts} already")
        gen, before = last["gen"] + 1, self._read(last, open_only=False)
        hashed = h.comparison_columns([c for c in before.columns if c not in h.META], keys, tracking, exclude)
        with _repeated_key():
            touched = stored(late.touched_keys(before, new, keys, ts, hashed), "touched")
        if touched.isEmpty():
            self._commit_unchanged(last, gen, ts)
            return gen
        same_columns = last["hashed"] == hashed
        spliced = late.splice(
            before, new, keys, ts, self.times(), tracking, exclude, processed_time, touched, stored_hash=same_columns
        )
        self._fit_buckets(last, 0)
        # Hashes of untouched rows are as they were, over the columns of the run before.
        self._commit(spliced, gen, ts, keys, hashed if same_columns else (), closed_from=gen)
        if self._same_layout(last, keys):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._open_table(last)}")
        return gen

    def _guard(self, new: DataFrame, ts: datetime | str, last: Row | None) -> None:
        if self.is_late(ts):
            raise ValueError(f"a snapshot of {ts} is older than the history at {self.path}")
        if last is not None:
            known = {f.name: f.dataType.simpleString() for f in self._data_fields(last)}
            changed = [
                f"{f.name} from {known[f.name]} to {f.dataType.simpleString()}"
                for f in new.schema
                if f.name in known and f.name not in h.META and known[f.name] != f.dataType.simpleString()
            ]
            if changed:
                raise SchemaMismatch(f"column types changed: {', '.join(changed)}")

    def append(self, history: DataFrame, ts: datetime | str, keys: Sequence[str]) -> int:
        """Take over a history built elsewhere, such as a back-fill, as the first run."""
        if self.exists():
            raise ValueError(f"{self.path} already holds a history")
        self._commit(history, 1, ts, keys)
        return 1
