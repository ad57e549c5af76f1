"""The layers: landing folder -> bronze -> silver -> gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import TableContract
from ..operators import quality
from ..operators.gold import transform_gold
from ..operators.history import process
from ..operators.metrics import MetricView
from ..operators.typing import transform_bronze
from ..scratch import stored
from ..sinks.history_store import HistoryStore
from ..sinks.tables import (
    create_if_missing,
    declare_table,
    save_current_and_history,
    save_gold,
    save_quarantine,
    save_table,
)
from ..sources.files import BAD_LINE, read_csv, scan_parquet
from ..sources.landing import latest_snapshot_path

# Ingestion columns that never count as a change.
INGESTION_COLUMNS = ("ingestion_timestamp", "_file_name")


@dataclass(frozen=True)
class Layers:
    """Folders of one table in each layer."""

    base: str
    table: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/{self.table}"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/{self.table}"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine/{self.table}"

    @property
    def bad_lines(self) -> str:
        return f"{self.base}/quarantine/{self.table}_lines"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold/{self.table}"

    @property
    def gold_dedup(self) -> str:
        return f"{self.base}/gold/{self.table}_dedup"


def job_bronze(
    spark: SparkSession, contract: TableContract, landing: str, layers: Layers, folder: str | None = None
) -> None:
    """One landing folder, the newest by default, typed and saved.

    Lines that do not fit the header go to ``layers.bad_lines`` instead of being cut or padded.  They
    are counted while the others are written; only if there are any, the files are read once more.
    """
    if folder is None:
        path = latest_snapshot_path(spark, landing, contract.name)
    else:
        path = f"{landing}/{folder}/{contract.name}.csv"
    counted = Observation()
    lines = read_csv(spark, path)
    watched = lines.observe(counted, F.count_if(F.col(BAD_LINE).isNotNull()).alias("n_bad"))
    good = watched.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    save_table(transform_bronze(good, contract), layers.bronze)
    save_quarantine(lines.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE), layers.bad_lines, counted.get["n_bad"])


def job_prepare_silver(
    spark: SparkSession, contract: TableContract, layers: Layers, catalog_table: str | None = None
) -> bool:
    """The empty table, or the empty history of a tracked one; tells whether it was created.

    Its columns carry the contract's comments.  With ``catalog_table``, an untracked table is also
    declared under that name, with the comments of the table and its columns.
    """
    if contract.tracked:
        return HistoryStore(spark, layers.silver).create(contract)
    created = create_if_missing(spark, contract, layers.silver)
    if catalog_table is not None:
        declare_table(spark, contract, layers.silver, catalog_table)
    return created


@dataclass(frozen=True)
class SilverRun:
    """``n_orphans``: rows by foreign-key column without a parent, of the parents given."""

    n_total: int
    n_quarantined: int
    keys_unique: bool
    gen: int | None
    n_orphans: Mapping[str, int] = field(default_factory=dict)


def job_silver(
    spark: SparkSession,
    contract: TableContract,
    checks: Sequence[quality.Check],
    layers: Layers,
    ts: datetime | str,
    processed_time: datetime | str | None = None,
    buckets: int | None = None,
    quarantine: str | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    splice_late: bool = False,
) -> SilverRun:
    """Quality split, then history for tracked tables, or plain overwrite.

    Ingestion columns never count as a change.  Valid rows whose foreign key has no parent, of the
    parent tables given by name, stay valid and are counted by column.

    Bronze is a table, so it is not written again: one aggregate over the checked columns counts valid and
    rejected rows; each side is then read where it is used, by a filter, and rejected rows only if there are
    any.  Only where a tracked table has as many valid rows as its history has open ones, their hashes tell
    whether they are the same.
    Rows that share a key are found by the history's join; only then they are set aside, and
    the join runs again.  With ``splice_late``, a snapshot older than the last one takes its place in the
    history, where it is an error otherwise.
    """
    bronze = spark.read.parquet(layers.bronze)
    keys = contract.primary_keys()
    dealt = quality.counted_split(bronze, checks)
    valid, rejected, n_rejected = dealt.valid, dealt.quarantined, dealt.n_quarantined
    gen, keys_unique = None, True
    if contract.tracked:
        store = HistoryStore(spark, layers.silver, buckets)
        options = {"exclude": INGESTION_COLUMNS, "processed_time": processed_time}
        in_turn = not (splice_late and store.is_late(ts))
        try:
            if in_turn:
                gen = store.merge(valid, keys, ts, n_new=dealt.n_total - n_rejected, **options)
            else:
                gen = store.splice(valid, keys, ts, **options)
        except quality.RepeatedKey:
            keys_unique = False
            valid, repeated = quality.split_unique(valid, keys)
            repeated = stored(repeated, "repeated")
            rejected = rejected.unionByName(quality.annotate_with(repeated, quality.KEY_REPEATED, keys))
            n_rejected += repeated.count()
            if in_turn:
                gen = store.merge(valid, keys, ts, keys_unique=True, **options)
            else:
                gen = store.splice(valid, keys, ts, **options)
    else:
        save_table(valid, layers.silver)
    save_quarantine(rejected, quarantine or layers.quarantine, n_rejected)
    orphans = {c: rows.count() for c, rows in fk_report(valid, contract, parents or {}).items()}
    return SilverRun(dealt.n_total, n_rejected, keys_unique, gen, orphans)


@dataclass(frozen=True)
class GoldSpec:
    equals: Mapping[str, object]
    columns: Sequence[str]
    dedup_by: Sequence[str]
    dedup_columns: Sequence[str]
    order_by: Sequence[str]
    view: MetricView | None = None


def job_gold(spark: SparkSession, spec: GoldSpec, layers: Layers) -> MetricView | None:
    """Filter the open rows, save all of them and the first per group."""
    open_rows = HistoryStore(spark, layers.silver).read_open()
    main, dedup = transform_gold(
        open_rows, spec.equals, spec.columns, spec.dedup_by, spec.dedup_columns, spec.order_by
    )
    save_gold(main, dedup, layers.gold, layers.gold_dedup)
    return spec.view


def job_all_layers(
    spark: SparkSession,
    contract: TableContract,
    checks: Sequence[quality.Check],
    spec: GoldSpec,
    landing: str,
    layers: Layers,
    ts: datetime | str,
    folder: str | None = None,
    processed_time: datetime | str | None = None,
    buckets: int | None = None,
) -> SilverRun:
    job_bronze(spark, contract, landing, layers, folder)
    job_prepare_silver(spark, contract, layers)
    run = job_silver(spark, contract, checks, layers, ts, processed_time, buckets)
    job_gold(spark, spec, layers)
    return run


def compare_snapshots(
    spark: SparkSession,
    old_path: str | None,
    new_path: str,
    keys: Sequence[str],
    out: str,
    ts: datetime | str,
    exclude: Sequence[str] = INGESTION_COLUMNS,
) -> None:
    """Read an earlier history, if any, and a snapshot; write current rows and full history.

    Both outputs read the history written first, so the join runs once.  A repeated key in the
    snapshot is an error.
    """
    new = scan_parquet(spark, new_path)
    quality.require_unique(new, keys)
    _, full = process(new, scan_parquet(spark, old_path), keys, ts, exclude=exclude)
    save_current_and_history(full, out)


def fk_report(child: DataFrame, contract: TableContract, parents: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Orphans per declared foreign key whose parent table is given."""
    return {
        column: quality.fk_orphans(child, parents[fk.table], [column], [fk.column])
        for column, fk in contract.foreign_keys().items()
        if fk.table in parents
    }
