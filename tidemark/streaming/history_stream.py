"""Keep a history up to date from a landing folder as new dumps arrive."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import TableContract
from ..operators import quality
from ..plans.jobs import Layers, job_bronze, job_silver
from ..sinks.history_store import HistoryStore
from ..sources.landing import SNAPSHOT_TS, folder_time

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def late_folders(layers: Layers) -> str:
    """Where the stream lists late folders that it sets aside; read ``<this>/*``."""
    return f"{layers.quarantine}_late"


def start_history_stream(
    spark: SparkSession,
    contract: TableContract,
    landing: str,
    layers: Layers,
    checkpoint: str,
    checks: Sequence[quality.Check] = (),
    processed_time: str | None = None,
    buckets: int | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    splice_late: bool = True,
) -> StreamingQuery:
    """Take every landing folder that is not in the history yet, in time order, then stop.

    The stream follows file names only; a folder is then taken as a whole by the bronze and
    silver jobs, because half a dump would look like deletions.  A dump must therefore land
    complete, by renaming its folder into place.  A batch that is tried again after a failure
    skips the folders already committed.  Rejected rows are kept per folder, and so are the numbers
    of rows without a parent, of the ``parents`` given, in ``<quarantine>_orphans``.

    A folder older than the history takes its place in it (``HistoryStore.splice``), so that folders in any
    order make the same history.  With ``splice_late`` off it is set aside instead: its name and
    time go to ``late_folders``, and later folders are taken as usual.
    """
    files = spark.readStream.format("binaryFile").schema(_FILE).load(f"{landing}/*/{contract.name}.csv")
    folder = F.regexp_extract("path", rf"/([^/]+)/{re.escape(contract.name)}\.csv(/.*)?$", 1)
    landed = files.select(folder.alias("folder"), folder_time(F.col("path"), contract.name).alias(SNAPSHOT_TS))

    def take_folders(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        store = HistoryStore(session, layers.silver, buckets)
        folders = batch.filter(F.col(SNAPSHOT_TS).isNotNull()).distinct().orderBy(SNAPSHOT_TS)
        for name, ts in folders.toLocalIterator():  # one row per dump, a partition at a time
            if store.has_commit(ts):
                continue
            if not splice_late and store.is_late(ts):
                line = session.createDataFrame([(name, str(ts))], "folder string, at string")
                # Each under its own name, so that a batch that is tried again lists it once.
                line.write.mode("overwrite").parquet(f"{late_folders(layers)}/{name}")
                continue
            job_bronze(session, contract, landing, layers, name)
            rejected = f"{layers.quarantine}/{name}"
            found = job_silver(
                session, contract, checks, layers, ts, processed_time, buckets, rejected, parents, splice_late
            )
            if found.n_orphans:
                told = session.createDataFrame(list(found.n_orphans.items()), "column string, n_rows long")
                told.write.mode("overwrite").parquet(f"{layers.quarantine}_orphans/{name}")

    return (
        landed.writeStream.foreachBatch(take_folders)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
