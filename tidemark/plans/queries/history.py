"""Change detection and type 2 history over the three dumps of the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ...operators import history as h
from ...operators.as_of import facts_as_of
from ...operators.late import splice
from ...scratch import new_folder, stored
from ...sinks.history_store import HistoryStore
from ...sinks.tables import save_table
from ...sources.files import scan_parquet
from ...streaming.history_stream import start_history_stream
from ..jobs import Layers, compare_snapshots
from .registry import query, table
from .snapshots import (
    DATA_SQL,
    HISTORY_SQL,
    ISLAND_SQL,
    KEYS,
    ORDERS,
    SNAPSHOT_SQL,
    STEP_SQL,
    TIMES,
    base,
    plain,
    snapshot,
    stacked,
    write_landing,
)


def history_after(spark: SparkSession, sf_dir: str, dumps: str) -> DataFrame:
    """Apply the dumps in turn; a history that took a join is stored before the next one."""
    history = None
    for n, s in enumerate(dumps):
        if n > 1:
            history = stored(history, "history")
        history = h.apply_snapshot(history, snapshot(spark, sf_dir, s), KEYS, TIMES[s])
    return history


@query("row_hash", f"WITH {SNAPSHOT_SQL} SELECT {DATA_SQL}, h AS __row_hash FROM snap_base")
def _row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    return plain(h.row_hash(df, h.comparison_columns(df, KEYS)))


@query(
    "comparison_columns",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT o_orderkey, md5(concat_ws('|', coalesce(o_orderstatus, 'NULL'), coalesce(prio, 'NULL'))) AS __row_hash
    FROM base""",
)
def _comparison_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    tracked = h.comparison_columns(df, KEYS, tracking=["o_orderkey", "o_orderstatus", "price", "prio"], exclude=["price"])
    return h.row_hash(df, tracked).select("o_orderkey", h.HASH)


@query(
    "detect_changes",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
           CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
           CAST(CASE WHEN n.o_orderkey IS NULL THEN o.price ELSE n.price END AS DOUBLE) AS price,
           CASE WHEN n.o_orderkey IS NULL THEN o.odate ELSE n.odate END AS odate,
           CASE WHEN n.o_orderkey IS NULL THEN o.prio ELSE n.prio END AS prio,
           CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END
             AS __operation,
           coalesce(n.h, o.h) AS __row_hash
    FROM snap_c n FULL JOIN snap_b o ON n.o_orderkey = o.o_orderkey
    WHERE n.h IS DISTINCT FROM o.h""",
)
def _detect_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.detect_changes(snapshot(spark, sf_dir, "c"), snapshot(spark, sf_dir, "b"), KEYS))


@query(
    "detect_changes_by_columns",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
           CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END
             AS __operation
    FROM raw_c n FULL JOIN raw_b o ON n.o_orderkey = o.o_orderkey
    WHERE n.o_orderkey IS NULL OR o.o_orderkey IS NULL OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus
       OR n.price IS DISTINCT FROM o.price OR n.odate IS DISTINCT FROM o.odate OR n.prio IS DISTINCT FROM o.prio""",
)
def _detect_changes_by_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = h.detect_changes(
        snapshot(spark, sf_dir, "c"), snapshot(spark, sf_dir, "b"), KEYS, compare="columns"
    )
    return changes.select(*KEYS, h.OPERATION)


@query(
    "add_scd2_columns",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT {DATA_SQL}, DATE '2000-01-01' AS __valid_from, CAST(NULL AS DATE) AS __valid_to, TRUE AS __is_current,
           'UPDATE' AS __operation, CAST(2 AS INT) AS __version
    FROM base""",
)
def _add_scd2_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.add_scd2_columns(base(spark, sf_dir), TIMES["b"], version=2, operation=h.UPDATE))


@query("scd2_initial_load", f"WITH {SNAPSHOT_SQL} SELECT {HISTORY_SQL} FROM hist_base")
def _scd2_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.initial_load(base(spark, sf_dir), KEYS, TIMES["c"]))


@query("scd2_apply", f"WITH {STEP_SQL} SELECT {HISTORY_SQL} FROM step_2")
def _scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(history_after(spark, sf_dir, "bc"))


@query("scd2_update_history", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def scd2_update_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(history_after(spark, sf_dir, "abc"))


@query("scd2_merge", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = HistoryStore(spark, new_folder(spark, "history"))
    for s in "abc":
        store.merge(snapshot(spark, sf_dir, s), KEYS, TIMES[s])
    return plain(store.read_all())


@query("scd2_merge_bucketed", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = HistoryStore(spark, new_folder(spark, "history"), buckets=8)
    for s in "abc":
        store.merge(snapshot(spark, sf_dir, s), KEYS, TIMES[s])
    return plain(store.read_all())


@query(
    "scd2_process",
    f"""
    WITH {STEP_SQL}
    SELECT 'history' AS part, o_orderkey, prio, is_current AS __is_current, operation AS __operation FROM step_2
    UNION ALL SELECT 'current', o_orderkey, prio, NULL, NULL FROM step_2 WHERE is_current""",
)
def _scd2_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = history_after(spark, sf_dir, "b")
    _, full = h.process(snapshot(spark, sf_dir, "c"), before, KEYS, TIMES["c"])
    full = stored(full, "history")  # two outputs, one join
    current = h.current_records(full)
    full = full.select(F.lit("history").alias("part"), "o_orderkey", "prio", h.CURRENT, h.OPERATION)
    return full.unionByName(
        current.select(F.lit("current").alias("part"), "o_orderkey", "prio"), allowMissingColumns=True
    )


@query("current_records", f"WITH {ISLAND_SQL} SELECT {DATA_SQL} FROM hist_c WHERE is_current")
def _current_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.current_records(history_after(spark, sf_dir, "abc")))


@query("full_history", f"WITH {STEP_SQL} SELECT {HISTORY_SQL} FROM step_2")
def _full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = HistoryStore(spark, new_folder(spark, "history"))
    store.append(history_after(spark, sf_dir, "bc"), TIMES["c"], KEYS)
    return plain(store.read_all())


@query(
    "create_history_records",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT o_orderkey, prio, 'DELETE' AS __operation, DATE '2000-01-01' AS __valid_from, DATE '2000-01-01' AS __valid_to,
           FALSE AS __is_current, CAST(3 AS INT) AS __version
    FROM base
    UNION ALL
    SELECT o_orderkey, prio, 'UPDATE', DATE '2000-01-01', NULL, TRUE, 1 FROM base""",
)
def _create_history_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir).select("o_orderkey", "prio")
    gone = h.create_history_records(rows, h.DELETE, TIMES["b"], version=3)
    return plain(gone.unionByName(h.create_history_records(rows, h.UPDATE, TIMES["b"])))


@query(
    "merge_histories",
    f"""
    WITH {SNAPSHOT_SQL},
    both_sides AS (
      SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS prio, DATE '2000-01-01' AS valid_from, 1 AS version
      FROM snap_b
      UNION ALL SELECT o_orderkey, o_orderstatus, prio, DATE '2002-01-01', 2 FROM snap_c
      -- rows that are there twice, of which one is current
      UNION ALL SELECT o_orderkey, o_orderstatus, prio, DATE '2002-01-01', 2 FROM snap_c WHERE prio = '2-HIGH')
    SELECT o_orderkey, o_orderstatus, prio, valid_from AS __valid_from, CAST(NULL AS DATE) AS __valid_to,
           'INSERT' AS __operation, version AS __version,
           row_number() OVER (PARTITION BY o_orderkey ORDER BY valid_from DESC) = 1 AS __is_current
    FROM both_sides""",
)
def _merge_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = snapshot(spark, sf_dir, "b").select("o_orderkey", "o_orderstatus")
    c = snapshot(spark, sf_dir, "c").select("o_orderkey", "o_orderstatus", "prio")
    new = c.unionByName(c.filter("prio = '2-HIGH'"))
    now = TIMES["c"]
    merged = h.merge_histories(
        h.create_history_records(b, h.INSERT, TIMES["b"], 1, now),
        h.create_history_records(new, h.INSERT, TIMES["c"], 2, now),
        KEYS,
    )
    return plain(merged)


@query("compare_snapshots", f"WITH {STEP_SQL} SELECT {HISTORY_SQL} FROM step_2")
def _compare_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "compare")
    history_after(spark, sf_dir, "b").write.parquet(f"{folder}/old")
    # The file name differs in every dump; it is excluded from the comparison.
    snapshot(spark, sf_dir, "c").withColumn("_file_name", F.lit("c.csv")).write.parquet(f"{folder}/new")
    compare_snapshots(spark, f"{folder}/old", f"{folder}/new", KEYS, f"{folder}/out", TIMES["c"])
    return plain(scan_parquet(spark, f"{folder}/out/history").drop("_file_name"))


@query("overwrite_silver", f"WITH {SNAPSHOT_SQL} SELECT {DATA_SQL} FROM base")
def _overwrite_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "silver")
    for rows in (snapshot(spark, sf_dir, "b"), base(spark, sf_dir)):
        save_table(rows, path)
    return plain(scan_parquet(spark, path))


@query(
    "scd2_invariants",
    f"""
    WITH {STEP_SQL},
    broken AS (
      SELECT o_orderkey, valid_from, valid_to, version,
             is_current OR prio = '3-MEDIUM' AS is_current
      FROM step_2
      -- a version that begins before the one before it has ended
      UNION ALL
      SELECT o_orderkey, DATE '2001-01-01', DATE '2003-01-01', 1, FALSE FROM step_2
      WHERE operation = 'DELETE' AND o_orderstatus = 'F')
    SELECT o_orderkey, 'one_current_per_key' AS rule, count(*) AS n_rows
    FROM broken WHERE is_current GROUP BY o_orderkey HAVING count(*) > 1
    UNION ALL
    SELECT o_orderkey, 'current_is_open', count(*)
    FROM broken WHERE is_current AND valid_to IS NOT NULL GROUP BY o_orderkey
    UNION ALL
    SELECT n.o_orderkey, 'follows_previous_version', count(*)
    FROM broken n WHERE n.version > 1 AND NOT EXISTS (
      SELECT 1 FROM broken o
      WHERE o.o_orderkey = n.o_orderkey AND o.version = n.version - 1 AND o.valid_to = n.valid_from)
    GROUP BY n.o_orderkey
    UNION ALL
    SELECT o_orderkey, 'versions_do_not_overlap', count(*) FROM (
      SELECT o_orderkey, valid_from,
             lag(coalesce(valid_to, DATE '9999-12-31')) OVER (
               PARTITION BY o_orderkey ORDER BY valid_from, valid_to NULLS LAST, version) AS ended
      FROM broken)
    WHERE valid_from < ended GROUP BY o_orderkey""",
)
def _scd2_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Closed rows of medium priority are marked current, which two rules forbid.
    wrong = h.is_open() | F.coalesce(F.col("prio") == "3-MEDIUM", F.lit(False))
    history = history_after(spark, sf_dir, "bc").withColumn(h.CURRENT, wrong)
    gone = history.filter((F.col(h.OPERATION) == h.DELETE) & (F.col("o_orderstatus") == "F"))
    early = {
        h.FROM: F.lit("2001-01-01").cast("timestamp"),
        h.TO: F.lit("2003-01-01").cast("timestamp"),
        h.CURRENT: F.lit(False),
        h.VERSION: F.lit(1),
    }
    broken = stored(history.unionByName(gone.withColumns(early)), "history")
    return h.invariant_violations(broken, KEYS)


@query(
    "scd2_as_of",
    f"""
    WITH {ISLAND_SQL}
    SELECT {HISTORY_SQL} FROM hist_c
    WHERE valid_from <= DATE '2001-06-15' AND (valid_to IS NULL OR DATE '2001-06-15' < valid_to)""",
)
def _scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.as_of(history_after(spark, sf_dir, "abc"), "2001-06-15"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("shipped")
    )


@query(
    "scd2_as_of_facts",
    f"""
    WITH {ISLAND_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped, o_orderstatus,
           CAST(price AS DOUBLE) AS price, prio, version AS __version, valid_from AS __valid_from
    FROM lineitem LEFT JOIN hist_c
      ON o_orderkey = l_orderkey AND valid_from <= l_shipdate AND (valid_to IS NULL OR l_shipdate < valid_to)""",
)
def _scd2_as_of_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the version of their order on the day they were shipped."""
    history = stored(history_after(spark, sf_dir, "abc"), "history")
    shown = ["o_orderstatus", "price", "prio", h.VERSION, h.FROM]
    return plain(facts_as_of(_lines(spark, sf_dir), history, {"l_orderkey": "o_orderkey"}, "shipped", shown))


@query(
    "scd2_as_of_facts_blocks",
    """
    WITH days AS (
      SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, max(o_orderkey) AS last_order, count(*) AS n_orders
      FROM orders GROUP BY 1, 2),
    versions AS (
      SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to FROM days)
    SELECT o.o_custkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped,
           v.last_order AS was_last_order, v.n_orders AS was_n_orders
    FROM lineitem JOIN orders o ON o_orderkey = l_orderkey
    JOIN versions v ON v.o_custkey = o.o_custkey
      AND v.valid_from <= l_shipdate AND (v.valid_to IS NULL OR l_shipdate < v.valid_to)""",
)
def _scd2_as_of_facts_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order day of a customer is a version, so customers have many; lines meet them in blocks of four."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("timestamp").alias(h.FROM)
    days = orders.groupBy("o_custkey", day).agg(
        F.max("o_orderkey").alias("last_order"), F.count(F.lit(1)).alias("n_orders")
    )
    following = F.lead(h.FROM).over(Window.partitionBy("o_custkey").orderBy(h.FROM))
    versions = stored(days.withColumn(h.TO, following), "versions")
    lines = _lines(spark, sf_dir).join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select("o_custkey", "l_orderkey", "l_linenumber", "shipped")
    return facts_as_of(lines, versions, ["o_custkey"], "shipped", prefix="was_", how="inner", block=4)


@query("scd2_replay", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.replay(stacked(spark, sf_dir), KEYS, "snapshot_ts", times=list(TIMES.values())))


@query("scd2_splice", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump in the middle arrives last."""
    early = stored(history_after(spark, sf_dir, "ac"), "history")
    return plain(splice(early, snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"], [TIMES["a"], TIMES["c"]]))


@query("scd2_stream", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream")
    landing = write_landing(spark, sf_dir, f"{folder}/landing")
    layers = Layers(folder, ORDERS.name)
    start_history_stream(spark, ORDERS, landing, layers, f"{folder}/checkpoint").awaitTermination()
    return plain(HistoryStore(spark, layers.silver).read_all())


@query("scd2_stream_late", f"WITH {ISLAND_SQL} SELECT {HISTORY_SQL} FROM hist_c")
def _scd2_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders land in the order C, A, B; each takes its place."""
    folder = new_folder(spark, "stream")
    layers = Layers(folder, ORDERS.name)
    for which in "cab":
        landing = write_landing(spark, sf_dir, f"{folder}/landing", which)
        start_history_stream(spark, ORDERS, landing, layers, f"{folder}/checkpoint").awaitTermination()
    return plain(HistoryStore(spark, layers.silver).read_all())


@query(
    "new_keys",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT {DATA_SQL} FROM snap_c n WHERE NOT EXISTS (SELECT 1 FROM snap_b o WHERE o.o_orderkey = n.o_orderkey)""",
)
def _new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(h.new_keys(snapshot(spark, sf_dir, "c"), snapshot(spark, sf_dir, "b"), KEYS))


@query(
    "changed_rows",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT {DATA_SQL} FROM snap_c n
    WHERE NOT EXISTS (SELECT 1 FROM snap_b o WHERE o.o_orderkey = n.o_orderkey AND o.h = n.h)""",
)
def _changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = snapshot(spark, sf_dir, "c"), snapshot(spark, sf_dir, "b")
    return plain(h.changed_rows(new, h.detect_changes(new, old, KEYS), KEYS))
