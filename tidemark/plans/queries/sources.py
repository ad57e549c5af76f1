"""Sources and sinks: each query writes with a sink where it needs to, and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...contracts import ColumnContract, TableContract
from ...operators import history as h
from ...operators.gold import transform_gold
from ...operators.quality import in_list, split
from ...operators.typing import apply_contract, normalize_columns
from ...scratch import new_folder
from ...sinks.evolved import read_evolved, save_evolved
from ...sinks.history_store import HistoryStore
from ...sinks.tables import save_current_and_history, save_gold, save_named_table, save_quarantine, save_table
from ...sources.files import BAD_LINE, load_limited, scan_parquet, scan_table, split_csv
from ...sources.landing import SNAPSHOT_TS, all_snapshots, latest_snapshot
from .registry import query, table
from .snapshots import (
    DATA_SQL,
    HISTORY_SQL,
    KEYS,
    ORDERS,
    SAME_DAY,
    SNAPSHOT_SQL,
    STEP_SQL,
    TIMES,
    base,
    plain,
    raw,
    snapshot,
    write_landing,
)


@query(
    "scan_csv",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS order_status,
           CAST(price AS VARCHAR) AS total_price, strftime(odate, '%Y%m%d') AS order_date, prio AS order_priority,
           CAST(NULL AS VARCHAR) AS bad_line
    FROM base
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, line
    FROM (SELECT o_orderkey || ',F,1.00,19990101,1-URGENT,extra' AS line FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT o_orderkey || ',F' FROM orders WHERE o_orderstatus = 'O')""",
)
def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "scan_csv")
    raw(base(spark, sf_dir)).write.option("header", True).csv(path)
    # Every pending order once more with a field too many, every open one with too few.
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = F.when(status == "P", F.concat(key, F.lit(",F,1.00,19990101,1-URGENT,extra"))).when(
        status == "O", F.concat(key, F.lit(",F"))
    )
    lines = table(spark, sf_dir, "orders").select(line.alias("line")).filter("line IS NOT NULL")
    header = spark.range(1).select(F.lit("Order Key,Order Status,Total Price,Order Date,Order Priority").alias("line"))
    header.unionByName(lines).coalesce(1).write.text(f"{path}-broken")
    good, bad = split_csv(spark, [path, f"{path}-broken"])
    shown = normalize_columns(good).withColumn("bad_line", F.lit(None).cast("string"))
    return shown.unionByName(bad.select(F.col(BAD_LINE).alias("bad_line")), allowMissingColumns=True)


@query("scan_table", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("tidemark_part")
    return scan_table(spark, "tidemark_part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )


@query("scan_parquet", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("latest_snapshot", f"WITH {SNAPSHOT_SQL} SELECT {DATA_SQL} FROM snap_c")
def _latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = write_landing(spark, sf_dir, new_folder(spark, "landing"), folders=SAME_DAY)
    return plain(apply_contract(latest_snapshot(spark, landing, "orders"), ORDERS))


@query(
    "all_snapshots",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT DATE '1998-01-01' AS landed, {DATA_SQL} FROM snap_a
    UNION ALL SELECT DATE '2000-01-01', {DATA_SQL} FROM snap_b
    UNION ALL SELECT DATE '2002-01-01', {DATA_SQL} FROM snap_c""",
)
def _all_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = write_landing(spark, sf_dir, new_folder(spark, "landing"))
    typed = apply_contract(all_snapshots(spark, landing, "orders"), ORDERS)
    return plain(typed).withColumnRenamed(SNAPSHOT_TS, "landed")


@query("load_silver", f"WITH {SNAPSHOT_SQL} SELECT {HISTORY_SQL} FROM hist_base")
def _load_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = HistoryStore(spark, new_folder(spark, "history"))
    store.merge(base(spark, sf_dir), KEYS, TIMES["c"])
    return plain(store.read_all())


@query(
    "load_limited",
    """
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_type = 'ECONOMY' ORDER BY p_partkey LIMIT 5000""",
)
def _load_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return load_limited(part, {"p_type": "ECONOMY"}, ["p_partkey"], 5000)


@query("save_table", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal FROM customer")
def _save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "customer")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    save_table(customer.filter("c_acctbal < 0"), path)
    save_table(customer, path, schema=customer.schema)
    return scan_parquet(spark, path)


@query(
    "save_named_table",
    "SELECT c_custkey, c_name, c_mktsegment, 'c_name,c_mktsegment' AS commented FROM customer",
)
def _save_named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tidemark_queries LOCATION '{new_folder(spark, 'catalog')}'")
    name = f"tidemark_queries.customer_{uuid.uuid4().hex}"
    contract = TableContract(
        "customer",
        (
            ColumnContract("key", "c_custkey", "bigint"),
            ColumnContract("name", "c_name", description="What it's called"),
            ColumnContract("segment", "c_mktsegment", description="Market segment"),
        ),
        description="Customers",
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    save_named_table(customer.filter("c_custkey < 0"), name, contract=contract)
    save_named_table(customer, name, mode="append")
    commented = [c.name for c in spark.catalog.listColumns(name) if c.description]
    return scan_table(spark, name).withColumn("commented", F.lit(",".join(commented)))


@query(
    "save_evolved",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus END AS o_orderstatus,
           strftime(CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
                                       WHEN 'O' THEN o_orderdate END, '%Y-%m-%d %H:%M') AS placed,
           CAST(year(o_orderdate) AS BIGINT) AS placed_year,
           CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN NULL ELSE o_totalprice END AS o_totalprice
    FROM orders""",
)
def _save_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders first; open ones bring a column and wider types, the rest another column and lack two."""
    path = new_folder(spark, "evolved")
    orders = table(spark, sf_dir, "orders")
    status, placed, year = F.col("o_orderstatus"), F.col("o_orderdate"), F.year("o_orderdate")
    finished, opened = status.eqNullSafe("F"), status.eqNullSafe("O")
    save_evolved(
        orders.filter(finished).select(
            "o_orderkey", status, placed.cast("date").alias("placed"), year.cast("short").alias("placed_year")
        ),
        path,
    )
    wide = year.cast("bigint").alias("placed_year")
    save_evolved(
        orders.filter(opened).select(
            "o_orderpriority", wide, placed.cast("timestamp_ntz").alias("placed"), status, "o_orderkey"
        ),
        path,
    )
    save_evolved(orders.filter(~finished & ~opened).select("o_totalprice", "o_orderkey", year.alias("placed_year")), path)
    return read_evolved(spark, path).withColumn("placed", F.date_format("placed", "yyyy-MM-dd HH:mm"))


@query("append_history", f"WITH {STEP_SQL} SELECT {HISTORY_SQL} FROM step_2 WHERE NOT is_current")
def _append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = HistoryStore(spark, new_folder(spark, "history"))
    for s in "bc":
        store.merge(snapshot(spark, sf_dir, s), KEYS, TIMES[s])
    return plain(store.read_all().filter(~h.is_open()))


@query(
    "save_quarantine",
    """
    SELECT o_orderkey, o_orderstatus, 'o_orderstatus_in_list' AS failed FROM orders
    WHERE o_orderstatus NOT IN ('O', 'F')""",
)
def _save_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "quarantine")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    _, rejected = split(orders, [in_list("o_orderstatus", ["O", "F"])])
    save_quarantine(rejected, path)
    return scan_parquet(spark, path).select(
        "o_orderkey", "o_orderstatus", F.array_join("_errors.name", ",").alias("failed")
    )


@query(
    "save_current_and_history",
    f"""
    WITH {STEP_SQL}
    SELECT 'history' AS part, {DATA_SQL}, is_current AS __is_current, version AS __version FROM step_2
    UNION ALL
    SELECT 'current', {DATA_SQL}, NULL, NULL FROM step_2 WHERE is_current""",
)
def _save_current_and_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "compared")
    before = h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
    save_current_and_history(h.apply_snapshot(before, snapshot(spark, sf_dir, "c"), KEYS, TIMES["c"]), path)
    kept = ["o_orderkey", "o_orderstatus", "price", "odate", "prio"]
    full = scan_parquet(spark, f"{path}/history").select(F.lit("history").alias("part"), *kept, h.CURRENT, h.VERSION)
    current = scan_parquet(spark, f"{path}/current").select(F.lit("current").alias("part"), *kept)
    return plain(full.unionByName(current, allowMissingColumns=True))


@query(
    "save_gold",
    f"""
    WITH {SNAPSHOT_SQL},
    kept AS (SELECT * FROM base WHERE o_orderstatus = 'O')
    SELECT 'main' AS part, o_orderkey, prio, CAST(price AS DOUBLE) AS price FROM kept
    UNION ALL
    SELECT 'dedup', o_orderkey, prio, CAST(price AS DOUBLE) FROM (
      SELECT *, row_number() OVER (PARTITION BY prio, odate ORDER BY o_orderkey) AS rn FROM kept) WHERE rn = 1""",
)
def _save_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "gold")
    silver = h.initial_load(base(spark, sf_dir), KEYS, TIMES["c"])
    columns = ["o_orderkey", "prio", "price"]
    main, dedup = transform_gold(silver, {"o_orderstatus": "O"}, columns, ["prio", "odate"], columns, KEYS)
    save_gold(main, dedup, f"{path}/main", f"{path}/dedup")
    parts = [scan_parquet(spark, f"{path}/{p}").withColumn("part", F.lit(p)) for p in ("main", "dedup")]
    return plain(parts[0].unionByName(parts[1]))
