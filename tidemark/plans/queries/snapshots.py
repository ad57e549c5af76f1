"""Three dumps of the orders, as an order desk would have written them over the years.

A  1998-01-01  all orders placed so far
B  2000-01-01  urgent pending orders are on hold and left out; high-priority ones cost 10 more
C  2002-01-01  the orders on hold are back, the surcharge is gone, finished orders of 1995 are archived

B and C between them hold every order, so steps from one dump to the next go from B to C; what
works on one table takes ``base``, all orders as they are.  In every dump, orders of the last half year have status N, and orders older than three
years have lost their priority.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...contracts import ColumnContract, TableContract
from .registry import table

TIMES = {"a": "1998-01-01", "b": "2000-01-01", "c": "2002-01-01"}
_RECENT = {"a": "1997-07-01", "b": "1999-07-01", "c": "2001-07-01"}
_AGED = {"a": "1995-01-01", "b": "1997-01-01", "c": "1999-01-01"}

KEYS = ["o_orderkey"]
FOLDERS = {"a": "1998-01-01T9-5", "b": "2000-01-01T0-30", "c": "2002-01-01T10-0"}
# B and C on one day: as text, the older folder would sort last.
SAME_DAY = {**FOLDERS, "b": "2002-01-01T9-45"}

ORDERS = TableContract(
    "orders",
    (
        ColumnContract("Order Key", "o_orderkey", "bigint", nullable=False, pk=True, description="The order's number"),
        ColumnContract("Order Status", "o_orderstatus", "string", description="Pending, open, finished or 'new'"),
        ColumnContract("Total Price", "price", "decimal(18,2)", description="Price of all lines"),
        ColumnContract("Order Date", "odate", "date", description="Day the order was placed"),
        ColumnContract("Order Priority", "prio", "string", description="Priority, if still known"),
    ),
    tracked=True,
    description="Orders of the desk",
)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("odate"),
        F.col("o_orderpriority").alias("prio"),
    )


def snapshot(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    df = base(spark, sf_dir).filter(F.col("odate") < F.lit(TIMES[which]).cast("date"))
    price = F.col("price")
    if which == "b":
        df = df.filter(~((F.col("o_orderstatus") == "P") & (F.col("prio") == "1-URGENT")))
        price = F.when(F.col("prio") == "2-HIGH", price + 10).otherwise(price)
    if which == "c":
        df = df.filter(~((F.col("o_orderstatus") == "F") & (F.col("odate") < F.lit("1996-01-01").cast("date"))))
    recent = F.col("odate") >= F.lit(_RECENT[which]).cast("date")
    aged = F.col("odate") < F.lit(_AGED[which]).cast("date")
    return df.select(
        "o_orderkey",
        F.when(recent, "N").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        price.cast("decimal(18,2)").alias("price"),
        "odate",
        F.when(~aged, F.col("prio")).alias("prio"),
    )


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        snapshot(spark, sf_dir, s).withColumn("snapshot_ts", F.lit(t).cast("timestamp")) for s, t in TIMES.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def raw(df: DataFrame) -> DataFrame:
    """A dump as it would be written to CSV: display names, compact dates."""
    return df.select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("price").alias("Total Price"),
        F.date_format("odate", "yyyyMMdd").alias("Order Date"),
        F.col("prio").alias("Order Priority"),
    )


def write_landing(
    spark: SparkSession, sf_dir: str, base_path: str, which: str = "abc", folders: dict[str, str] = FOLDERS
) -> str:
    for s in which:
        raw(snapshot(spark, sf_dir, s)).write.option("header", True).csv(f"{base_path}/{folders[s]}/orders.csv")
    return base_path


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and validity as dates, which every engine prints alike."""
    shown = {"decimal": "double", "timestamp": "date", "timestamp_ntz": "date"}
    kinds = {f.name: f.dataType.typeName() for f in df.schema if f.name != "__processed_time"}
    return df.select(*[F.col(c).cast(shown[k]).alias(c) if k in shown else F.col(c) for c, k in kinds.items()])


# --- the same dumps in SQL -------------------------------------------------------------

_HASH = (
    "md5(concat_ws('|', coalesce(o_orderstatus, 'NULL'), coalesce(CAST(price AS VARCHAR), 'NULL'), "
    "coalesce(CAST(odate AS VARCHAR), 'NULL'), coalesce(prio, 'NULL')))"
)

SNAPSHOT_SQL = f"""
base AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         CAST(o_orderdate AS DATE) AS odate, o_orderpriority AS prio
  FROM orders),
raw_a AS (
  SELECT o_orderkey, CASE WHEN odate >= DATE '1997-07-01' THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
         price, odate, CASE WHEN odate >= DATE '1995-01-01' THEN prio END AS prio
  FROM base WHERE odate < DATE '1998-01-01'),
raw_b AS (
  SELECT o_orderkey, CASE WHEN odate >= DATE '1999-07-01' THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
         CAST(CASE WHEN prio = '2-HIGH' THEN price + 10 ELSE price END AS DECIMAL(18,2)) AS price, odate,
         CASE WHEN odate >= DATE '1997-01-01' THEN prio END AS prio
  FROM base WHERE odate < DATE '2000-01-01' AND NOT (o_orderstatus = 'P' AND prio = '1-URGENT')),
raw_c AS (
  SELECT o_orderkey, CASE WHEN odate >= DATE '2001-07-01' THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
         price, odate, CASE WHEN odate >= DATE '1999-01-01' THEN prio END AS prio
  FROM base WHERE odate < DATE '2002-01-01' AND NOT (o_orderstatus = 'F' AND odate < DATE '1996-01-01')),
snap_base AS (SELECT *, {_HASH} AS h FROM base),
hist_base AS (
  SELECT o_orderkey, o_orderstatus, price, odate, prio, DATE '2002-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
         TRUE AS is_current, 'INSERT' AS operation, h, 1 AS version
  FROM snap_base),
snap_a AS (SELECT *, {_HASH} AS h FROM raw_a),
snap_b AS (SELECT *, {_HASH} AS h FROM raw_b),
snap_c AS (SELECT *, {_HASH} AS h FROM raw_c)"""

# History after B, and after B and C, one step at a time.
STEP_SQL = f"""{SNAPSHOT_SQL},
step_1 AS (
  SELECT o_orderkey, o_orderstatus, price, odate, prio, DATE '2000-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
         TRUE AS is_current, 'INSERT' AS operation, h, 1 AS version
  FROM snap_b),
step_2 AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.price, o.odate, o.prio, o.valid_from,
         CASE WHEN n.h = o.h THEN NULL ELSE DATE '2002-01-01' END AS valid_to,
         coalesce(n.h = o.h, FALSE) AS is_current,
         CASE WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE o.operation END AS operation, o.h, o.version
  FROM step_1 o LEFT JOIN snap_c n ON n.o_orderkey = o.o_orderkey
  UNION ALL
  SELECT n.o_orderkey, n.o_orderstatus, n.price, n.odate, n.prio, DATE '2002-01-01', NULL, TRUE,
         CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END, n.h, coalesce(o.version, 0) + 1
  FROM snap_c n LEFT JOIN step_1 o ON n.o_orderkey = o.o_orderkey
  WHERE o.o_orderkey IS NULL OR o.h <> n.h)"""

# History after A, B and C as islands over the dumps' numbers, not step by step.
ISLAND_SQL = f"""{SNAPSHOT_SQL},
snaps AS (
  SELECT 1 AS i, * FROM snap_a UNION ALL SELECT 2, * FROM snap_b UNION ALL SELECT 3, * FROM snap_c),
times AS (
  SELECT * FROM (VALUES (1, DATE '1998-01-01'), (2, DATE '2000-01-01'), (3, DATE '2002-01-01')) AS v(i, t)),
seen AS (
  SELECT *, lag(i) OVER k AS before_i, lag(h) OVER k AS before_h
  FROM snaps WINDOW k AS (PARTITION BY o_orderkey ORDER BY i)),
flagged AS (
  SELECT *, before_i IS NULL OR before_i <> i - 1 AS appears,
         before_i IS NULL OR before_i <> i - 1 OR before_h <> h AS starts
  FROM seen),
numbered AS (
  SELECT *, sum(CAST(appears AS INT)) OVER k AS seg, sum(CAST(starts AS INT)) OVER k AS grp
  FROM flagged WINDOW k AS (PARTITION BY o_orderkey ORDER BY i)),
spans AS (
  SELECT o_orderkey, seg, grp, min(o_orderstatus) AS o_orderstatus, min(price) AS price, min(odate) AS odate,
         min(prio) AS prio, min(h) AS h, min(i) AS first_i, max(i) AS last_i
  FROM numbered GROUP BY o_orderkey, seg, grp),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey, seg ORDER BY grp) AS version,
         grp = max(grp) OVER (PARTITION BY o_orderkey, seg) AS last_of_seg
  FROM spans),
hist_c AS (
  SELECT o_orderkey, o_orderstatus, price, odate, prio, f.t AS valid_from, e.t AS valid_to, e.t IS NULL AS is_current,
         CASE WHEN e.t IS NOT NULL AND last_of_seg THEN 'DELETE'
              WHEN version = 1 THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         h, CAST(version AS INT) AS version
  FROM ranked JOIN times f ON f.i = first_i LEFT JOIN times e ON e.i = last_i + 1)"""

DATA_SQL = "o_orderkey, o_orderstatus, CAST(price AS DOUBLE) AS price, odate, prio"
HISTORY_SQL = (
    f"{DATA_SQL}, valid_from AS __valid_from, valid_to AS __valid_to, is_current AS __is_current, "
    "operation AS __operation, h AS __row_hash, version AS __version"
)
