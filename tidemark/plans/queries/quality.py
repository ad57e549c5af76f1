"""Data quality: the split, its counts, and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import quality as q
from .registry import query, table

CHECKS_YAML = """
# Checks of the order lines
- name: ship_date_not_null
  criticality: error
  check:
    function: is_not_null
    arguments:
      column: ship_date

- name: status_known
  criticality: error
  check:
    function: sql_expression
    arguments:
      expression: status IN ('O', 'F')
      msg: status must be O or F

- name: shipped_after_1996
  criticality: warn
  check:
    function: sql_expression
    arguments:
      expression: ship_date IS NULL OR ship_date >= '1996-01-01'
      msg: ship_date should be null or after 1996-01-01
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with gaps: no ship date on large discounts, no or another status on some returns."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.col("l_partkey").alias("part"),
        F.when(F.col("l_discount") < 0.095, F.col("l_shipdate").cast("date")).alias("ship_date"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.065), "X")
        .when((F.col("l_returnflag") != "A") | (F.col("l_tax") < 0.065), F.col("l_linestatus"))
        .alias("status"),
    )


_LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_partkey AS part,
         CASE WHEN l_discount < 0.095 THEN CAST(l_shipdate AS DATE) END AS ship_date,
         CASE WHEN l_returnflag = 'R' AND l_tax > 0.065 THEN 'X'
              WHEN l_returnflag <> 'A' OR l_tax < 0.065 THEN l_linestatus END AS status
  FROM lineitem),
checked AS (
  SELECT *, ship_date IS NULL AS no_date, coalesce(NOT (status IN ('O', 'F')), FALSE) AS bad_status,
         coalesce(ship_date < DATE '1996-01-01', FALSE) AS early
  FROM lines)"""
_LINE_COLUMNS = "l_orderkey, l_linenumber, l_quantity, part, ship_date, status"


@query("dq_load_checks", f"WITH {_LINES} SELECT {_LINE_COLUMNS} FROM checked WHERE NOT no_date AND NOT bad_status")
def _dq_load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.split(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML))[0]


@query("dq_is_not_null", f"WITH {_LINES} SELECT {_LINE_COLUMNS} FROM lines WHERE ship_date IS NOT NULL")
def _dq_is_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.split(_lines(spark, sf_dir), [q.is_not_null("ship_date")])[0]


@query(
    "dq_sql_expression",
    f"""
    WITH {_LINES}
    SELECT l_orderkey, l_linenumber, status, 'status_known: status must be O or F' AS failed
    FROM checked WHERE bad_status""",
)
def _dq_sql_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = q.sql_check("status_known", "status IN ('O', 'F')", "status must be O or F")
    _, rejected = q.split(_lines(spark, sf_dir), [check])
    first = F.element_at(q.ERRORS, 1)
    failed = F.concat_ws(": ", first["name"], first["message"]).alias("failed")
    return rejected.select("l_orderkey", "l_linenumber", "status", failed)


@query(
    "dq_split",
    f"""
    WITH {_LINES}
    SELECT l_orderkey, l_linenumber, ship_date, status,
           concat_ws(',', CASE WHEN no_date THEN 'ship_date_not_null' END, CASE WHEN bad_status THEN 'status_known' END)
             AS errors,
           CASE WHEN early THEN 'shipped_after_1996' ELSE '' END AS warnings,
           TRUE AS quarantined
    FROM checked WHERE no_date OR bad_status
    UNION ALL
    SELECT l_orderkey, l_linenumber, ship_date, status, NULL, NULL, FALSE
    FROM checked WHERE NOT (no_date OR bad_status)""",
)
def _dq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = q.split(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML))
    kept = ["l_orderkey", "l_linenumber", "ship_date", "status"]
    listed = rejected.select(
        *kept,
        F.array_join(f"{q.ERRORS}.name", ",").alias("errors"),
        F.array_join(f"{q.WARNINGS}.name", ",").alias("warnings"),
        F.lit(True).alias("quarantined"),
    )
    return listed.unionByName(
        valid.select(*kept, F.lit(False).alias("quarantined")), allowMissingColumns=True
    )


@query(
    "dq_warnings",
    f"""
    WITH {_LINES}
    SELECT l_orderkey, l_linenumber, ship_date, 'shipped_after_1996' AS warnings
    FROM checked WHERE NOT no_date AND NOT bad_status AND early""",
)
def _dq_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.warnings(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML)).select(
        "l_orderkey", "l_linenumber", "ship_date", F.array_join(f"{q.WARNINGS}.name", ",").alias("warnings")
    )


@query(
    "dq_summary",
    f"""
    WITH {_LINES}
    SELECT 'ship_date_not_null' AS check_name, 'error' AS criticality, count(*) AS n_rows FROM checked WHERE no_date
    UNION ALL SELECT 'status_known', 'error', count(*) FROM checked WHERE bad_status
    UNION ALL SELECT 'shipped_after_1996', 'warn', count(*) FROM checked WHERE early
    UNION ALL SELECT '__quarantined', 'total', count(*) FROM checked WHERE no_date OR bad_status
    UNION ALL SELECT '__rows', 'total', count(*) FROM checked""",
)
def _dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.summary(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML))


@query(
    "row_counts",
    f"""
    WITH {_LINES}
    SELECT count(*) AS n_total, count(*) FILTER (WHERE no_date OR bad_status) AS n_quarantined,
           count(*) FILTER (WHERE NOT (no_date OR bad_status)) AS n_valid
    FROM checked""",
)
def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.row_counts(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML))


@query(
    "dq_key_audit",
    f"""
    WITH {_LINES},
    per_key AS (
      SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE no_date OR bad_status) AS bad
      FROM checked GROUP BY 1, 2)
    SELECT CAST(sum(n) AS BIGINT) AS n_total, CAST(sum(bad) AS BIGINT) AS n_quarantined,
           CAST(sum(n - bad) AS BIGINT) AS n_valid, max(n - bad) AS most_per_key
    FROM per_key""",
)
def _dq_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.key_audit(_lines(spark, sf_dir), q.load_checks(CHECKS_YAML), ["l_orderkey", "l_linenumber"])


@query(
    "dq_enum",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
)
def _dq_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    _, rejected = q.split(orders, [q.in_list("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])])
    return rejected.drop(q.ERRORS, q.WARNINGS)


@query("dq_range", "SELECT p_partkey, p_size FROM part WHERE NOT p_size BETWEEN 5 AND 45")
def _dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return q.split(part, [q.in_range("p_size", 5, 45)])[1].drop(q.ERRORS, q.WARNINGS)


@query(
    "dq_cross_column",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount * 100 AS discount_percent
    FROM lineitem WHERE l_quantity < l_discount * 100""",
)
def _dq_cross_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_discount") * 100).alias("discount_percent")
    )
    check = q.cross_column("l_quantity", ">=", "discount_percent")
    return q.split(lines, [check])[1].drop(q.ERRORS, q.WARNINGS)


@query(
    "dq_not_future",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS odate FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01'""",
)
def _dq_not_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("odate"))
    check = q.not_future("odate", "DATE '2001-01-01'")
    return q.split(orders, [check])[1].drop(q.ERRORS, q.WARNINGS)


@query(
    "dq_pk_unique",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _dq_pk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_split_unique",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS is_unique
    FROM lineitem""",
)
def _dq_split_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    unique, repeated = q.split_unique(lines, ["l_orderkey", "l_linenumber"])
    return unique.withColumn("is_unique", F.lit(True)).unionByName(repeated.withColumn("is_unique", F.lit(False)))


@query(
    "dq_fk_orphans",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def _dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return q.fk_orphans(orders, table(spark, sf_dir, "lineitem"), ["o_orderkey"], ["l_orderkey"])
