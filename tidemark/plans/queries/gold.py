"""Grouping: one row per group, metric views, dashboard shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...contracts import ColumnContract, ForeignKey, TableContract
from ...operators.gold import dedup_first, enrich_lookup, union_by_name
from ...operators.metrics import (
    SKETCH_ERROR,
    MetricView,
    Parameter,
    dash_agg,
    distinct_cells,
    distinct_rollup,
    kpi_row,
    param_query,
    period_compare,
    time_series,
    time_series_periods,
)
from ...operators.star import Table, enrich_star
from ...scratch import stored
from .registry import query, table

ORDER_METRICS = MetricView(
    source="orders",
    dimensions={
        "segment": "c_mktsegment",
        "status": "o_orderstatus",
        "priority": "o_orderpriority",
        "order_year": "CAST(year(o_orderdate) AS BIGINT)",
    },
    measures={
        "order_count": "COUNT(o_orderkey)",
        "unique_customers": "COUNT(DISTINCT o_custkey)",
        "unique_days": "COUNT(DISTINCT o_orderdate)",
        "avg_price": "ROUND(AVG(o_totalprice), 2)",
        "revenue": "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)",
    },
)

PART_METRICS_YAML = """
# Metrics of the part list
version: 1.1
source: part
comment: |
  Composition of the part list.
dimensions:
  - name: brand
    expr: p_brand
    comment: Brand
  - name: size_class
    expr: CASE WHEN p_size < 16 THEN 'small' WHEN p_size < 36 THEN 'medium' ELSE 'large' END
measures:
  - name: part_count
    expr: COUNT(p_partkey)
  - name: unique_types
    expr: COUNT(DISTINCT p_type)
  - name: avg_size
    expr: ROUND(AVG(p_size), 4)
"""


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return enrich_lookup(table(spark, sf_dir, "orders"), customer, {"o_custkey": "c_custkey"})


@query(
    "metric_view",
    """
    SELECT c_mktsegment AS segment, year(o_orderdate) AS order_year, count(o_orderkey) AS order_count,
           count(DISTINCT o_custkey) AS unique_customers, count(DISTINCT o_orderdate) AS unique_days,
           round(avg(o_totalprice), 2) AS avg_price,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus <> 'P' GROUP BY 1, 2""",
)
def _metric_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders_with_customer(spark, sf_dir)
    return ORDER_METRICS.query(rows, ["segment", "order_year"], where="o_orderstatus <> 'P'")


@query(
    "metric_view_total",
    """
    SELECT count(o_orderkey) AS order_count, count(DISTINCT o_custkey) AS unique_customers,
           count(DISTINCT o_orderdate) AS unique_days, round(avg(o_totalprice), 2) AS avg_price,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders""",
)
def _metric_view_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDER_METRICS.query(table(spark, sf_dir, "orders"))


@query("metric_count", "SELECT o_orderstatus AS status, count(o_orderkey) AS order_count FROM orders GROUP BY 1")
def _metric_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDER_METRICS.query(table(spark, sf_dir, "orders"), ["status"], ["order_count"])


@query(
    "metric_count_distinct",
    """
    SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS unique_customers,
           count(DISTINCT o_orderdate) AS unique_days
    FROM orders GROUP BY 1""",
)
def _metric_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDER_METRICS.query(table(spark, sf_dir, "orders"), ["priority"], ["unique_customers", "unique_days"])


@query(
    "metric_avg",
    """
    SELECT o_orderstatus AS status, o_orderpriority AS priority, round(avg(o_totalprice), 2) AS avg_price
    FROM orders GROUP BY 1, 2""",
)
def _metric_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDER_METRICS.query(table(spark, sf_dir, "orders"), ["status", "priority"], ["avg_price"])


@query(
    "metric_yaml",
    """
    SELECT p_brand AS brand,
           CASE WHEN p_size < 16 THEN 'small' WHEN p_size < 36 THEN 'medium' ELSE 'large' END AS size_class,
           count(p_partkey) AS part_count, count(DISTINCT p_type) AS unique_types, round(avg(p_size), 4) AS avg_size
    FROM part GROUP BY 1, 2""",
)
def _metric_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MetricView.from_yaml(PART_METRICS_YAML).query(table(spark, sf_dir, "part"), ["brand", "size_class"])


@query(
    "dedup_first",
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size FROM (
      SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def _dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return dedup_first(part, ["p_brand", "p_type"], ["p_partkey"])


@query(
    "dash_agg",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
           round(avg(l_quantity), 4) AS avg_quantity, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers,
           min(l_discount) AS min_discount, max(l_discount) AS max_discount
    FROM lineitem GROUP BY 1, 2""",
)
def _dash_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash_agg(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "total_price": "CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)",
            "avg_quantity": "ROUND(AVG(l_quantity), 4)",
            "n_lines": "COUNT(*)",
            "n_suppliers": "COUNT(DISTINCT l_suppkey)",
            "min_discount": "MIN(l_discount)",
            "max_discount": "MAX(l_discount)",
        },
    )


@query(
    "time_series",
    """
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_returnflag, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
    FROM lineitem GROUP BY 1, 2""",
)
def _time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "n_lines": "COUNT(*)",
        "total_price": "CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)",
    }
    return time_series(table(spark, sf_dir, "lineitem"), "l_shipdate", "MONTH", measures, by=["l_returnflag"])


@query(
    "time_series_periods",
    " UNION ALL ".join(
        f"SELECT '{p}' AS granularity, CAST(date_trunc('{p.lower()}', ts) AS DATE) AS period, "
        "count(DISTINCT user_id) AS n_users FROM events GROUP BY 2"
        for p in ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
    ),
)
def _time_series_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    periods = ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
    return time_series_periods(events, "ts", periods, {"n_users": "COUNT(DISTINCT user_id)"})


@query(
    "kpi_row",
    """
    SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users, max(value) AS top_value,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM events""",
)
def _kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_row(
        table(spark, sf_dir, "events"),
        {
            "n_events": "COUNT(*)",
            "n_users": "COUNT(DISTINCT user_id)",
            "top_value": "MAX(value)",
            "total_value": "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE)",
        },
    )


@query(
    "param_query",
    """
    SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1997-01-01' AND o_totalprice >= 250000.50 AND o_custkey > 10
    GROUP BY 1""",
)
def _param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return param_query(
        spark,
        """
        SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS top_price FROM {orders}
        WHERE o_orderstatus = :status AND o_orderdate >= :since AND o_totalprice >= :at_least AND o_custkey > :after
        GROUP BY o_orderpriority""",
        [
            Parameter("status", "STRING", "O"),
            Parameter("since", "DATE", "1997-01-01"),
            Parameter("at_least", "NUMERIC", "250000.50"),
            Parameter("after", "INTEGER", "10"),
        ],
        {"status": "F"},
        {"orders": table(spark, sf_dir, "orders")},
    )


@query(
    "period_compare",
    """
    WITH series AS (
      SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS period, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT s.user_id, s.period, s.n, b.n AS previous_n, s.n - b.n AS change, s.n / b.n AS ratio
    FROM series s LEFT JOIN series b ON b.user_id = s.user_id AND b.period = s.period - 1""",
)
def _period_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Most users are away on some days, so that many periods follow a gap.
    events = table(spark, sf_dir, "events")
    return period_compare(events, "ts", "DAY", "COUNT(*)", by=["user_id"], name="n")


@query(
    "enrich_lookup",
    """
    SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # More than half of the documents have no label.
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled_id")
    return enrich_lookup(documents, labels, {"doc_id": "labelled_id"})


@query(
    "union_by_name",
    """
    SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def _union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nationkey", "c_acctbal AS acctbal", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS acctbal", "s_name AS name", "s_nationkey AS nationkey"
    )
    return union_by_name(customer, supplier)


def _contract(name: str, columns: dict[str, str], pk: str | None = None, fks: dict[str, ForeignKey] | None = None) -> TableContract:
    fks = fks or {}
    return TableContract(
        name, tuple(ColumnContract(c, c, kind, nullable=c != pk, pk=c == pk, fk=fks.get(c)) for c, kind in columns.items())
    )


# Orders with lines around them, customers behind them, and nations and regions behind these.
STAR = {
    "orders": _contract(
        "orders",
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"},
        "o_orderkey",
        {"o_custkey": ForeignKey("customer", "c_custkey")},
    ),
    "lineitem": _contract(
        "lineitem",
        {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint", "l_quantity": "double"},
        None,
        {"l_orderkey": ForeignKey("orders", "o_orderkey")},
    ),
    "customer": _contract(
        "customer",
        {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"},
        "c_custkey",
        {"c_nationkey": ForeignKey("nation", "n_nationkey")},
    ),
    "nation": _contract(
        "nation",
        {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
        "n_nationkey",
        {"n_regionkey": ForeignKey("region", "r_regionkey")},
    ),
    "region": _contract("region", {"r_regionkey": "int", "r_name": "string"}, "r_regionkey"),
}


@query(
    "enrich_star",
    """
    WITH ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth
      FROM lineitem),
    counted AS (
      SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q FROM lineitem GROUP BY 1)
    SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(n, 0) AS lineitem_n_rows, q AS lineitem_quantity,
           l_linenumber AS lineitem_l_linenumber, l_partkey AS lineitem_l_partkey,
           c_name AS customer_c_name, c_nationkey AS customer_c_nationkey, c_mktsegment AS customer_c_mktsegment,
           n_name AS nation_n_name, n_regionkey AS nation_n_regionkey, r_name AS region_r_name
    FROM orders LEFT JOIN ranked r ON r.l_orderkey = o_orderkey AND nth = 1
    LEFT JOIN counted c ON c.l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _enrich_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Table(
        STAR["lineitem"],
        table(spark, sf_dir, "lineitem"),
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        measures={"quantity": "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)"},
        columns=["l_linenumber", "l_partkey"],
    )
    codes = [Table(STAR[n], table(spark, sf_dir, n)) for n in ("customer", "nation", "region")]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return enrich_star(Table(STAR["orders"], orders), [lines, *codes])


@query(
    "metric_distinct_rollup",
    """
    SELECT 'MONTH' AS granularity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_returnflag,
           count(*) AS n_rows, count(DISTINCT l_partkey) AS unique_parts, count(DISTINCT l_orderkey) AS unique_orders,
           TRUE AS parts_within, TRUE AS orders_within
    FROM lineitem GROUP BY 2, 3
    UNION ALL
    SELECT 'YEAR', CAST(date_trunc('year', l_shipdate) AS DATE), NULL, count(*), count(DISTINCT l_partkey),
           count(DISTINCT l_orderkey), TRUE, TRUE
    FROM lineitem GROUP BY 2
    UNION ALL
    SELECT 'ALL', NULL, NULL, count(*), count(DISTINCT l_partkey), count(DISTINCT l_orderkey), TRUE, TRUE FROM lineitem""",
)
def _metric_distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day cells with sketches, stored, rolled up to months, years and everything, next to the exact counts."""
    lines = table(spark, sf_dir, "lineitem")
    columns = ["l_partkey", "l_orderkey"]
    cells = stored(distinct_cells(lines, "l_shipdate", columns, ["l_returnflag"]), "cells")
    exact = {"unique_parts": "count(DISTINCT l_partkey)", "unique_orders": "count(DISTINCT l_orderkey)"}

    def level(label: str, period: str | None, by: list[str]) -> DataFrame:
        rolled = distinct_rollup(cells, columns, period, by)
        on = ([] if period is None else ["period"]) + by
        counted = time_series(lines, "l_shipdate", period, exact, by) if period else kpi_row(lines, exact)
        if on:
            both = rolled.join(counted, on)
        else:  # one row on either side
            both = rolled.withColumns({name: counted.select(name).scalar() for name in exact})
        for column in ("period", "l_returnflag"):
            if column not in both.columns:
                both = both.withColumn(column, F.lit(None).cast("date" if column == "period" else "string"))
        within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.ceil(F.col(b) * SKETCH_ERROR)
        return both.select(
            F.lit(label).alias("granularity"),
            "period",
            "l_returnflag",
            "n_rows",
            *exact,
            within("approx_l_partkey", "unique_parts").alias("parts_within"),
            within("approx_l_orderkey", "unique_orders").alias("orders_within"),
        )

    months, years = level("MONTH", "MONTH", ["l_returnflag"]), level("YEAR", "YEAR", [])
    return union_by_name(months, years, level("ALL", None, []))
