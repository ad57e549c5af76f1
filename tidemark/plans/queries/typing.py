"""Projection, renaming, typing, and simple predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...contracts import ColumnContract, TableContract, empty_table, with_comments
from ...functions.names import snake_case
from ...operators import history as h
from ...operators.gold import business_filter, select_gold
from ...operators.quality import in_list, split, sql_check
from ...operators.typing import (
    apply_contract,
    convert_date_columns,
    filter_key_length,
    normalize_columns,
    transform_bronze,
)
from .registry import query, table
from .snapshots import DATA_SQL, HISTORY_SQL, KEYS, ORDERS, SNAPSHOT_SQL, STEP_SQL, TIMES, base, plain, raw, snapshot

# Raw parts as an extract might spell them: sizes with fractions or units, odd dates.
PARTS = TableContract(
    "parts",
    (
        ColumnContract("Part No.", "part_no", "bigint", nullable=False, pk=True, description="The part's number"),
        ColumnContract("Size (text)", "size", "int", description="Size, 'whole' numbers only"),
        ColumnContract("Listed On", "listed_on", "date", description="First day in the list"),
        ColumnContract("Retail Price", "price", "double", description="Price"),
        ColumnContract("Not Delivered", "not_delivered", "string"),
    ),
)


def _raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    date = F.concat(F.lit("2023"), F.lpad((F.col("p_size") % 14).cast("string"), 2, "0"), F.lit("15"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Part No."),
        F.when(F.col("p_type") == "ECONOMY", F.concat(size, F.lit(".7")))
        .when(F.col("p_type") == "PROMO", F.concat(size, F.lit(" cm")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("-"), size))
        .otherwise(size)
        .alias("Size (text)"),
        date.alias("Listed On"),
        F.col("p_retailprice").cast("string").alias("Retail Price"),
        F.col("p_brand").alias("Brand"),
    )


_RAW_PARTS_SQL = """
raw_parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS part_no,
         CASE p_type WHEN 'ECONOMY' THEN p_size || '.7' WHEN 'PROMO' THEN p_size || ' cm'
                     WHEN 'LARGE' THEN '-' || p_size ELSE CAST(p_size AS VARCHAR) END AS size,
         '2023' || lpad(CAST(p_size % 14 AS VARCHAR), 2, '0') || '15' AS listed_on,
         CAST(p_retailprice AS VARCHAR) AS price, p_brand
  FROM part)"""

_TYPED_PARTS_SQL = f"""
WITH {_RAW_PARTS_SQL}
SELECT CAST(part_no AS BIGINT) AS part_no,
       CASE WHEN regexp_full_match(size, '[+-]?[0-9]+([.][0-9]*)?')
            THEN CAST(trunc(CAST(size AS DOUBLE)) AS INT) END AS size,
       CAST(try_strptime(listed_on, '%Y%m%d') AS DATE) AS listed_on, CAST(price AS DOUBLE) AS price, p_brand AS "Brand"
FROM raw_parts"""


@query(
    "snake_case",
    """
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_quantity AS quantity_pcs,
           l_returnflag AS returned, l_linestatus AS status_o_f, l_shipdate::DATE AS ship_date
    FROM lineitem""",
)
def _snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = {
        "l_orderkey": "Order Key",
        "l_linenumber": "line--number",
        "l_quantity": "Quantity (pcs)",
        "l_returnflag": "_Returned?",
        "l_linestatus": "Status: O/F",
    }
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        *[F.col(c).alias(snake_case(name)) for c, name in messy.items()],
        F.col("l_shipdate").cast("date").alias(snake_case("SHIP   Date")),
    )


@query(
    "normalize_columns",
    """
    SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_no,
           c_acctbal AS account_balance, c_mktsegment AS market_segment
    FROM customer""",
)
def _normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        .toDF("Customer Key", "Customer_Name ", "Nation No.", "Account Balance ($)", "market/segment")
    )


@query("apply_contract", _TYPED_PARTS_SQL)
def _apply_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_contract(_raw_parts(spark, sf_dir), PARTS)


@query("transform_bronze", f"WITH {SNAPSHOT_SQL} SELECT {DATA_SQL} FROM base")
def _transform_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(transform_bronze(raw(base(spark, sf_dir)), ORDERS))


@query(
    "convert_date_columns",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS datum_gereed
    FROM orders""",
)
def _convert_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return convert_date_columns(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            text.cast("int").alias("order_date"),
            F.when(F.col("o_orderstatus") == "P", "pending").otherwise(text).alias("datum_gereed"),
        )
    )


@query(
    "convert_epoch_columns",
    "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events",
)
def _convert_epoch_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return convert_date_columns(table(spark, sf_dir, "events").select("event_id", seconds.alias("event_date")), True)


@query(
    "select_gold",
    f"WITH {SNAPSHOT_SQL} SELECT o_orderkey, prio, CAST(price AS DOUBLE) AS price FROM base",
)
def _select_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = h.initial_load(base(spark, sf_dir), KEYS, TIMES["c"])
    return plain(select_gold(silver, ["o_orderkey", "prio", "price"]))



@query(
    "contract_schema",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS type_name, {nullable} AS nullable, count(\"{name}\") AS n_filled"
        f" FROM ({_TYPED_PARTS_SQL})"
        for name, kind, nullable in [
            ("part_no", "bigint", "FALSE"),
            ("size", "int", "TRUE"),
            ("listed_on", "date", "TRUE"),
            ("price", "double", "TRUE"),
        ]
    ),
)
def _contract_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = apply_contract(_raw_parts(spark, sf_dir), PARTS)
    declared = [f for f in PARTS.schema() if f.name in typed.columns]
    counted = typed.agg(*[F.count(f.name).alias(f.name) for f in declared])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type_name"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f.name).alias("n_filled"),
        )
        for f in declared
    ]
    return counted.select(F.inline(F.array(*rows)))


@query(
    "empty_table",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT {DATA_SQL}, version AS __version, is_current AS __is_current FROM hist_base""",
)
def _empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = empty_table(spark, ORDERS, scd2=True)
    filled = h.apply_snapshot(empty, base(spark, sf_dir), KEYS, TIMES["c"])
    return plain(filled).select("o_orderkey", "o_orderstatus", "price", "odate", "prio", h.VERSION, h.CURRENT)


@query(
    "column_comments",
    f"""
    WITH typed AS ({_TYPED_PARTS_SQL})
    SELECT 'part_no' AS column_name, 'The parts number' AS comment, count(part_no) AS n_filled FROM typed
    UNION ALL SELECT 'size', 'Size, whole numbers only', count(size) FROM typed
    UNION ALL SELECT 'listed_on', 'First day in the list', count(listed_on) FROM typed
    UNION ALL SELECT 'price', 'Price', count(price) FROM typed""",
)
def _column_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    commented = with_comments(apply_contract(_raw_parts(spark, sf_dir), PARTS), PARTS)
    fields = [f for f in commented.schema if f.metadata.get("comment")]
    counted = commented.agg(*[F.count(f.name).alias(f.name) for f in fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.metadata["comment"]).alias("comment"),
            F.col(f.name).alias("n_filled"),
        )
        for f in fields
    ]
    return counted.select(F.inline(F.array(*rows)))


@query(
    "filter_key_length",
    "SELECT p_name AS code, p_partkey FROM part WHERE length(p_name) = 9",
)
def _filter_key_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_name").alias("code"), "p_partkey")
    return filter_key_length(part, 9)


@query("filter_current", f"WITH {STEP_SQL} SELECT {HISTORY_SQL} FROM step_2 WHERE is_current")
def _filter_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
    return plain(h.filter_current(h.apply_snapshot(before, snapshot(spark, sf_dir, "c"), KEYS, TIMES["c"])))


@query(
    "gold_business_filter",
    f"""
    WITH {STEP_SQL}
    SELECT {DATA_SQL} FROM step_2 WHERE is_current AND o_orderstatus = 'O' AND prio = '2-HIGH'""",
)
def _gold_business_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
    full = h.apply_snapshot(before, snapshot(spark, sf_dir, "c"), KEYS, TIMES["c"])
    return plain(business_filter(full, {"o_orderstatus": "O", "prio": "2-HIGH"}).drop(*h.META))


@query(
    "null_checks",
    f"WITH {SNAPSHOT_SQL} SELECT o_orderkey, prio FROM base WHERE prio IS NULL OR prio <> '5-LOW'",
)
def _null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = sql_check("prio_known", "prio IS NULL OR prio <> '5-LOW'")
    return split(base(spark, sf_dir).select("o_orderkey", "prio"), [check])[0]


@query(
    "in_list",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def _in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return split(customer, [in_list("c_mktsegment", ["BUILDING", "MACHINERY"])])[0]


