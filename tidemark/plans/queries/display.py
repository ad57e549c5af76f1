"""Rows and values as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.display import format_key
from ...operators.shaping import categorize, describe_row, display_name, format_values, row_to_text
from .registry import query, table

_PAIRS = """
array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'),
  lambda run: CASE WHEN regexp_full_match(run, '[A-Za-z]{{4,}}')
                   THEN rtrim(regexp_replace(run, '(..)', '\\1-', 'g'), '-') ELSE run END), '')"""


def _dashes(column: str) -> str:
    once = f"regexp_replace({_PAIRS.format(c=column)}, '([A-Za-z])([0-9])', '\\1-\\2', 'g')"
    return f"regexp_replace({once}, '([0-9])([A-Za-z])', '\\1-\\2', 'g')"


@query(
    "format_key",
    f"""
    WITH k AS (
      SELECT p_partkey, CAST(p_size AS VARCHAR) || p_type || p_partkey || substr(p_name, 1, 3) AS key FROM part)
    SELECT p_partkey, key, {_dashes("key")} AS shown FROM k""",
)
def _format_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.col("p_size").cast("string"), "p_type", F.col("p_partkey").cast("string"), F.substring("p_name", 1, 3))
    part = table(spark, sf_dir, "part").select("p_partkey", key.alias("key"))
    return part.withColumn("shown", format_key(F.col("key")))


@query(
    "format_value",
    """
    WITH v AS (
      SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) * 75 AS cc, l_extendedprice AS price,
             strftime(l_shipdate, '%Y%m%d') AS day,
             CASE l_returnflag WHEN 'R' THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.5' END AS size
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN cc < 1000 THEN cc || 'cc' WHEN cc % 1000 = 0 THEN (cc // 1000) || 'L'
                ELSE printf('%.1fL', cc / 1000) END AS engine,
           CAST(CAST(trunc(price) AS BIGINT) AS VARCHAR) || 'kg' AS weight,
           strftime(strptime(day, '%Y%m%d'), '%B %d, %Y') AS shipped,
           CASE WHEN size = 'n/a' THEN size ELSE CAST(CAST(trunc(CAST(size AS DOUBLE)) AS BIGINT) AS VARCHAR) || 'mm' END
             AS width,
           CASE WHEN size = 'n/a' THEN size ELSE CAST(CAST(trunc(CAST(size AS DOUBLE)) AS BIGINT) AS VARCHAR) END
             AS doors,
           CASE WHEN size = 'n/a' THEN size
                ELSE CAST(CAST(round_even(CAST(size AS DOUBLE), 0) AS BIGINT) AS VARCHAR) END AS rounded
    FROM v""",
)
def _format_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5"))
    )
    values = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity").cast("bigint") * 75).cast("string").alias("cc"),
        F.col("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("day"),
        size.alias("size"),
    )
    shown = {
        "engine": ("cc", "cc"),
        "weight": ("price", "kg"),
        "shipped": ("day", "date"),
        "width": ("size", "mm"),
        "doors": ("size", "count"),
        "rounded": ("size", "number"),
    }
    return format_values(values, shown).drop("cc", "price", "day", "size")


_PARTS = """
p AS (
  SELECT p_partkey, CASE WHEN p_size > 5 THEN p_brand END AS brand, CASE WHEN p_size < 45 THEN p_name END AS name,
         CASE WHEN p_type <> 'PROMO' THEN p_type ELSE '' END AS kind,
         CASE WHEN p_size > 10 THEN p_size * 100 END AS cc, p_size - 25 AS seats
  FROM part)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size > 5, F.col("p_brand")).alias("brand"),
        F.when(size < 45, F.col("p_name")).alias("name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).otherwise("").alias("kind"),
        F.when(size > 10, size * 100).alias("cc"),
        (size - 25).alias("seats"),
    )


_LITRES = (
    "CASE WHEN cc < 1000 THEN cc || 'cc' WHEN cc % 1000 = 0 THEN (cc // 1000) || 'L' ELSE printf('%.1fL', cc / 1000) END"
)


@query(
    "describe_row",
    f"""
    WITH {_PARTS}
    SELECT p_partkey, coalesce(brand, 'Unknown') || ' ' || coalesce(name, 'Unknown Model') AS title,
           concat_ws(' • ', 'Type: ' || kind, 'Color: ' || brand, 'Engine: ' || {_LITRES}, 'Seats: ' || seats)
             AS description
    FROM p""",
)
def _describe_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("Type", "kind", "text"), ("Color", "brand", "text"), ("Engine", "cc", "cc"), ("Seats", "seats", "count")]
    return describe_row(_parts(spark, sf_dir), parts).select(
        "p_partkey", display_name(F.col("brand"), F.col("name")).alias("title"), "description"
    )


@query(
    "row_to_text",
    f"""
    WITH {_PARTS},
    t AS (
      SELECT p_partkey,
             concat_ws(chr(10), '- Brand: ' || CASE WHEN brand <> 'Brand#3' THEN brand END,
                       '- Kind: ' || CASE WHEN kind <> '' THEN kind END,
                       '- Seats: ' || CASE WHEN seats <> 0 THEN seats END) AS details
      FROM p)
    SELECT p_partkey, CASE WHEN details = '' THEN 'No detailed information available' ELSE details END AS details
    FROM t""",
)
def _row_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_to_text(_parts(spark, sf_dir), ["brand", "kind", "seats"], sentinel="Brand#3").select(
        "p_partkey", "details"
    )


@query(
    "categorize",
    f"""
    WITH {_PARTS}
    SELECT p_partkey, 'General' AS category, 'Brand' AS label, brand AS value FROM p WHERE brand IS NOT NULL
    UNION ALL SELECT p_partkey, 'General', 'Name', name FROM p WHERE name IS NOT NULL
    UNION ALL SELECT p_partkey, 'Other', 'Kind', kind FROM p WHERE kind <> ''
    UNION ALL SELECT p_partkey, 'Engine/Emissions', 'Cc', {_LITRES} FROM p WHERE cc IS NOT NULL
    UNION ALL SELECT p_partkey, 'General', 'Seats', CAST(seats AS VARCHAR) FROM p""",
)
def _categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = {"General": ["brand", "name", "seats"], "Engine/Emissions": ["cc"]}
    return categorize(_parts(spark, sf_dir), "p_partkey", categories, {"cc": "cc", "seats": "count"})
