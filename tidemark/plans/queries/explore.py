"""Faceted search, look-ups, and filter states."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import explore as e
from ...operators import filter_state as fs
from ...scratch import new_folder
from ...sinks.tables import save_for_lookup
from .registry import query, table

PART_FILTER = e.FilterSpec(
    in_lists={"p_type": ["ECONOMY", "PROMO", "LARGE"], "p_brand": []},
    ranges={"p_size": [10, 50], "p_retailprice": [900, 1000]},
    defaults={"p_size": [1, 50], "p_retailprice": [900, 1000]},
    open_top={"p_size": 50},
)
ORDER_FILTER = e.FilterSpec(
    equals={"o_orderpriority": "2-HIGH"},
    in_lists={"o_orderstatus": ["O", "F"]},
    ranges={"o_totalprice": [100000, 300000]},
    defaults={"o_totalprice": [0, 500000]},
    years={"odate": [1996, 1999]},
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.when(F.col("o_totalprice") < 450000, compact).otherwise("unknown").alias("odate"),
    )


_ORDERS = """
o AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
         CASE WHEN o_totalprice < 450000 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'unknown' END AS odate
  FROM orders)"""
_MATCHES = f"""
{_ORDERS},
matches AS (
  SELECT * FROM o
  WHERE o_orderpriority = '2-HIGH' AND o_orderstatus IN ('O', 'F') AND o_totalprice BETWEEN 100000 AND 300000
    AND year(try_strptime(odate, '%Y%m%d')) BETWEEN 1996 AND 1999)"""


@query(
    "facet_options",
    """
    SELECT DISTINCT 'p_brand' AS facet, p_brand AS value FROM part
    UNION ALL SELECT DISTINCT 'p_type', p_type FROM part WHERE p_type <> 'PROMO'
    UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part""",
)
def _facet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.facet_options(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"], sentinel="PROMO")


@query("sorted_options", "SELECT DISTINCT c_mktsegment AS value FROM customer WHERE c_mktsegment <> 'BUILDING'")
def _sorted_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.sorted_options(table(spark, sf_dir, "customer"), "c_mktsegment", sentinel="BUILDING")


@query(
    "dependent_options",
    """
    SELECT DISTINCT p_brand, p_name FROM part WHERE trim(p_name) <> '' AND p_name <> 'small ring'""",
)
def _dependent_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.dependent_options(table(spark, sf_dir, "part"), "p_brand", "p_name", sentinel="small ring")


@query(
    "dependent_options_of_one",
    "SELECT DISTINCT p_brand, p_name FROM part WHERE p_brand = 'Brand#7' AND trim(p_name) <> ''",
)
def _dependent_options_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.dependent_options(table(spark, sf_dir, "part"), "p_brand", "p_name", selected="Brand#7")


@query(
    "facet_counts",
    """
    WITH m AS (SELECT * FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'LARGE') AND p_size >= 10)
    SELECT 'p_brand' AS facet, p_brand AS value, count(*) AS n_rows FROM m GROUP BY p_brand
    UNION ALL SELECT 'p_type', p_type, count(*) FROM m GROUP BY p_type""",
)
def _facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.facet_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type"], PART_FILTER)


@query(
    "facet_filter",
    """
    SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE p_type IN ('ECONOMY', 'PROMO', 'LARGE') AND p_size >= 10""",
)
def _facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return e.facet_filter(part, PART_FILTER)


@query(
    "year_range_filter",
    f"""
    WITH {_ORDERS}
    SELECT o_orderkey, odate FROM o WHERE year(try_strptime(odate, '%Y%m%d')) BETWEEN 1997 AND 1998""",
)
def _year_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.year_range_filter(_orders(spark, sf_dir).select("o_orderkey", "odate"), "odate", 1997, 1998)


@query("year_range_filter_dates", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998")
def _year_range_filter_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.year_range_filter(table(spark, sf_dir, "orders"), "o_orderdate", 1997, 1998).select("o_orderkey")


@query(
    "search_page",
    f"""
    WITH {_MATCHES}
    SELECT *, (SELECT count(*) FROM matches) AS n_matches FROM matches ORDER BY o_totalprice, o_orderkey LIMIT 25""",
)
def _search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.search_page(_orders(spark, sf_dir), ORDER_FILTER, ["o_totalprice", "o_orderkey"])


@query(
    "key_lookup",
    """
    SELECT upper(replace(replace(trim(c_name), '-', ''), ' ', '')) AS key, c_custkey FROM customer
    WHERE EXISTS (SELECT 1 FROM supplier WHERE 'CUSTOMER' || substr(s_name, 9) = upper(c_name))""",
)
def _key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.upper("c_name").alias("key"), "c_custkey")
    typed_in = F.concat(F.lit("  cus-tomer "), F.substring("s_name", 9, 20), F.lit(" "))
    return e.key_lookup(customer, "key", table(spark, sf_dir, "supplier").select(typed_in.alias("typed_in")))


@query("key_lookup_single", "SELECT c_custkey, upper(c_name) AS key FROM customer WHERE upper(c_name) = 'CUSTOMER#000000042'")
def _key_lookup_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.upper("c_name").alias("key"))
    return e.key_lookup(customer, "key", " customer-#0000 00042")


@query(
    "key_lookup_clustered",
    """
    SELECT 'N' || o_orderkey AS key, o_orderstatus, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 49)""",
)
def _key_lookup_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of large lines, looked up by typed-in keys in a table laid out by key."""
    name = f"tidemark_lookup_{uuid.uuid4().hex}"
    gold = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("N"), "o_orderkey").alias("key"), "o_orderstatus", "o_totalprice"
    )
    save_for_lookup(gold, name, "key", 8, new_folder(spark, "lookup"))
    large = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49")
    typed_in = large.select(F.concat(F.lit(" n-"), "l_orderkey", F.lit(" ")).alias("typed_in"))
    return e.key_lookup(spark.read.table(name), "key", typed_in)


@query("limit_rows", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id DESC LIMIT 5000")
def _limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return e.limit_rows(events, 5000, [F.desc("event_id")])


@query(
    "random_rows",
    """
    SELECT event_id, user_id, event_type FROM events
    ORDER BY md5(CAST(event_id AS VARCHAR) || '|7'), event_id LIMIT 10""",
)
def _random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return e.random_rows(events, 10, 7, ["event_id"])


# --- filter states, as events might have left them --------------------------------------


def _number(props: str = "props"):
    return F.get_json_object(props, "$.k").cast("int")


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current and suggested filters per event, from its type, user and number."""
    k = F.col("k")
    none = F.array().cast("array<string>")

    def strings(*values):
        return F.array_compact(F.array(*values))

    def ints(low, high):
        return F.array(F.lit(low).cast("int"), high.cast("int"))

    current = F.struct(
        F.when(k < 30, none).otherwise(F.array("event_type")).alias("brands"),
        strings(F.when(k > 10, "m1"), F.when(k > 40, "m2"), F.when(k > 60, "m3"), F.when(k > 80, "m4")).alias("models"),
        F.lit(None).cast("array<string>").alias("vehicle_types"),
        none.alias("colors"),
        ints(500, F.when(k < 50, 8000).otherwise(k * 100)).alias("engine_range"),
        ints(500, F.lit(5000)).alias("weight_range"),
        ints(1, F.when(k < 20, 7).otherwise(5)).alias("seats"),
        ints(2000, F.lit(2020)).alias("year_range"),
    )
    suggested = F.struct(
        F.array("event_type").alias("brands"),
        F.array(F.lit("m4"), F.lit("m3"), F.lit("m2"), F.lit("m1")).alias("models"),
        F.when(k > 70, F.array(F.lit("bus"), F.lit("car"))).alias("vehicle_types"),
        F.lit(None).cast("array<string>").alias("colors"),
        F.lit(None).cast("array<int>").alias("engine_range"),
        ints(500, F.when(k > 90, 5000).otherwise(k * 10)).alias("weight_range"),
        ints(1, F.lit(7)).alias("seats"),
        ints(2000, F.lit(2020)).alias("year_range"),
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type", _number().alias("k"))
    return events.select("event_id", "event_type", "k", current.alias("current"), suggested.alias("suggested"))


_EVENTS = "e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"


@query(
    "active_filter_count",
    f"""
    WITH {_EVENTS}
    SELECT event_id, CAST((k >= 30)::INT + (k > 10)::INT + (k >= 50 AND k * 100 <> 8000)::INT + (k >= 20)::INT AS INT)
             AS n_active
    FROM e""",
)
def _active_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fs.active_filter_count(_states(spark, sf_dir), "current").select("event_id", "n_active")


@query(
    "filter_diff",
    f"""
    WITH {_EVENTS}
    SELECT event_id,
           concat_ws('; ',
             CASE WHEN k < 30 THEN 'Brand: ' || event_type END,
             CASE WHEN k <= 80 THEN 'Models: 4 items selected' END,
             CASE WHEN k > 70 THEN 'Vehicle Types: bus, car' END,
             CASE WHEN k <= 90 AND k * 10 <> 5000 THEN 'Vehicle Weight: 500-' || (k * 10) END,
             CASE WHEN k >= 20 THEN 'Number of Seats: 1-7+' END) AS changes
    FROM e""",
)
def _filter_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fs.filter_diff(_states(spark, sf_dir))
    return changed.select("event_id", F.array_join("changes", "; ").alias("changes"))


@query(
    "parse_reply",
    f"""
    WITH {_EVENTS}
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'Nothing to set for ' || k
                           WHEN 'error' THEN '{{"message": "cut off ' || k
                           WHEN 'view' THEN 'Found {{some}} cars'
                           WHEN 'signup' THEN '{{"message": "open" "filters": ' || k || '}}'
                           ELSE 'I can help you find cars.' END AS message,
           CASE WHEN event_type = 'purchase' THEN 'Brand#' || k || ',other'
                WHEN k < 30 THEN '' ELSE event_type END AS brands,
           CASE WHEN event_type IN ('purchase', 'view') THEN 3 WHEN k < 20 THEN 7 ELSE 5 END AS seats_high,
           CASE WHEN event_type = 'view' THEN 1990 + k ELSE 2000 END AS first_year
    FROM e""",
)
def _parse_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, n = F.col("event_type"), F.col("k").cast("string")
    reply = (
        F.when(kind == "click", F.concat(F.lit("Nothing to set for "), n))
        .when(kind == "error", F.concat(F.lit('{"message": "cut off '), n))
        .when(kind == "signup", F.concat(F.lit('{"message": "open" "filters": '), n, F.lit("}")))
        .when(
            kind == "view",
            F.concat(
                F.lit('Sure:\n{"message": "Found {some} cars", "filters": {"brands": null, "seats": [2, 3], "year_range": ['),
                (F.col("k") + 1990).cast("string"),
                F.lit(", 2020]}}\nAnything else?"),
            ),
        )
        .otherwise(F.concat(F.lit('{"filters": {"brands": ["Brand#'), n, F.lit('", "other"], "seats": [1, 3]}}')))
    )
    return fs.parse_reply(_states(spark, sf_dir).withColumn("reply", reply)).select(
        "event_id",
        "message",
        F.array_join("filters.brands", ",").alias("brands"),
        F.get("filters.seats", F.lit(1)).alias("seats_high"),
        F.get("filters.year_range", F.lit(0)).alias("first_year"),
    )
