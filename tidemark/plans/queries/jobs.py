"""The layer jobs, run over the dumps of the orders."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...contracts import ForeignKey, empty_table
from ...operators import quality
from ...scratch import new_folder
from ...sinks.history_store import HistoryStore
from ...sinks.tables import save_table
from .. import jobs
from .gold import MetricView
from .registry import query, table
from .snapshots import (
    DATA_SQL,
    FOLDERS,
    HISTORY_SQL,
    ISLAND_SQL,
    ORDERS,
    SNAPSHOT_SQL,
    STEP_SQL,
    TIMES,
    plain,
    raw,
    snapshot,
    write_landing,
)

CHECKS = [
    quality.is_not_null("o_orderkey"),
    quality.in_list("o_orderstatus", ["O", "F", "P", "N"]),
    quality.in_range("price", 2000, 499000),
    quality.sql_check("odate_valid", "odate IS NULL OR odate >= '1996-01-01'", criticality="warn"),
]
VIEW = MetricView(
    dimensions={"prio": "prio"},
    measures={"n_orders": "COUNT(o_orderkey)", "n_days": "COUNT(DISTINCT odate)", "last_day": "MAX(odate)"},
)
GOLD = jobs.GoldSpec(
    equals={"o_orderstatus": "F"},
    columns=["o_orderkey", "price", "odate", "prio"],
    dedup_by=["prio", "odate"],
    dedup_columns=["prio", "odate", "price"],
    order_by=["o_orderkey"],
    view=VIEW,
)

# The price check, applied to each dump before the history is built.
_VALID = "price BETWEEN 2000 AND 499000"
_VALID_ISLANDS = ISLAND_SQL
# Rows that come twice in a dump.
_TWICE = "coalesce(o_orderstatus = 'N' AND prio = '3-MEDIUM', FALSE)"
for _s in "abc":
    _VALID_ISLANDS = _VALID_ISLANDS.replace(f"AS h FROM raw_{_s})", f"AS h FROM raw_{_s} WHERE {_VALID})")


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[str, jobs.Layers]:
    folder = new_folder(spark, "job")
    return write_landing(spark, sf_dir, f"{folder}/landing"), jobs.Layers(folder, ORDERS.name)


def _run_all(spark: SparkSession, sf_dir: str) -> jobs.Layers:
    landing, layers = _prepared(spark, sf_dir)
    for s, ts in TIMES.items():
        jobs.job_all_layers(spark, ORDERS, CHECKS, GOLD, landing, layers, ts, FOLDERS[s])
    return layers


@query("job_bronze", f"WITH {SNAPSHOT_SQL} SELECT {DATA_SQL} FROM snap_c")
def _job_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, layers = _prepared(spark, sf_dir)
    jobs.job_bronze(spark, ORDERS, landing, layers)
    return plain(spark.read.parquet(layers.bronze))


@query(
    "job_prepare_silver",
    f"""
    WITH {SNAPSHOT_SQL}
    SELECT {DATA_SQL}, 'INSERT' AS __operation, CAST(1 AS INT) AS __version FROM raw_c WHERE {_VALID}""",
)
def _job_prepare_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, layers = _prepared(spark, sf_dir)
    jobs.job_prepare_silver(spark, ORDERS, layers)
    jobs.job_prepare_silver(spark, ORDERS, layers)  # the second time does nothing
    untracked = replace(ORDERS, name="orders_plain", tracked=False)
    plain_layers = jobs.Layers(layers.base, untracked.name)
    jobs.job_prepare_silver(spark, untracked, plain_layers)
    save_table(empty_table(spark, untracked), plain_layers.silver, mode="append")
    jobs.job_bronze(spark, ORDERS, landing, layers)
    jobs.job_silver(spark, ORDERS, CHECKS, layers, TIMES["c"])
    silver = HistoryStore(spark, layers.silver).read_all()
    return plain(silver.select("o_orderkey", "o_orderstatus", "price", "odate", "prio", "__operation", "__version"))


@query(
    "job_silver",
    f"""
    WITH {STEP_SQL.replace("AS h FROM raw_b)", f"AS h FROM raw_b WHERE {_VALID} AND NOT {_TWICE})")
                  .replace("AS h FROM raw_c)", f"AS h FROM raw_c WHERE {_VALID} AND NOT {_TWICE})")},
    rejected AS (
      SELECT *, CASE WHEN {_VALID} THEN 'pk_unique' ELSE 'price_in_range' END AS failed,
             CASE WHEN {_TWICE} THEN 2 ELSE 1 END AS times
      FROM raw_c WHERE NOT {_VALID} OR {_TWICE})
    SELECT {HISTORY_SQL}, CAST(NULL AS VARCHAR) AS failed FROM step_2
    UNION ALL
    SELECT {DATA_SQL}, NULL, NULL, NULL, NULL, NULL, NULL, failed FROM rejected, range(2) AS r(i) WHERE i < times
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(count(*) AS INT), 'orders without lines'
    FROM snap_c WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(sum(times) AS INT), 'quarantined' FROM rejected""",
)
def _job_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "job")
    landing, layers = f"{folder}/landing", jobs.Layers(folder, ORDERS.name)
    key, *others = ORDERS.columns
    contract = replace(ORDERS, columns=(replace(key, fk=ForeignKey("lineitem", "l_orderkey")), *others))
    for s in "bc":
        # Recent orders of medium priority come twice, and every row names its file.
        dump = snapshot(spark, sf_dir, s)
        dump = dump.unionByName(dump.filter("o_orderstatus = 'N' AND prio = '3-MEDIUM'"))
        dump = raw(dump).withColumn("_file_name", F.lit(f"{s}.csv"))
        dump.write.option("header", True).csv(f"{landing}/{FOLDERS[s]}/orders.csv")
        jobs.job_bronze(spark, contract, landing, layers, FOLDERS[s])
        run = jobs.job_silver(
            spark, contract, CHECKS, layers, TIMES[s], parents={"lineitem": table(spark, sf_dir, "lineitem")}
        )
    rejected = spark.read.parquet(layers.quarantine).withColumn("failed", F.array_join("_errors.name", ","))
    silver = HistoryStore(spark, layers.silver).read_all().withColumn("failed", F.lit(None).cast("string"))
    rows = silver.unionByName(rejected.drop("_errors", "_warnings"), allowMissingColumns=True)
    told = [(run.n_orphans["o_orderkey"], "orders without lines"), (run.n_quarantined, "quarantined")]
    counts = spark.createDataFrame(told, "__version int, failed string")
    return plain(rows.unionByName(counts, allowMissingColumns=True)).drop("_file_name")


@query(
    "scd2_guarded",
    f"""
    WITH {STEP_SQL.replace("AS h FROM raw_c)", f"AS h FROM raw_c WHERE NOT {_TWICE})")}
    SELECT {HISTORY_SQL}, CAST(NULL AS VARCHAR) AS refused FROM step_2
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(count(*) * 2 AS INT),
           'RepeatedKey,ValueError,SchemaMismatch'
    FROM raw_c WHERE {_TWICE}""",
)
def _scd2_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump with repeated keys is refused; with those rows set aside it is merged."""
    store = HistoryStore(spark, new_folder(spark, "history"))
    store.merge(snapshot(spark, sf_dir, "b"), ORDERS.primary_keys(), TIMES["b"])
    dump = snapshot(spark, sf_dir, "c")
    dump = dump.unionByName(dump.filter("o_orderstatus = 'N' AND prio = '3-MEDIUM'"))
    unique, repeated = quality.split_unique(dump, ORDERS.primary_keys())
    refused = []
    for rows, ts in ((dump, "c"), (unique, "a"), (unique.withColumn("price", F.col("price").cast("string")), "c")):
        try:
            store.merge(rows, ORDERS.primary_keys(), TIMES[ts])
        except ValueError as error:
            refused.append(type(error).__name__)
    store.merge(unique, ORDERS.primary_keys(), TIMES["c"])
    told = spark.createDataFrame([(repeated.count(), ",".join(refused))], "__version int, refused string")
    history = store.read_all().withColumn("refused", F.lit(None).cast("string"))
    return plain(history.unionByName(told, allowMissingColumns=True))


@query(
    "job_gold",
    f"""
    WITH {_VALID_ISLANDS},
    kept AS (SELECT * FROM hist_c WHERE is_current AND o_orderstatus = 'F')
    SELECT 'main' AS part, o_orderkey, CAST(price AS DOUBLE) AS price, odate, prio FROM kept
    UNION ALL
    SELECT 'dedup', NULL, CAST(price AS DOUBLE), odate, prio FROM (
      SELECT *, row_number() OVER (PARTITION BY prio, odate ORDER BY o_orderkey) AS rn FROM kept) WHERE rn = 1""",
)
def _job_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _run_all(spark, sf_dir)
    main = spark.read.parquet(layers.gold).withColumn("part", F.lit("main"))
    dedup = spark.read.parquet(layers.gold_dedup).withColumn("part", F.lit("dedup"))
    return plain(main.unionByName(dedup, allowMissingColumns=True))


@query(
    "job_all_layers",
    f"""
    WITH {_VALID_ISLANDS}
    SELECT prio, count(o_orderkey) AS n_orders, count(DISTINCT odate) AS n_days, max(odate) AS last_day
    FROM hist_c WHERE is_current AND o_orderstatus = 'F' GROUP BY prio""",
)
def _job_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _run_all(spark, sf_dir)
    return VIEW.query(spark.read.parquet(layers.gold), ["prio"])
