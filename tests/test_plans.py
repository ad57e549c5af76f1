"""Physical plans: pushdown, number of shuffles, and what happens to hot keys."""

import re
from contextlib import contextmanager

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import explore, gold, history as h, quality
from tidemark.operators.metrics import MetricView, time_series_periods
from tidemark.operators.shaping import format_values
from tidemark.plans.queries.snapshots import KEYS, TIMES, snapshot, stacked
from tidemark.scratch import stored


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(autouse=True)
def long_plans(spark):
    with settings(spark, spark__sql__maxMetadataStringLength="10000", spark__sql__debug__maxToStringFields="1000"):
        yield


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan(df)))


def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_history_step_shuffles_each_side_once(spark, sf_dir):
    with settings(spark, **NO_BROADCAST):
        before = h.initial_load(snapshot(spark, sf_dir, "a"), KEYS, TIMES["a"])
        step = h.next_versions(before, snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
        assert shuffles(step) == 2 and plan(step).count("SortMergeJoin") == 1
        # Closed rows are only stacked under the join's output.
        history = h.apply_snapshot(before, snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
        assert shuffles(history) == 2


def test_replay_shuffles_and_sorts_once(spark, sf_dir):
    for times in (list(TIMES.values()), None):
        replayed = h.replay(stacked(spark, sf_dir), KEYS, "snapshot_ts", times=times)
        text = plan(replayed)
        assert shuffles(replayed) == 1 and len(re.findall(r"\bSort \[", text)) == 1
        assert text.count("BroadcastHashJoin") == 1


def test_history_step_reads_what_it_needs(spark, sf_dir):
    before = h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
    before = stored(before, "history")
    new = stored(snapshot(spark, sf_dir, "c"), "snapshot")
    step = h.next_versions(before, new, KEYS, TIMES["c"], tracking=["prio"]).select("o_orderkey", h.OPERATION)
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(step))]
    assert sorted(map(sorted, read)) == [["__operation", "o_orderkey", "prio"], ["o_orderkey", "prio"]]


def test_invariants_scan_a_written_history_few_times(spark, sf_dir):
    history = stored(h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"]), "history")
    with settings(spark, **NO_BROADCAST):
        text = plan(h.invariant_violations(history, KEYS))
    assert text.count("FileScan") <= 8 and text.count("SortMergeJoin") <= 2


def test_text_years_reach_the_scan(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    days = stored(orders(spark, sf_dir).select("o_orderkey", text), "days")
    found = plan(explore.facet_filter(days, explore.FilterSpec(years={"day": [1996, 1998]})))
    assert "GreaterThanOrEqual(day,19960101)" in found and "LessThanOrEqual(day,19981231)" in found


def test_several_granularities_take_one_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = plan(time_series_periods(events, "ts", ["DAY", "MONTH"], {"n": "COUNT(*)"}))
    assert found.count("FileScan") == 1


def test_a_number_is_read_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("x"))
    shown = format_values(lines, {"a": ("x", "mm"), "b": ("x", "number"), "c": ("x", "cc")})
    assert plan(shown).count("RLIKE") == 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spec = explore.FilterSpec(equals={"o_orderstatus": "F"}, ranges={"o_totalprice": [1, 2]})
    text = plan(explore.facet_filter(orders(spark, sf_dir), spec).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_totalprice,1.0)" in text
    by_year = plan(explore.year_range_filter(orders(spark, sf_dir), "o_orderdate", 1997, 1998).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in by_year and "LessThan(o_orderdate" in by_year
    valid, _ = quality.split(orders(spark, sf_dir), [quality.is_not_null("o_custkey")])
    assert "IsNotNull(o_custkey)" in plan(valid.select("o_orderkey"))
    view = MetricView({"s": "o_orderstatus"}, {"n": "COUNT(o_orderkey)"})
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(view.query(orders(spark, sf_dir), ["s"])))
    assert read == ["o_orderkey:bigint,o_orderstatus:string"]
    counted = quality.row_counts(orders(spark, sf_dir), [quality.is_not_null("o_custkey")])
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan(counted)) == ["o_custkey:bigint"]


def test_first_per_group_is_cut_before_the_shuffle(spark, sf_dir):
    text = plan(gold.dedup_first(orders(spark, sf_dir), ["o_orderstatus"], ["o_orderkey"]))
    assert re.search(r"WindowGroupLimit .*Partial", text) and text.index("Final") < text.index("Exchange hashpartitioning")


def test_page_is_a_top_n(spark, sf_dir):
    page = explore.search_page(orders(spark, sf_dir), explore.FilterSpec(equals={"o_orderstatus": "F"}), ["o_orderkey"])
    assert "TakeOrderedAndProject" in plan(page) and "rangepartitioning" not in plan(page)


def hot(spark, n=60_000):
    """Rows of which a third share the key 7, and their keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100)
    left = spark.range(0, n, 1, 4).select(key.alias("k"), F.col("id").alias("v"), F.lit("x" * 40).alias("pad"))
    return left, spark.range(0, n, 2, 4).select((F.col("id") + 100).alias("code"), F.lit("t").alias("text"))


SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "16",
    **NO_BROADCAST,
}


@pytest.mark.parametrize(
    "operation",
    [
        lambda left, right: quality.fk_orphans(left, right, ["k"], ["code"]),
        lambda left, right: gold.enrich_lookup(left, right, {"k": "code"}),
        lambda left, right: h.new_keys(left, right.select(F.col("code").alias("k")), ["k"]),
        lambda left, right: quality.split_unique(left, ["k"])[0],
        lambda left, right: quality.split_unique(left, ["k"])[1],
        lambda left, right: h.merge_histories(
            h.create_history_records(left, "INSERT", F.timestamp_seconds("v")),
            h.create_history_records(left.limit(10), "INSERT", "2030-01-01", 2),
            ["k"],
        ),
    ],
    ids=["fk_orphans", "enrich_lookup", "new_keys", "split_unique", "split_repeated", "merge_histories"],
)
def test_hot_keys_are_split_at_run_time(spark, operation):
    left, right = hot(spark)
    with settings(spark, **SKEW):
        out = operation(left, right)
        n = len(out.collect())
        text = plan(out)
        assert re.search(r"SortMergeJoin\(skew=true\)", text), text[:3000]
    expected = operation(left, right).count()
    assert n == expected


def test_rows_without_a_key_spread_over_tasks(spark):
    """A third of the rows has no key; no task of the join or of the replay gets them all."""
    n = 30_000
    key = F.when(F.col("id") % 3 != 0, F.col("id"))
    rows_ = spark.range(0, n, 1, 4).select(key.alias("k"), F.col("id").alias("v"))
    quiet = {
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
        "spark__sql__shuffle__partitions": "16",
        **NO_BROADCAST,
    }
    with settings(spark, **quiet):
        before = h.initial_load(rows_, ["k"], "2024-01-01")
        step = h.next_versions(before, rows_, ["k"], "2024-02-01")
        twice = rows_.withColumn("ts", F.lit("2024-01-01").cast("timestamp")).unionByName(
            rows_.withColumn("ts", F.lit("2024-02-01").cast("timestamp"))
        )
        replayed = h.replay(twice, ["k"], "ts", times=["2024-01-01", "2024-02-01"])
        for out in (step, replayed):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 20_000 + 2 * 10_000
            assert max(sizes) < 2 * sum(sizes) / 16
        kept = [c for c in step.columns if c != h.PROCESSED]
        assert step.select(kept).exceptAll(replayed.select(kept)).isEmpty()


def test_counting_keys_combines_before_the_shuffle(spark):
    left, _ = hot(spark)
    text = plan(quality.pk_violations(left, ["k"]))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    assert rows(quality.pk_violations(left, ["k"])) == [(7, 20_000)]
