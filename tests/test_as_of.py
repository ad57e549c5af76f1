"""Facts at the version of their time, against a plain look-up, and the plan of the join."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import SKEW, plan, settings

from tidemark.operators import history as h
from tidemark.operators.as_of import block_starts, facts_as_of


def history_of(spark, versions):
    """From (key, from, to or None, value), times in days."""
    df = spark.createDataFrame(versions, "k string, f int, t int, v int")
    day = lambda c: F.timestamp_seconds(F.col(c) * 86400)
    return df.select("k", "v", day("f").alias(h.FROM), day("t").alias(h.TO))


def facts_of(spark, facts):
    df = spark.createDataFrame(facts, "k string, d int, n int")
    return df.withColumn("at", F.timestamp_seconds(F.col("d") * 86400))


def expected(facts, versions, how):
    out = []
    for k, d, n in facts:
        found = [v for key, f, t, v in versions if k == key and d is not None and f <= d and (t is None or d < t)]
        out += [(k, d, n, v) for v in found or ([None] if how == "left" else [])]
    return sorted(out, key=str)


def random_versions(draw, keys, overlapping):
    versions = []
    for k in keys:
        at = 0
        for i in range(draw.choice([1, 2, 5, 40])):
            start = at + draw.randint(0, 3)
            at = start + draw.randint(1, 4)
            versions.append((k, start, None if draw.random() < 0.05 else at + overlapping * draw.randint(0, 30), i))
    return versions


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("overlapping", [0, 1])
@pytest.mark.parametrize("block", [1, 3, 1000])
def test_agrees_with_a_plain_search(spark, how, overlapping, block):
    draw = random.Random(overlapping * 10 + block)
    versions = random_versions(draw, "abcdefg", overlapping)
    facts = [(draw.choice([*"abcdefgx", None]), draw.choice([None, *range(-2, 140)]), i) for i in range(800)]
    got = facts_as_of(facts_of(spark, facts), history_of(spark, versions), ["k"], "at", how=how, block=block)
    assert got.columns == ["k", "d", "n", "at", "v"]
    assert sorted((tuple(r) for r in got.drop("at").collect()), key=str) == expected(facts, versions, how)


def test_bounds_and_names(spark):
    history = history_of(spark, [("a", 1, 3, 1), ("a", 3, None, 2), (None, 0, None, 9)])
    facts = facts_of(spark, [("a", 0, 0), ("a", 1, 1), ("a", 2, 2), ("a", 3, 3), (None, 2, 4)])
    got = facts_as_of(facts, history, {"k": "k"}, F.col("at"), ["v", h.FROM], prefix="was_").select("n", "was_v")
    assert rows(got) == [(0, None), (1, 1), (2, 1), (3, 2), (4, None)]
    with pytest.raises(ValueError, match="prefix"):
        facts_as_of(facts.withColumn("v", F.lit(1)), history, ["k"], "at")
    with pytest.raises(ValueError, match="left"):
        facts_as_of(facts, history, ["k"], "at", how="outer")
    assert facts_as_of(facts.limit(0), history, ["k"], "at").count() == 0
    assert rows(facts_as_of(facts, history.limit(0), ["k"], "at"), "v") == [(None,)] * 5


def test_only_large_keys_have_blocks(spark):
    versions = [("few", i, i + 1, i) for i in range(3)] + [("many", i, i + 1, i) for i in range(10)]
    found = block_starts(history_of(spark, versions), ["k"], 4).collect()
    assert [(r["k"], len(r["__starts"])) for r in found] == [("many", 2)]


def test_hot_keys_are_split_and_no_pairs_are_made(spark):
    """A third of the facts is of one key, which has a thousand versions."""
    many = spark.range(0, 1000).select(
        F.lit(7).cast("long").alias("k"), F.col("id").alias("v"), F.timestamp_seconds("id").alias(h.FROM),
        F.timestamp_seconds(F.col("id") + 1).alias(h.TO),
    )
    few = spark.range(0, 20_000).select(
        (F.col("id") + 100).alias("k"), F.col("id").alias("v"), F.timestamp_seconds(F.lit(0)).alias(h.FROM),
        F.lit(None).cast("timestamp").alias(h.TO),
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000 + 100)
    # Two thirds of the hot key's facts are of one second.
    second = F.when(F.col("id") % 9 < 6, F.lit(500)).otherwise(F.col("id") % 1000)
    facts = spark.range(0, 60_000, 1, 4).select(key.alias("k"), F.timestamp_seconds(second).alias("at"), F.lit("x" * 40).alias("pad"))
    with settings(spark, **SKEW):
        out = facts_as_of(facts, many.unionByName(few), ["k"], "at")
        assert out.filter("v IS NOT NULL").count() == out.count() == 60_000
        out.collect()
        text = plan(out)
    assert re.search(r"SortMergeJoin\(skew=true\)", text), text[:2000]
    assert "NestedLoop" not in text and "Cartesian" not in text
