"""Stars by declared keys, and distinct counts from merged sketches."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import NO_BROADCAST, plan, settings

from tidemark.contracts import ColumnContract, ForeignKey, SchemaMismatch, TableContract
from tidemark.operators.metrics import SKETCH_ERROR, distinct_cells, distinct_rollup
from tidemark.operators.star import Table, enrich_star
from tidemark.scratch import stored


def contract(name, columns, pk=(), fks=None):
    return TableContract(name, tuple(ColumnContract(c, c, "int", pk=c in pk, fk=(fks or {}).get(c)) for c in columns))


CARS = contract("cars", ["id", "code"], ["id"], {"code": ForeignKey("codes", "c")})
CODES = contract("codes", ["c", "kind"], ["c"], {"kind": ForeignKey("kinds", "k")})
KINDS = contract("kinds", ["k", "text"], ["k"])
AXLES = contract("axles", ["car", "n", "load"], [], {"car": ForeignKey("cars", "id")})
SEATS = contract("seats", ["car", "n"], [], {"car": ForeignKey("cars", "id")})


def frame(spark, contract_, data):
    return spark.createDataFrame(data, ", ".join(f"{c.output_col} int" for c in contract_.columns))


@pytest.fixture
def star(spark):
    cars = frame(spark, CARS, [(1, 10), (2, 20), (3, 99), (4, None), (None, 10)])
    tables = {
        "codes": Table(CODES, frame(spark, CODES, [(10, 7), (20, None), (30, 7)])),
        "kinds": Table(KINDS, frame(spark, KINDS, [(7, 70)])),
        "axles": Table(AXLES, frame(spark, AXLES, [(1, 2, 5), (1, 1, 6), (3, 1, 7), (8, 1, 1), (None, 1, 1)]), ["n"], {"load_sum": "sum(load)"}),
        "seats": Table(SEATS, frame(spark, SEATS, [(2, 4)])),
    }
    return Table(CARS, cars), tables


def test_every_row_once_with_all_connected_columns(star):
    main, tables = star
    got = enrich_star(main, list(tables.values()))
    names = ["id", "code", "codes_kind", "kinds_text", "axles_n", "axles_load", "axles_load_sum", "axles_n_rows", "seats_n_rows"]
    assert sorted(got.columns) == sorted(names)
    assert rows(got, *names) == sorted(
        [
            (1, 10, 7, 70, 1, 6, 11, 2, 0),
            (2, 20, None, None, None, None, None, 0, 1),
            (3, 99, None, None, 1, 7, 7, 1, 0),
            (4, None, None, None, None, None, None, 0, 0),
            (None, 10, 7, 70, None, None, None, 0, 0),
        ],
        key=lambda t: [(x is not None, str(x)) for x in t],
    )


def test_the_main_table_is_shuffled_once_for_its_key(spark, star):
    main, tables = star
    wide = stored(spark.range(0, 500).select(F.col("id").cast("int"), (F.col("id") % 7).cast("int").alias("code")), "cars")
    main = Table(CARS, wide)
    with settings(spark, **NO_BROADCAST):
        text = plan(enrich_star(main, [tables["axles"], tables["seats"]]))
    scan = text.index("cars-")
    above = [line for line in text.splitlines() if "Exchange" in line and "code" in line and "id" in line]
    assert text.count("cars-") == 1 and scan > 0
    # Of all exchanges, one moves rows of the main table.
    assert len(above) <= 1 and text.count("SortMergeJoin") >= 2


def test_wrong_stars_are_refused(spark, star):
    main, tables = star
    lost = Table(contract("lost", ["a"]), frame(spark, contract("lost", ["a"]), []))
    with pytest.raises(SchemaMismatch, match="lost"):
        enrich_star(main, [lost])
    round_ = contract("kinds", ["k", "text"], ["k"], {"text": ForeignKey("codes", "c")})
    with pytest.raises(SchemaMismatch, match="circle"):
        enrich_star(main, [tables["codes"], Table(round_, tables["kinds"].rows)])
    clash = Table(CARS, main.rows.withColumn("codes_kind", F.lit(1)))
    with pytest.raises(SchemaMismatch, match="codes_kind"):
        enrich_star(clash, [tables["codes"]])
    assert enrich_star(main, []).columns == ["id", "code"]


def test_sketches_merge_over_time_and_categories(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int"))
    df = spark.range(0, 60_000, 1, 4).select(
        day.alias("d"), (F.col("id") % 3).alias("g"), (F.col("id") % 9973).alias("a"), (F.col("id") % 50 / 7).alias("b"), F.lit(None).cast("int").alias("c")
    )
    cells = stored(distinct_cells(df, "d", ["a", "b", "c"], ["g"]), "cells")
    assert cells.count() == 60  # id % 60 decides id % 3
    for period, by in ((None, []), (None, ["g"]), ("MONTH", []), ("MONTH", ["g"])):
        start = [] if period is None else [F.date_trunc("month", "d").cast("date").alias("period")]
        exact = df.groupBy(*start, *by).agg(F.count("*").alias("n"), F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"))
        on = [*(["period"] if period else []), *by]
        want = {tuple(r[c] for c in on): r for r in exact.collect()}
        got = {tuple(r[c] for c in on): r for r in distinct_rollup(cells, ["a", "b", "c"], period, by).collect()}
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert r["n_rows"] == want[k]["n"] and r["approx_b"] == want[k]["b"] and r["approx_c"] == 0
            assert abs(r["approx_a"] - want[k]["a"]) <= SKETCH_ERROR * want[k]["a"]
    with pytest.raises(ValueError, match="HOUR"):
        distinct_cells(df, "d", ["a"], period="HOUR")
    assert distinct_rollup(distinct_cells(df.limit(0), "d", ["a"]), ["a"], "YEAR").count() == 0
    first = distinct_rollup(cells, ["a"], "MONTH").orderBy("period").first()
    assert first["period"] == datetime.date(2024, 1, 1)
