"""Change detection and type 2 history."""

import random
from datetime import datetime

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F

from tidemark.operators import history as h

T1, T2, T3, T4 = "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"
CAR = "plate string, make string"


def frame(spark, data, schema=CAR):
    return spark.createDataFrame(data, schema)


def apply_all(spark, snapshots, keys=("plate",), schema=CAR, **options):
    history = None
    for ts, data in snapshots:
        history = h.apply_snapshot(history, frame(spark, data, schema), list(keys), ts, **options)
    return history


def brief(history, *data):
    shown = history.select(
        *(data or ("plate", "make")),
        F.date_format(h.FROM, "MM").alias("f"),
        F.date_format(h.TO, "MM").alias("t"),
        h.CURRENT,
        h.OPERATION,
        h.VERSION,
    )
    return rows(shown)


def test_row_hash_value_and_stability(spark):
    df = frame(spark, [("A1", "Audi"), ("B2", None)])
    out = {r["plate"]: r["__row_hash"] for r in h.row_hash(df, ["plate", "make"]).collect()}
    import hashlib

    assert out == {
        "A1": hashlib.md5(b"A1|Audi").hexdigest(),
        "B2": hashlib.md5(b"B2|NULL").hexdigest(),
    }
    assert {r["plate"]: r["__row_hash"] for r in h.row_hash(df, ["plate", "make"]).collect()} == out


def test_comparison_columns():
    names = ["plate", "make", "color", "__version", "year"]
    assert h.comparison_columns(names, ["plate"]) == ["make", "color", "year"]
    assert h.comparison_columns(names, ["plate"], tracking=["year", "plate", "make"]) == ["year", "make"]
    assert h.comparison_columns(names, ["plate"], exclude=["color"]) == ["make", "year"]


def test_first_snapshot_is_all_inserts(spark):
    changes = h.detect_changes(frame(spark, [("A1", "Audi"), ("B2", "BMW")]), None, ["plate"])
    assert rows(changes, "plate", h.OPERATION) == [("A1", "INSERT"), ("B2", "INSERT")]


@pytest.mark.parametrize("compare", ["hash", "columns"])
def test_detect_changes(spark, compare):
    old = frame(spark, [("A1", "Audi"), ("B2", "BMW"), ("C3", "Citroen"), ("D4", None)])
    new = frame(spark, [("A1", "Audi"), ("B2", "Bentley"), ("D4", None), ("E5", "Fiat")])
    changes = h.detect_changes(new, old, ["plate"], compare=compare)
    assert rows(changes, "plate", "make", h.OPERATION) == [
        ("B2", "Bentley", "UPDATE"),
        ("C3", "Citroen", "DELETE"),
        ("E5", "Fiat", "INSERT"),
    ]


def test_mixed_batch(spark):
    history = apply_all(
        spark,
        [(T1, [("A1", "Audi"), ("B2", "BMW"), ("C3", "Citroen")]), (T2, [("A1", "Audi"), ("B2", "Bentley"), ("D4", "Dacia")])],
    )
    assert brief(history) == [
        ("A1", "Audi", "01", None, True, "INSERT", 1),
        ("B2", "BMW", "01", "02", False, "INSERT", 1),
        ("B2", "Bentley", "02", None, True, "UPDATE", 2),
        ("C3", "Citroen", "01", "02", False, "DELETE", 1),
        ("D4", "Dacia", "02", None, True, "INSERT", 1),
    ]
    assert rows(h.current_records(history)) == [("A1", "Audi"), ("B2", "Bentley"), ("D4", "Dacia")]


def test_four_versions_and_immutability(spark):
    steps = [(t, [("A1", m)]) for t, m in [(T1, "Audi"), (T2, "BMW"), (T3, "Citroen"), (T4, "Dacia")]]
    histories = [apply_all(spark, steps[: n + 1]) for n in range(4)]
    assert [r[6] for r in brief(histories[3])] == [1, 2, 3, 4]
    for before, after in zip(histories, histories[1:]):
        kept = [c for c in before.columns if c != h.PROCESSED]
        assert h.altered_closed_rows(before.select(*kept), after.select(*kept)).isEmpty()
    assert h.invariant_violations(histories[3], ["plate"]).isEmpty()


def test_key_that_comes_back_starts_again(spark):
    history = apply_all(spark, [(T1, [("A1", "Audi"), ("Z", "z")]), (T2, [("Z", "z")]), (T3, [("A1", "Audi"), ("Z", "z")])])
    assert brief(history.filter("plate = 'A1'")) == [
        ("A1", "Audi", "01", "02", False, "DELETE", 1),
        ("A1", "Audi", "03", None, True, "INSERT", 1),
    ]
    assert h.invariant_violations(history, ["plate"]).isEmpty()


def test_value_that_becomes_null_is_taken_and_stays(spark):
    steps = [(T1, [("A1", "Audi")]), (T2, [("A1", None)]), (T3, [("A1", None)])]
    assert brief(apply_all(spark, steps)) == [
        ("A1", None, "02", None, True, "UPDATE", 2),
        ("A1", "Audi", "01", "02", False, "INSERT", 1),
    ]


def test_null_key_is_deleted_and_inserted_each_time(spark):
    steps = [(T1, [(None, "x"), ("A1", "Audi")]), (T2, [(None, "x"), ("A1", "Audi")])]
    assert brief(apply_all(spark, steps)) == [
        (None, "x", "01", "02", False, "DELETE", 1),
        (None, "x", "02", None, True, "INSERT", 1),
        ("A1", "Audi", "01", None, True, "INSERT", 1),
    ]


def test_empty_snapshot_deletes_all(spark):
    history = apply_all(spark, [(T1, [("A1", "Audi")]), (T2, [])])
    assert brief(history) == [("A1", "Audi", "01", "02", False, "DELETE", 1)]
    assert h.current_records(history).isEmpty()


def test_untracked_columns_are_kept_but_do_not_count(spark):
    schema = "plate string, make string, color string, year string"
    steps = [
        (T1, [("A1", "Audi", "red", "2020")]),
        (T2, [("A1", "Audi", "blue", "2021")]),
        (T3, [("A1", "BMW", "green", "2022")]),
    ]
    history = apply_all(spark, steps, schema=schema, tracking=["make"])
    assert brief(history, "make", "color", "year") == [
        ("Audi", "red", "2020", "01", "03", False, "INSERT", 1),
        ("BMW", "green", "2022", "03", None, True, "UPDATE", 2),
    ]
    ignored = apply_all(spark, steps, schema=schema, exclude=["color", "year"])
    assert brief(ignored, "make") == [
        ("Audi", "01", "03", False, "INSERT", 1),
        ("BMW", "03", None, True, "UPDATE", 2),
    ]


def test_column_comparison_sees_what_the_hash_cannot(spark):
    schema = "k int, a string, b string"
    old, new = frame(spark, [(1, "a|b", "c"), (2, None, "x")], schema), frame(spark, [(1, "a", "b|c"), (2, "NULL", "x")], schema)
    assert h.detect_changes(new, old, ["k"]).isEmpty()
    assert rows(h.detect_changes(new, old, ["k"], compare="columns"), "k", h.OPERATION) == [(1, "UPDATE"), (2, "UPDATE")]


def test_composite_key_and_new_column(spark):
    first = frame(spark, [("NL", 1, "a"), ("BE", 1, "b")], "land string, no int, v string")
    second = frame(spark, [("NL", 1, "a", "x"), ("BE", 1, "b", None)], "land string, no int, v string, w string")
    history = h.apply_snapshot(h.initial_load(first, ["land", "no"], T1), second, ["land", "no"], T2)
    assert brief(history, "land", "v", "w") == [
        ("BE", "b", None, "01", None, True, "INSERT", 1),
        ("NL", "a", None, "01", "02", False, "INSERT", 1),
        ("NL", "a", "x", "02", None, True, "UPDATE", 2),
    ]


@pytest.mark.parametrize("operation,current,end", [("INSERT", True, None), ("UPDATE", True, None), ("DELETE", False, "02")])
def test_create_history_records(spark, operation, current, end):
    out = h.create_history_records(frame(spark, [("A1", "Audi")]), operation, datetime(2024, 2, 1), version=4)
    assert brief(out) == [("A1", "Audi", "02", end, current, operation, 4)]


def test_process_returns_current_and_history(spark):
    current, full = h.process(frame(spark, [("A1", "Audi")]), None, ["plate"])
    assert rows(current) == [("A1", "Audi")] and full.columns == ["plate", "make", *h.META]


def test_merge_histories(spark):
    def stamped(data, ts, schema=CAR):
        return h.create_history_records(frame(spark, data, schema), "INSERT", ts)

    merged = h.merge_histories(
        stamped([("A1", "Audi"), ("B2", "BMW"), (None, "n")], T1),
        stamped([("A1", "Audi", "red"), ("C3", "Citroen", "blue")], T2, CAR + ", color string"),
        ["plate"],
    )
    assert rows(merged, "plate", "color", F.date_format(h.FROM, "MM"), h.CURRENT) == [
        (None, None, "01", True),
        ("A1", None, "01", False),
        ("A1", "red", "02", True),
        ("B2", None, "01", True),
        ("C3", "blue", "02", True),
    ]


def test_merge_histories_breaks_ties_once(spark):
    a = h.create_history_records(frame(spark, [("A1", "Audi")]), "INSERT", T1, version=1)
    b = h.create_history_records(frame(spark, [("A1", "Audi")]), "INSERT", T1, version=1)
    merged = h.merge_histories(a, b.withColumn(h.PROCESSED, F.lit(T1).cast("timestamp")), ["plate"])
    assert merged.filter(h.CURRENT).count() == 1 and merged.count() == 2


def test_as_of_rebuilds_each_snapshot(spark):
    steps = [(T1, [("A1", "Audi"), ("B2", "BMW")]), (T2, [("A1", "Alfa")]), (T3, [("B2", "BMW"), ("A1", "Alfa")])]
    history = apply_all(spark, steps)
    for ts, data in steps:
        assert rows(h.as_of(history, ts).select("plate", "make")) == sorted(data)
    assert h.as_of(history, "2023-12-31").isEmpty()


def test_invariants_find_each_fault(spark):
    good = apply_all(spark, [(T1, [("A1", "Audi"), ("B2", "b")]), (T2, [("A1", "BMW"), ("B2", "b")])])
    assert h.invariant_violations(good, ["plate"]).isEmpty()
    reopened = good.withColumn(h.CURRENT, F.lit(True))
    assert rows(h.invariant_violations(reopened, ["plate"])) == [
        ("A1", "current_is_open", 1),
        ("A1", "one_current_per_key", 2),
    ]
    skipped = good.withColumn(h.VERSION, F.col(h.VERSION) * F.col(h.VERSION))
    assert rows(h.invariant_violations(skipped, ["plate"])) == [("A1", "follows_previous_version", 1)]
    turned = good.withColumn(h.FROM, F.coalesce(F.col(h.TO) + F.expr("interval 1 day"), F.col(h.FROM)))
    assert ("A1", "starts_before_end", 1) in rows(h.invariant_violations(turned, ["plate"]))
    changed = good.withColumn("make", F.upper("make"))
    assert h.altered_closed_rows(good, changed).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    schema = "k int, land string, a string, b int"
    times = ["2024-01-01", "2024-01-08", "2024-02-01", "2024-02-02", "2024-05-01"]
    steps = [
        (t, [(k, "NL" if k % 2 else None if k == 8 else "BE", rng.choice([None, "x", "y"]), rng.randint(0, 1))
             for k in range(40) if rng.random() < 0.7])
        for t in times
    ]
    stacked = None
    for ts, data in steps:
        one = frame(spark, data, schema).withColumn("ts", F.lit(ts).cast("timestamp"))
        stacked = one if stacked is None else stacked.unionByName(one)
    options = {"exclude": ["b"], "processed_time": "2025-01-01"}
    looped = rows(apply_all(spark, steps, ("k", "land"), schema, **options))
    assert rows(h.replay(stacked, ["k", "land"], "ts", **options)) == looped
    assert rows(h.replay(stacked, ["k", "land"], "ts", times=times, **options)) == looped


def test_replay_sees_an_empty_snapshot_when_told(spark):
    data = frame(spark, [("A1", "Audi")]).withColumn("ts", F.lit(T1).cast("timestamp"))
    again = data.withColumn("ts", F.lit(T3).cast("timestamp"))
    out = h.replay(data.unionByName(again), ["plate"], "ts", times=[T1, T2, T3])
    assert brief(out) == [
        ("A1", "Audi", "01", "02", False, "DELETE", 1),
        ("A1", "Audi", "03", None, True, "INSERT", 1),
    ]


def test_history_sizes_on_whole_orders(spark):
    """Sizes known from an independent computation over 15,000 orders."""
    path = TESTDATA / "sf0.01"
    if not path.exists():
        pytest.skip("test tables are not here")
    base = spark.read.parquet(f"{path}/orders.parquet").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("odate"),
        F.col("o_orderpriority").alias("prio"),
    )
    key = F.col("o_orderkey")
    a = base.filter(key % 10 != 0)
    b = base.filter(key % 10 != 1).withColumns(
        {
            "o_orderstatus": F.when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")),
            "prio": F.when(key % 11 != 0, F.col("prio")),
        }
    )
    c = base.filter(key % 10 != 2).withColumn(
        "price", F.when(key % 13 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")
    )
    history, sizes = None, []
    for ts, snapshot in [(T1, a), (T2, b), (T3, c)]:
        history = h.apply_snapshot(history, snapshot, ["o_orderkey"], ts)
        sizes.append(history.count())
    assert sizes == [13500, 17649, 22518]
    shape = {(r[h.OPERATION], r[h.CURRENT]): r["count"] for r in history.groupBy(h.OPERATION, h.CURRENT).count().collect()}
    assert shape == {
        ("DELETE", False): 3000,
        ("INSERT", False): 3701,
        ("INSERT", True): 10131,
        ("UPDATE", False): 2317,
        ("UPDATE", True): 3369,
    }
    assert h.invariant_violations(history, ["o_orderkey"]).isEmpty()


def test_thousand_rows_within_the_time_limits(spark):
    """First load within 30 s, an update of a tenth of the rows within 45 s, results included."""
    import time

    brands, models = ["Audi", "BMW", "Citroen", "Dacia", "Fiat"], ["A", "B", "C", "D", "E"]
    schema = "plate string, make string, model string, year int"
    first = [(f"K{i:05d}", brands[i % 5], models[i // 5 % 5], 2020 + i % 5) for i in range(1000)]
    second = [(k, "Ford" if i < 100 else make, model, year) for i, (k, make, model, year) in enumerate(first)]
    start = time.perf_counter()
    history = h.apply_snapshot(None, frame(spark, first, schema), ["plate"], T1)
    assert history.count() == 1000
    loaded = time.perf_counter()
    history = h.apply_snapshot(history, frame(spark, second, schema), ["plate"], T2)
    assert history.count() == 1100 and history.filter(h.CURRENT).count() == 1000
    assert loaded - start < 30 and time.perf_counter() - loaded < 45


def test_one_car_over_the_years(spark):
    """Owner, color and inspection date change at different times; mileage is not tracked."""
    schema = "plate string, owner string, color string, inspected string, mileage int"
    years = [
        ("2020-01-15", ("XY99ZZ", "Ann", "white", "2021-01-15", 10)),
        ("2020-07-01", ("XY99ZZ", "Ann", "white", "2021-01-15", 9_000)),
        ("2021-06-10", ("XY99ZZ", "Bob", "white", "2021-01-15", 20_000)),
        ("2022-01-20", ("XY99ZZ", "Bob", "black", "2023-01-20", 35_000)),
        ("2023-08-05", ("XY99ZZ", "Garage", "black", "2023-01-20", 60_000)),
    ]
    steps = [(ts, [row]) for ts, row in years] + [("2024-01-01", [])]
    history = apply_all(spark, steps, schema=schema, tracking=["owner", "color", "inspected"])
    shown = history.select(
        h.VERSION, "owner", "color", "mileage", F.to_date(h.FROM).cast("string"), F.to_date(h.TO).cast("string"), h.OPERATION
    )
    assert rows(shown) == [
        (1, "Ann", "white", 10, "2020-01-15", "2021-06-10", "INSERT"),
        (2, "Bob", "white", 20_000, "2021-06-10", "2022-01-20", "UPDATE"),
        (3, "Bob", "black", 35_000, "2022-01-20", "2023-08-05", "UPDATE"),
        (4, "Garage", "black", 60_000, "2023-08-05", "2024-01-01", "DELETE"),
    ]
    assert h.current_records(history).isEmpty()
