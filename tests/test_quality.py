"""Checks, split, keys."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import quality as q

CHECKS = [
    q.is_not_null("plate"),
    q.has_length("plate", 6),
    q.in_list("code", ["00", "NG"]),
    q.sql_check("old", "since IS NULL OR since >= '1890-01-01'", "too old", "warn"),
]


@pytest.fixture
def cars(spark):
    data = [
        ("ABC123", "00", "1990-01-01"),
        ("ABC12", "NG", None),
        (None, "07", None),
        ("XYZ789", None, "1800-01-01"),
        ("XYZ78", "1", "1800-01-01"),
    ]
    return spark.createDataFrame(data, "plate string, code string, since string").withColumn("since", F.col("since").cast("date"))


def test_split(cars):
    valid, rejected = q.split(cars, CHECKS)
    assert valid.columns == cars.columns
    assert rows(valid, "plate") == [("ABC123",), ("XYZ789",)]  # a NULL code passes, a warning stays
    found = {r["plate"]: ([e["name"] for e in r[q.ERRORS]], [w["name"] for w in r[q.WARNINGS]]) for r in rejected.collect()}
    assert found == {
        "ABC12": (["plate_length_valid"], []),
        None: (["plate_not_null", "code_in_list"], []),
        "XYZ78": (["plate_length_valid", "code_in_list"], ["old"]),
    }
    strict, more = q.split(cars, CHECKS, quarantine_warnings=True)
    assert strict.count() == 1 and more.count() == 4
    assert rows(q.warnings(cars, CHECKS), "plate") == [("XYZ789",)]


def test_split_without_checks(cars):
    valid, rejected = q.split(cars, [])
    assert valid.count() == 5 and rejected.count() == 0
    assert q.annotate(cars, []).filter(F.size(q.ERRORS) == 0).count() == 5


def test_summary_and_counts(cars):
    assert {r["check_name"]: r["n_rows"] for r in q.summary(cars, CHECKS).collect()} == {
        "plate_not_null": 1, "plate_length_valid": 2, "code_in_list": 2, "old": 2, "__quarantined": 3, "__rows": 5
    }
    assert tuple(q.row_counts(cars, CHECKS).first()) == (5, 3, 2)


def test_key_audit(cars, spark):
    assert tuple(q.key_audit(cars, CHECKS, ["plate"]).first()) == (5, 3, 2, 1)
    # A repeated key counts only with its valid rows, and a missing key not at all.
    twice = cars.unionByName(cars)
    assert tuple(q.key_audit(twice, CHECKS, ["plate"]).first()) == (10, 6, 4, 2)
    assert tuple(q.key_audit(twice.filter("plate IS NULL"), [], ["plate"]).first()) == (2, 0, 2, 0)
    assert tuple(q.key_audit(cars.limit(0), CHECKS, ["plate"]).first()) == (0, 0, 0, 0)


def test_literals_are_escaped(spark):
    df = spark.createDataFrame([("d'Or",), ("back\\slash",), ("x",)], "make string")
    valid, _ = q.split(df, [q.in_list("make", ["d'Or", "back\\slash"])])
    assert valid.count() == 2


def test_range_cross_and_future(spark):
    df = spark.createDataFrame([(5, 10, "2030-01-01"), (50, 40, "2020-01-01"), (None, 1, None)], "a int, b int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    assert q.split(df, [q.in_range("a", 1, 10)])[0].count() == 2
    assert q.split(df, [q.cross_column("a", "<=", "b")])[0].count() == 2
    assert q.split(df, [q.not_future("d", "DATE '2025-01-01'")])[0].count() == 2
    with pytest.raises(ValueError):
        q.cross_column("a", "; drop", "b")


def test_load_checks(cars):
    text = """
# comment
- name: plate_there
  criticality: error
  check:
    function: is_not_null
    arguments: {column: plate}
"""
    (check,) = q.load_checks(text)
    assert check == q.is_not_null("plate", name="plate_there")
    with pytest.raises(ValueError):
        q.Check("x", "error", "no_such_function")
    with pytest.raises(ValueError):
        q.Check("x", "fatal", "is_not_null")


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert rows(q.pk_violations(df, ["k"])) == [(None, 2), (1, 2)]
    unique, repeated = q.split_unique(df, ["k"])
    assert rows(unique, "v") == [("c",), ("d",), ("e",)]
    assert rows(repeated, "v") == [("a",), ("b",)]


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "code int, v string")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "code int")
    assert rows(q.fk_orphans(child, parent, ["code"])) == [(3, "d")]
    assert q.fk_orphans(child, child, ["code"]).isEmpty()
