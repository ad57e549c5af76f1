"""Every registered query agrees with its SQL on a second engine."""

import pytest
from check_oracle import compare

import __spark_entry__ as entry
from tidemark.plans.queries import oracle_sql, queries

QUERIES = sorted(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    problem, _, _ = compare(spark, duck, name, sf_dir)
    assert problem == ""


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries()) and set(queries()) <= set(entry.queries())


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.limit(1).count() == 1
