"""Names, casts, contracts."""

from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import (
    ColumnContract,
    ForeignKey,
    SchemaMismatch,
    TableContract,
    UnknownTable,
    apply_comments,
    assert_compatible,
    contracts_from_yaml,
    empty_table,
    find_contract,
    with_comments,
)
from tidemark.functions.names import snake_case, title_label
from tidemark.functions.typing import tolerant_cast, tolerant_date, tolerant_int
from tidemark.operators.typing import (
    apply_contract,
    convert_date_columns,
    filter_key_length,
    normalize_columns,
    select_columns,
)


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("Kenteken", "kenteken"),
        ("Aantal Zitplaatsen", "aantal_zitplaatsen"),
        ("  A--B  (c) ", "a_b_c"),
        ("__Leading", "leading"),
        ("CO2 uitstoot %", "co2_uitstoot"),
        ("été", "t"),
        ("", ""),
    ],
)
def test_snake_case(name, wanted):
    assert snake_case(name) == wanted


def test_title_label():
    assert title_label("max_speed") == "Max Speed"


def test_normalize_rejects_colliding_names(spark):
    with pytest.raises(SchemaMismatch):
        normalize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_tolerant_int(spark):
    cases = {
        "12": 12, " 5 ": 5, "12.7": 12, "-3.9": -3, "+4": 4, "7.": 7, ".5": 0, "abc": None, "1e3": None, "": None,
        "1 2": None, "99999999999": None, "2147483647": 2147483647, "007": 7, "12.7.1": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", tolerant_int(F.col("c")).alias("i"))
    assert {r["c"]: r["i"] for r in df.collect()} == cases
    big = spark.createDataFrame([("99999999999.9",)], "c string").select(tolerant_int(F.col("c"), "bigint"))
    assert big.first()[0] == 99999999999


def test_tolerant_date(spark):
    cases = {"20240229": "2024-02-29", "20230229": None, "20231399": None, "2023139": None, "2023-01-15": None,
             "202301011": None, "abc": None, "00000101": None, "2024 1 1": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", tolerant_date(F.col("c")).alias("d"))
    assert {r["c"]: r["d"] and str(r["d"]) for r in df.collect()} == cases
    assert str(spark.range(20240131, 20240132).select(tolerant_date(F.col("id"))).first()[0]) == "2024-01-31"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_is_null_in_either_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.createDataFrame([("x",)], "c string")
        kinds = [T.IntegerType(), T.DateType(), T.DoubleType(), T.DecimalType(18, 2), T.TimestampType()]
        out = df.select(*[tolerant_cast(F.col("c"), T.StringType(), k).alias(f"c{i}") for i, k in enumerate(kinds)])
        assert out.first() == (None,) * len(kinds)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


CARS = TableContract(
    "cars",
    (
        ColumnContract("Plate No", "plate", "string", nullable=False, pk=True, description="The car's plate"),
        ColumnContract("Seats", "seats", T.IntegerType()),
        ColumnContract("First Seen", "first_seen", "date"),
        ColumnContract("Judgment", "judgment", "string", fk="judgments"),
        ColumnContract("Never There", "never_there", "string"),
    ),
    tracked=True,
)


def test_apply_contract(spark):
    raw = spark.createDataFrame(
        [("x", "4.0", "20240101", "07"), ("y", "many", "0", None)], "extra string, Seats string, `First Seen` string, Judgment string"
    ).withColumn("Plate No", F.lit("AB12CD"))
    out = apply_contract(raw, CARS)
    assert out.columns == ["extra", "seats", "first_seen", "judgment", "plate"]
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int", "date", "string", "string"]
    assert [(r["extra"], r["seats"], str(r["first_seen"]), r["judgment"]) for r in out.collect()] == [
        ("x", 4, "2024-01-01", "07"),
        ("y", None, "None", None),
    ]


def test_apply_contract_is_one_projection(spark):
    wide = TableContract("wide", tuple(ColumnContract(f"C {i}", f"c{i}", "int") for i in range(120)))
    raw = spark.range(1).select(*[F.lit(str(i)).alias(f"C {i}") for i in range(120)])
    plan = apply_contract(raw, wide)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 2  # the raw frame's own and the contract's


def test_apply_contract_rejects_colliding_output(spark):
    with pytest.raises(SchemaMismatch):
        apply_contract(spark.createDataFrame([("a", "b")], "`Plate No` string, plate string"), CARS)


def test_contract_keys_schema_and_lookup(spark):
    assert CARS.primary_keys() == ["plate"]
    assert CARS.foreign_keys() == {"judgment": ForeignKey("judgments", "judgment")}
    schema = CARS.schema()
    assert [f.nullable for f in schema] == [False, True, True, True, True]
    assert schema["seats"].dataType == T.IntegerType() and schema["plate"].metadata == {"comment": "The cars plate"}
    assert find_contract([CARS], "cars") is CARS
    with pytest.raises(UnknownTable, match="cars"):
        find_contract([CARS], "boats")
    with pytest.raises(SchemaMismatch):
        TableContract("twice", (ColumnContract("a", "x"), ColumnContract("b", "x")))
    with pytest.raises(SchemaMismatch):
        TableContract("keyless", (ColumnContract("a", "x"),), tracked=True)


def test_empty_table_and_comments(spark):
    empty = empty_table(spark, CARS, scd2=True)
    assert empty.columns[-7:] == [
        "__valid_from", "__valid_to", "__is_current", "__operation", "__processed_time", "__row_hash", "__version"
    ]
    assert empty.isEmpty()
    commented = with_comments(spark.createDataFrame([("A", 1)], "plate string, other int"), CARS)
    assert commented.schema["plate"].metadata["comment"] == "The cars plate"


def test_comments_reach_files_and_catalog(spark, tmp_path):
    described = replace(CARS, description="All the cars' rows")
    path = str(tmp_path / "cars")
    with_comments(empty_table(spark, described, scd2=True), described).write.parquet(path)
    assert spark.read.parquet(path).schema["plate"].metadata["comment"] == "The cars plate"
    spark.sql(f"CREATE TABLE commented_cars USING parquet LOCATION '{path}'")
    try:
        apply_comments(spark, described, "commented_cars", scd2=True)
        shown = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE commented_cars").collect()}
        assert shown["plate"] == "The cars plate" and shown["__version"].startswith("SCD2: Version")
        detail = spark.sql("DESCRIBE EXTENDED commented_cars").filter("col_name = 'Comment'").first()
        assert detail["data_type"] == "All the cars rows"
    finally:
        spark.sql("DROP TABLE commented_cars")


def test_assert_compatible(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert_compatible(df, df.schema)
    with pytest.raises(SchemaMismatch, match="order"):
        assert_compatible(df.select("y", "x"), df.schema)
    with pytest.raises(SchemaMismatch, match="missing"):
        assert_compatible(df.withColumn("x", F.lit("t")), df.schema)


def test_convert_date_columns(spark):
    df = spark.createDataFrame([(20240102, "bad", "20240103", 1)], "MOT_Date int, datum_b string, update_ts string, n int")
    out = convert_date_columns(df)
    assert [str(v) for v in out.first()] == ["2024-01-02", "None", "2024-01-03", "1"]
    epoch = convert_date_columns(spark.createDataFrame([("86400",), ("x",)], "the_date string"), epoch=True)
    assert [str(r[0]) for r in epoch.collect()] == ["1970-01-02", "None"]


def test_filter_key_length_and_select(spark):
    df = spark.createDataFrame([("ABC123", 1), ("AB123", 2), ("ABCD1234", 3), ("XYZ789", 4)], "plate string, n int")
    assert rows(filter_key_length(df), "n") == [(1,), (4,)]
    assert rows(filter_key_length(df, 8, "plate"), "n") == [(3,)]
    with pytest.raises(SchemaMismatch):
        select_columns(df, ["plate", "gone"])


def test_contracts_from_yaml():
    text = """
- name: cars
  tracked: true
  columns:
    - [Plate No, plate, string, pk]
    - [Seats, seats, int]
    - [Judgment, judgment, string, fk=judgments]
"""
    (cars,) = contracts_from_yaml(text)
    assert cars.tracked and cars.primary_keys() == ["plate"] and not cars.columns[0].nullable
    assert cars.foreign_keys() == {"judgment": ForeignKey("judgments", "judgment")}
