"""Values and rows as text."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.display import format_key, format_value, normalize_key
from tidemark.operators.shaping import categorize, describe_row, display_name, row_to_text


def shown(spark, expression, values, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_format_key(spark):
    cases = {
        "ABCD12": "AB-CD-12",
        "12ABC3": "12-ABC-3",
        "AB12CD": "AB-12-CD",
        "ABCDE1": "AB-CD-E-1",
        "12ABCD": "12-AB-CD",
        "A1B2": "A-1-B-2",
        "ABC1ABCDEF": "ABC-1-AB-CD-EF",
        "Unknown": "Unknown",
        "": "",
        None: None,
    }
    assert shown(spark, format_key, list(cases)) == list(cases.values())


def test_normalize_key(spark):
    assert shown(spark, normalize_key, [" ab-12-cd ", "X Y 1"]) == ["AB12CD", "XY1"]


@pytest.mark.parametrize(
    "kind,value,text",
    [
        ("date", "20200115", "January 15, 2020"),
        ("date", "2020-01-05", "January 05, 2020"),
        ("date", "soon", "soon"),
        ("cc", "999", "999cc"),
        ("cc", "1000", "1L"),
        ("cc", "1598", "1.6L"),
        ("cc", "1998.9", "2.0L"),
        ("cc", "1150", "1.1L"),  # the double 1.15 lies below the tie
        ("cc", "1250", "1.2L"),  # an exact tie goes to the even digit
        ("cc", "1350", "1.4L"),
        ("cc", "12000000", "12000L"),
        ("cc", "n/a", "n/a"),
        ("kg", "1200.9", "1200kg"),
        ("kg", "-3.9", "-3kg"),
        ("mm", "4100", "4100mm"),
        ("kmh", "180.0", "180km/h"),
        ("kw", "75", "75kW"),
        ("gkm", "120.4", "120g/km"),
        ("count", "5.0", "5"),
        ("number", "2.5", "2"),
        ("number", "3.5", "4"),
        ("number", "1e3", "1000"),
        ("number", "-0.4", "0"),
        ("number", "12d", "12d"),
        ("number", "Nee", "Nee"),
        ("text", "7.0", "7.0"),
    ],
)
def test_format_value(spark, kind, value, text):
    assert shown(spark, lambda c: format_value(c, kind), [value, None]) == [text, None]


def test_format_value_rejects_unknown_kinds(spark):
    with pytest.raises(ValueError):
        format_value(F.lit(1), "furlong")


@pytest.fixture
def cars(spark):
    data = [("A1", "Audi", "A4", 1998, 0, "red"), ("B2", None, " ", None, 5, "Niet geregistreerd")]
    return spark.createDataFrame(data, "plate string, make string, model string, cc int, doors int, color string")


def test_describe_row(cars):
    parts = [("Type", "model", "text"), ("Engine", "cc", "cc"), ("Doors", "doors", "count")]
    out = describe_row(cars, parts).select("description", display_name(F.col("make"), F.col("model"))).collect()
    assert [tuple(r) for r in out] == [
        ("Type: A4 • Engine: 2.0L • Doors: 0", "Audi A4"),
        ("Type:   • Doors: 5", "Unknown  "),
    ]


def test_row_to_text(cars):
    out = row_to_text(cars, ["make", "model", "doors", "color"]).orderBy("plate").collect()
    assert [r["details"] for r in out] == ["- Make: Audi\n- Model: A4\n- Color: red", "- Doors: 5"]
    assert row_to_text(cars, ["cc"]).filter("plate = 'B2'").first()["details"] == "No detailed information available"


def test_categorize(cars):
    out = categorize(cars, "plate", {"General": ["make", "model"], "Engine": ["cc"]}, {"cc": "cc"})
    assert sorted(tuple(r) for r in out.filter("plate = 'A1'").collect()) == [
        ("A1", "Engine", "Cc", "2.0L"),
        ("A1", "General", "Make", "Audi"),
        ("A1", "General", "Model", "A4"),
        ("A1", "Other", "Color", "red"),
        ("A1", "Other", "Doors", "0"),
    ]
