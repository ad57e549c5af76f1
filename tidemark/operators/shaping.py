"""Rows as text for people: descriptions, listings, categorised details."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.display import NOT_REGISTERED, UNKNOWN, as_number, format_number_as, format_value
from ..functions.names import title_label

# Joints and fallback texts.
PART_JOINT = " • "
NO_DETAILS = "No detailed information available"
OTHER = "Other"


def display_name(first: Column, second: Column) -> Column:
    return F.concat_ws(
        " ", F.coalesce(first, F.lit(UNKNOWN)), F.coalesce(second, F.lit(f"{UNKNOWN} Model"))
    )


def format_values(df: DataFrame, shown: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add display columns: name -> (source column, kind).

    A column is read as a number once, in a projection of its own, however many kinds show it; the
    projections stay apart because the number is used more than once.
    """
    numeric = sorted({c for c, kind in shown.values() if kind not in ("text", "date", "year")})
    df = df.withColumns({f"__number_{c}": as_number(F.col(c)) for c in numeric}) if numeric else df
    made = {
        name: format_number_as(F.col(f"__number_{c}"), F.col(c).cast("string"), kind)
        if c in numeric and kind not in ("text", "date", "year")
        else format_value(F.col(c), kind)
        for name, (c, kind) in shown.items()
    }
    return df.withColumns(made).drop(*[f"__number_{c}" for c in numeric])


def describe_row(df: DataFrame, parts: Sequence[tuple[str, str, str]], name: str = "description") -> DataFrame:
    """``Label: value • Label: value`` of (label, column, kind); NULL values are left out."""
    texts = [F.concat(F.lit(f"{label}: "), format_value(F.col(column), kind)) for label, column, kind in parts]
    return df.withColumn(name, F.concat_ws(PART_JOINT, *texts))


def row_to_text(
    df: DataFrame, columns: Sequence[str], sentinel: str = NOT_REGISTERED, name: str = "details"
) -> DataFrame:
    """``- Label: value`` lines; NULL, blank and unregistered values, zero and false are left out."""
    lines = []
    for column in columns:
        value, text = F.col(column), F.col(column).cast("string")
        kind = df.schema[column].dataType
        wanted = (F.trim(text) != "") & (text != sentinel)
        if isinstance(kind, T.NumericType):
            wanted = wanted & (value != 0)
        elif isinstance(kind, T.BooleanType):
            wanted = wanted & value
        lines.append(F.when(wanted, F.concat(F.lit(f"- {title_label(column)}: "), text)))
    joined = F.concat_ws("\n", *lines)
    return df.withColumn(name, F.when(joined == "", F.lit(NO_DETAILS)).otherwise(joined))


def categorize(
    df: DataFrame,
    key: str,
    categories: Mapping[str, Sequence[str]],
    kinds: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per filled column: key, category, label, value.

    Columns without a category fall under "Other".  A generator in one projection: the
    category of a column is known when the plan is built, so nothing is joined.
    """
    category_of = {column: category for category, columns in categories.items() for column in columns}
    kinds = kinds or {}
    rows = []
    for column in df.columns:
        if column == key:
            continue
        text = F.col(column).cast("string")
        rows.append(
            F.struct(
                F.lit(category_of.get(column, OTHER)).alias("category"),
                F.lit(title_label(column)).alias("label"),
                F.when(text != "", format_value(F.col(column), kinds.get(column, "number"))).alias("value"),
            )
        )
    return df.select(F.col(key), F.inline(F.array(*rows))).filter(F.col("value").isNotNull())
