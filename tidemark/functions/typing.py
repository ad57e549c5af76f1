"""Casts that turn bad text into NULL, whatever the session's ANSI mode."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Compact date format of the extracts.
COMPACT_DATE = "yyyyMMdd"
COMPACT_DATE_PATTERN = r"^(?!0000)\d{8}$"


def tolerant_int(column: Column, dtype: str = "int") -> Column:
    """Text to an integer type: a plain fraction is cut off, anything else unreadable is NULL."""
    text = F.trim(column.cast("string"))
    without_fraction = F.regexp_replace(text, r"\.\d*$", "")
    return F.coalesce(
        text.try_cast(dtype),
        F.when(text.rlike(r"^[+-]?\d+\.\d*$"), without_fraction.try_cast(dtype)),
        F.when(text.rlike(r"^[+-]?\.\d*$"), F.lit(0).cast(dtype)),
    )


def tolerant_date(column: Column, fmt: str = COMPACT_DATE) -> Column:
    """Text or a number such as 20240131 to a date."""
    text = column.cast("string")
    if fmt != COMPACT_DATE:
        return F.try_to_date(text, fmt)
    # The cast from ISO text is several times cheaper than parsing by a pattern.
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(COMPACT_DATE_PATTERN), iso.try_cast("date"))


def tolerant_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast by contract: dates from the compact format, integers cut off, the rest as is."""
    if isinstance(target, T.DateType):
        if isinstance(source, T.DateType):
            return column
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            return column.cast("date")
        return tolerant_date(column)
    if isinstance(target, T.IntegralType) and isinstance(source, T.StringType):
        return tolerant_int(column, target.simpleString())
    if source == target:
        return column
    return column.try_cast(target)


def as_timestamp(value: Column | datetime | str) -> Column:
    """A point in time; text and naive datetimes are read in the session's time zone."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime) and value.tzinfo is not None:
        return F.lit(value)
    return F.lit(str(value)).cast("timestamp")
