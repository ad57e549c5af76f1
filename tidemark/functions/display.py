"""Values as people read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .typing import tolerant_date

# Placeholder texts and units.
UNKNOWN = "Unknown"
NOT_REGISTERED = "Niet geregistreerd"
UNIT_SUFFIX = {"kg": "kg", "mm": "mm", "kmh": "km/h", "kw": "kW", "gkm": "g/km", "count": ""}
DISPLAY_DATE = "MMMM dd, yyyy"
KINDS = ("text", "date", "year", "cc", *UNIT_SUFFIX, "number")

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Within a run of four or more letters, two letters with another letter behind them.
_LETTER_PAIR = r"(?:(?<![A-Za-z])(?=[A-Za-z]{4})|\G(?!^))([A-Za-z]{2})(?=[A-Za-z])"
_LETTER_DIGIT_BORDER = r"(?<=[A-Za-z])(?=\d)|(?<=\d)(?=[A-Za-z])"


def format_key(column: Column) -> Column:
    """Dashes at letter/digit borders, and inside letter runs of four or more after each pair."""
    paired = F.regexp_replace(column, _LETTER_PAIR, "$1-")
    dashed = F.regexp_replace(paired, _LETTER_DIGIT_BORDER, "-")
    return F.when(column == UNKNOWN, column).otherwise(dashed)


def normalize_key(column: Column) -> Column:
    """Trimmed, without dashes and spaces, upper case."""
    return F.upper(F.translate(F.trim(column), "- ", ""))


def as_number(column: Column) -> Column:
    """Plain numeric text as a double, else NULL."""
    text = column.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def _digits(number: Column) -> Column:
    """A double's whole part as text; beyond bigint a decimal keeps all digits."""
    whole = number.try_cast("bigint").cast("string")
    return F.coalesce(whole, (number - number % 1).try_cast("decimal(38,0)").cast("string"))


def _engine_size(number: Column) -> Column:
    cc = number.try_cast("bigint")
    # format_number rounds the binary value half-even, as printf does.
    one_decimal = F.call_function("format_number", cc / 1000, F.lit("0.0"))
    litres = F.when(cc % 1000 == 0, F.call_function("div", cc, F.lit(1000)).cast("string")).otherwise(one_decimal)
    return F.when(cc < 1000, F.concat(cc.cast("string"), F.lit("cc"))).otherwise(F.concat(litres, F.lit("L")))


def format_value(column: Column, kind: str = "number") -> Column:
    """Show a value by its kind; text that cannot be read as that kind stays as it is.

    Only the year of an unreadable date is left out.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}; known: {', '.join(KINDS)}")
    text = column.cast("string")
    if kind == "text":
        return text
    if kind in ("date", "year"):
        iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))
        day = F.coalesce(tolerant_date(text), iso)
        return F.year(day).cast("string") if kind == "year" else F.coalesce(F.date_format(day, DISPLAY_DATE), text)
    return format_number_as(as_number(column), text, kind)


def format_number_as(number: Column, text: Column, kind: str) -> Column:
    """A number that has been read from ``text`` already; without a number the text stays."""
    if kind == "cc":
        shown = _engine_size(number)
    elif kind == "number":
        shown = _digits(F.rint(number))
    else:
        shown = F.concat(_digits(number), F.lit(UNIT_SUFFIX[kind]))
    return F.coalesce(shown, text)
