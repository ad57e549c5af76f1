"""Raw to typed: renaming, casting, selecting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SchemaMismatch, TableContract
from ..functions.names import snake_case
from ..functions.typing import COMPACT_DATE, tolerant_cast, tolerant_date

# Words that mark a date column.
DATE_WORDS = ("date", "datum")


def _reject_twice(names: list[str]) -> None:
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SchemaMismatch(f"column names collide: {twice}")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case names, in one renaming."""
    names = [snake_case(c) for c in df.columns]
    _reject_twice(names)
    return df.toDF(*names)


def apply_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rename and cast the declared columns; undeclared ones pass, absent ones are skipped.

    One projection, however many columns there are.
    """
    declared = contract.by_input()
    out = []
    names = []
    for field in df.schema:
        source = F.col(f"`{field.name}`")
        column = declared.get(field.name)
        if column is None:
            out.append(source)
            names.append(field.name)
        else:
            typed = tolerant_cast(source, field.dataType, column.data_type)
            metadata = {"comment": column.comment} if column.comment else {}
            out.append(typed.alias(column.output_col, metadata=metadata))
            names.append(column.output_col)
    _reject_twice(names)
    return df.select(*out)


def transform_bronze(df: DataFrame, contract: TableContract) -> DataFrame:
    return apply_contract(df, contract)


def convert_date_columns(df: DataFrame, epoch: bool = False) -> DataFrame:
    """Turn every column with a date word anywhere in its name into a date.

    This also catches names such as ``update_ts``, since they contain ``date``.
    """
    names = [c for c in df.columns if any(word in c.lower() for word in DATE_WORDS)]
    if not names:
        return df
    if epoch:
        seconds = {c: F.col(f"`{c}`").cast("string").try_cast("bigint") for c in names}
        return df.withColumns({c: F.timestamp_seconds(s).cast("date") for c, s in seconds.items()})
    return df.withColumns({c: tolerant_date(F.col(f"`{c}`"), COMPACT_DATE) for c in names})


def filter_key_length(df: DataFrame, length: int = 6, column: str | None = None) -> DataFrame:
    """Rows whose key, the first column by default, has the given length."""
    return df.filter(F.length(column or df.columns[0]) == length)


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"columns not found: {missing}")
    return df.select(*columns)
