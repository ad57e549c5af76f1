"""Faceted search: options, filters, pages and look-ups over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import NOT_REGISTERED, normalize_key
from ..functions.typing import COMPACT_DATE, tolerant_date

# Rows per page.
PAGE_ROWS = 25


@dataclass(frozen=True)
class FilterSpec:
    """What a user has chosen.  Nothing, an empty text or list, or a range left at its default filters nothing.

    Zero and False are choices.
    """

    equals: Mapping[str, object] = field(default_factory=dict)
    in_lists: Mapping[str, Sequence[object]] = field(default_factory=dict)
    ranges: Mapping[str, Sequence[float]] = field(default_factory=dict)
    defaults: Mapping[str, Sequence[float]] = field(default_factory=dict)
    # Upper ends that mean "this many or more".
    open_top: Mapping[str, float] = field(default_factory=dict)
    # Year ranges over compact dates; these always apply.
    years: Mapping[str, Sequence[int]] = field(default_factory=dict)

    def active(self) -> list[Column]:
        out = [F.col(c) == v for c, v in self.equals.items() if v is not None and v != ""]
        out += [F.col(c).isin(list(v)) for c, v in self.in_lists.items() if v]
        for name, chosen in self.ranges.items():
            if not chosen or list(chosen) == list(self.defaults.get(name, ())):
                continue
            low, high = chosen
            out.append(F.col(name) >= low)
            if self.open_top.get(name) != high:
                out.append(F.col(name) <= high)
        out += [year_between(F.col(c), *v) for c, v in self.years.items() if v]
        return out

    def predicate(self) -> Column:
        return reduce(and_, self.active(), F.lit(True))


def year_between(column: Column, first: int, last: int, fmt: str = COMPACT_DATE) -> Column:
    """The year of a compact date lies in the range; an unreadable date does not."""
    return F.year(tolerant_date(column, fmt)).between(first, last)


def _within_years(column: str, kind: str, first: int, last: int) -> Column:
    """Over compact text, a range of the text itself, which the scan understands, and the date behind it."""
    readable = year_between(F.col(column), first, last)
    if kind != "string" or not 1 <= first <= last <= 9999:
        return readable
    return (F.col(column) >= f"{first:04d}0101") & (F.col(column) <= f"{last:04d}1231") & readable


def year_range_filter(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows by year; over a real date column the range itself reaches the scan."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        start, stop = (F.lit(f"{year:04d}-01-01").cast("date").cast(kind) for year in (first, last + 1))
        return df.filter((F.col(column) >= start) & (F.col(column) < stop))
    return df.filter(_within_years(column, kind, first, last))


def facet_filter(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Rows that match; years come last, so that dates are read only where the cheap tests hold."""
    df = df.filter(replace(spec, years={}).predicate())
    for column, years in spec.years.items():
        if years:
            df = year_range_filter(df, column, *years)
    return df


def _usable(column: Column, sentinel: str | None) -> Column:
    usable = column.isNotNull() & (column != "")
    return usable & (column != sentinel) if sentinel else usable


def _facets(df: DataFrame, columns: Sequence[str], sentinel: str | None) -> DataFrame:
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "facet", "value").filter(_usable(F.col("value"), sentinel))


def facet_options(df: DataFrame, columns: Sequence[str], sentinel: str | None = NOT_REGISTERED) -> DataFrame:
    """Sorted distinct values of several columns, from one scan."""
    return _facets(df, columns, sentinel).distinct().orderBy("facet", "value")


def facet_counts(
    df: DataFrame, columns: Sequence[str], spec: FilterSpec, sentinel: str | None = NOT_REGISTERED
) -> DataFrame:
    """Rows per facet value under the current filter."""
    return _facets(facet_filter(df, spec), columns, sentinel).groupBy("facet", "value").agg(
        F.count("*").alias("n_rows")
    )


def sorted_options(df: DataFrame, column: str, sentinel: str | None = NOT_REGISTERED) -> DataFrame:
    text = F.col(column).cast("string")
    return df.select(text.alias("value")).filter(_usable(F.col("value"), sentinel)).distinct().orderBy("value")


def dependent_options(
    df: DataFrame, parent: str, child: str, selected: object | None = None, sentinel: str | None = NOT_REGISTERED
) -> DataFrame:
    """Distinct children of one parent, or of every parent, as sorted rows."""
    if selected is not None:
        df = df.filter(F.col(parent) == selected)
    value = F.col(child)
    kept = df.filter(F.col(parent).isNotNull() & _usable(value, sentinel) & (F.trim(value) != ""))
    return kept.select(parent, child).distinct().orderBy(parent, child)


def search_page(df: DataFrame, spec: FilterSpec, order_by: Sequence[str], n: int = PAGE_ROWS) -> DataFrame:
    """The first matches in order, each with the number of all matches.

    The page is a top-n without a full sort; the count is a scalar subquery that reads
    only the filtered columns.
    """
    matches = facet_filter(df, spec)
    page = matches.orderBy(*order_by).limit(n)
    return page.withColumn("n_matches", matches.agg(F.count("*")).scalar())


def key_lookup(df: DataFrame, key: str, raw: str | DataFrame) -> DataFrame:
    """Rows for one typed-in key, or for a frame of them in its first column.

    The stored key is compared as it is, so the scan can skip by it.
    """
    if isinstance(raw, str):
        return df.filter(F.col(key) == normalize_key(F.lit(raw))).limit(1)
    wanted = raw.select(normalize_key(F.col(raw.columns[0])).alias("__wanted"))
    return df.join(wanted, F.col(key) == F.col("__wanted"), "left_semi")


def random_rows(df: DataFrame, n: int, seed: int | str, key: Sequence[str]) -> DataFrame:
    """``n`` rows in an order that only the seed decides; a top-n, not a full sort."""
    mixed = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.withColumn("__mixed", mixed).orderBy("__mixed", *key).limit(n).drop("__mixed")


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)
