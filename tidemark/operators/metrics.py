"""Declared measures, grouped at query time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import load_yaml

# Periods of a time series and types of a query parameter.
PERIODS = ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
# Days or months from one period to the next.
PERIOD_STEPS = {"DAY": (1, 0), "WEEK": (7, 0), "MONTH": (0, 1), "QUARTER": (0, 3), "YEAR": (0, 12)}
PARAMETER_TYPES = {
    "STRING": str,
    "INTEGER": int,
    "DATE": date.fromisoformat,
    "DATETIME": datetime.fromisoformat,
    "NUMERIC": Decimal,
}


def _aggregates(measures: Mapping[str, str]) -> list:
    if not measures:
        raise ValueError("no measures")
    return [F.expr(text).alias(name) for name, text in measures.items()]


@dataclass(frozen=True)
class MetricView:
    """Named dimension and measure expressions over one source table."""

    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    source: str | None = None
    comment: str = ""
    comments: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_yaml(cls, source: str | Path) -> "MetricView":
        return cls.from_values(load_yaml(source))

    @classmethod
    def from_values(cls, d: Mapping) -> "MetricView":
        both = [*d.get("dimensions", []), *d["measures"]]
        return cls(
            dimensions={e["name"]: str(e["expr"]) for e in d.get("dimensions", [])},
            measures={e["name"]: str(e["expr"]) for e in d["measures"]},
            source=d.get("source"),
            comment=(d.get("comment") or "").strip(),
            comments={e["name"]: e["comment"] for e in both if e.get("comment")},
        )

    def query(
        self,
        df: DataFrame | SparkSession,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: str | None = None,
    ) -> DataFrame:
        """Filter, group by the chosen dimensions, aggregate; without dimensions one row.

        Pass the source's rows, or the session to read the declared source table.
        """
        rows = df if isinstance(df, DataFrame) else df.read.table(self.source)
        chosen = {m: self.measures[m] for m in (self.measures if measures is None else measures)}
        if where:
            rows = rows.filter(F.expr(where))
        groups = [F.expr(self.dimensions[d]).alias(d) for d in dimensions]
        return rows.groupBy(*groups).agg(*_aggregates(chosen))


def dash_agg(df: DataFrame, by: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*by).agg(*_aggregates(measures))


def kpi_row(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    return df.agg(*_aggregates(measures))


def time_series(
    df: DataFrame, ts: str, period: str, measures: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Measures per period, and per category if any are given."""
    if period.upper() not in PERIODS:
        raise ValueError(f"unknown period {period!r}; known: {', '.join(PERIODS)}")
    start = F.date_trunc(period.lower(), F.col(ts)).cast("date").alias("period")
    return df.groupBy(start, *by).agg(*_aggregates(measures))


def time_series_periods(
    df: DataFrame, ts: str, periods: Sequence[str], measures: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Measures for several granularities at once: one scan, one grouping."""
    unknown = [p for p in periods if p.upper() not in PERIODS]
    if unknown:
        raise ValueError(f"unknown periods {unknown}; known: {', '.join(PERIODS)}")
    starts = [
        F.struct(
            F.lit(p.upper()).alias("granularity"), F.date_trunc(p.lower(), F.col(ts)).cast("date").alias("period")
        )
        for p in periods
    ]
    each = df.withColumn("__start", F.explode(F.array(*starts)))
    each = each.withColumns({"granularity": F.col("__start.granularity"), "period": F.col("__start.period")})
    return each.groupBy("granularity", "period", *by).agg(*_aggregates(measures))


# Sketches of 2**14 buckets: a standard error of 0.65 %, so 3 % is beyond four of them.
SKETCH_BITS = 14
SKETCH_ERROR = 0.03


def distinct_cells(
    df: DataFrame, ts: str, columns: Sequence[str], by: Sequence[str] = (), period: str = "DAY", bits: int = SKETCH_BITS
) -> DataFrame:
    """One row per period and category: ``period``, ``n_rows`` and a HyperLogLog sketch per column.

    Sketches have a bounded size and can be merged, so a stored table of cells answers for any longer
    period or fewer categories without the rows.  A column's sketch is under its own name.
    """
    if period.upper() not in PERIODS:
        raise ValueError(f"unknown period {period!r}; known: {', '.join(PERIODS)}")
    start = F.date_trunc(period.lower(), F.col(ts)).cast("date").alias("period")
    # Sketches take whole numbers and text; the text of anything else is as distinct as the value.
    plain = ("integer", "long", "string", "binary")
    values = {c: F.col(c) if df.schema[c].dataType.typeName() in plain else F.col(c).cast("string") for c in columns}
    sketches = [F.hll_sketch_agg(v, bits).alias(c) for c, v in values.items()]
    return df.groupBy(start, *by).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def distinct_rollup(cells: DataFrame, columns: Sequence[str], period: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cells merged to a longer period, or over all time, and fewer categories: ``n_rows``, ``approx_<column>``.

    The estimate is within ``SKETCH_ERROR`` of the exact count (small counts are exact in practice).
    Weeks do not add up to longer periods: roll up from days.
    """
    if period is not None and period.upper() not in PERIODS:
        raise ValueError(f"unknown period {period!r}; known: {', '.join(PERIODS)}")
    start = [] if period is None else [F.date_trunc(period.lower(), F.col("period")).cast("date").alias("period")]
    merged = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"approx_{c}") for c in columns]
    return cells.groupBy(*start, *by).agg(F.sum("n_rows").alias("n_rows"), *merged)


def period_compare(
    df: DataFrame, ts: str, period: str, measure: str, by: Sequence[str] = (), name: str = "value"
) -> DataFrame:
    """A measure next to that of the period before, with difference and ratio.

    The window runs over the grouped series: one row per period, not over the data.  Where the
    period before has no rows, there is nothing to compare with.
    """
    series = time_series(df, ts, period, {name: measure}, by)
    in_order = Window.partitionBy(*by).orderBy("period")
    last = F.lag("period").over(in_order)
    days, months = PERIOD_STEPS[period.upper()]
    following = F.date_add(last, days) if days else F.add_months(last, months)
    before = F.when(following == F.col("period"), F.lag(name).over(in_order))
    return series.withColumn(f"previous_{name}", before).withColumns(
        {
            "change": F.col(name) - F.col(f"previous_{name}"),
            "ratio": F.try_divide(F.col(name), F.col(f"previous_{name}")),
        }
    )


@dataclass(frozen=True)
class Parameter:
    name: str
    type: str
    default: str | None = None

    def value(self, given: object | None) -> object | None:
        """The given text, or the default, as a value of the declared type."""
        chosen = self.default if given is None else given
        read = PARAMETER_TYPES[self.type]
        return read(chosen) if isinstance(chosen, str) else chosen


def param_query(
    spark: SparkSession,
    sql: str,
    parameters: Sequence[Parameter] = (),
    given: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """SQL with ``:name`` parameters, bound as values, and ``{name}`` for given frames."""
    given = dict(given or {})
    unknown = sorted(set(given) - {p.name for p in parameters})
    if unknown:
        raise ValueError(f"undeclared parameters: {unknown}")
    args = {p.name: p.value(given.get(p.name)) for p in parameters}
    return spark.sql(sql, args=args, **(tables or {}))
