"""Declarative row checks: split a frame into valid and quarantined rows."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from operator import and_, or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..contracts import load_yaml

ERRORS = "_errors"
WARNINGS = "_warnings"
KEY_REPEATED = "pk_unique"
FUNCTIONS = ("is_not_null", "sql_expression")
CRITICALITIES = ("error", "warn")

_FINDINGS_TYPE = "array<struct<name:string,message:string>>"


@dataclass(frozen=True)
class Check:
    name: str
    criticality: str
    function: str
    arguments: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.function not in FUNCTIONS:
            raise ValueError(f"{self.name}: unknown function {self.function!r}")
        if self.criticality not in CRITICALITIES:
            raise ValueError(f"{self.name}: unknown criticality {self.criticality!r}")

    def fails(self) -> Column:
        """True where the row breaks the rule; a rule that evaluates to NULL passes."""
        if self.function == "is_not_null":
            return F.col(self.arguments["column"]).isNull()
        return ~F.coalesce(F.expr(self.arguments["expression"]), F.lit(True))

    def message(self) -> str:
        if self.function == "is_not_null":
            return f"{self.arguments['column']} is null"
        return self.arguments.get("msg") or self.arguments["expression"]


def is_not_null(column: str, criticality: str = "error", name: str | None = None) -> Check:
    return Check(name or f"{column}_not_null", criticality, "is_not_null", {"column": column})


def sql_check(name: str, expression: str, msg: str = "", criticality: str = "error") -> Check:
    return Check(name, criticality, "sql_expression", {"expression": expression, "msg": msg})


def _literal(value: object) -> str:
    """A value as SQL writes it."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, Decimal):
        return f"{value}BD" if value.is_finite() else f"CAST('{value}' AS DOUBLE)"
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"
    return str(value)


def _name(column: str) -> str:
    """A column's name as SQL writes it; dots lead into structs."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in column.split("."))


def in_list(column: str, values: Sequence[object], criticality: str = "error") -> Check:
    listed = ", ".join(_literal(v) for v in values)
    return sql_check(f"{column}_in_list", f"{_name(column)} IN ({listed})", f"{column} must be one of {listed}", criticality)


def in_range(column: str, low: object, high: object, criticality: str = "error") -> Check:
    return sql_check(
        f"{column}_in_range",
        f"{_name(column)} IS NULL OR {_name(column)} BETWEEN {_literal(low)} AND {_literal(high)}",
        f"{column} must lie between {low} and {high}",
        criticality,
    )


def cross_column(left: str, operator: str, right: str, criticality: str = "error") -> Check:
    if operator not in ("<", "<=", "=", "<>", ">=", ">"):
        raise ValueError(f"unknown comparison {operator!r}")
    return sql_check(
        f"{left}_vs_{right}",
        f"{_name(left)} IS NULL OR {_name(right)} IS NULL OR {_name(left)} {operator} {_name(right)}",
        f"{left} must be {operator} {right}",
        criticality,
    )


def not_future(column: str, today: str = "current_date()", criticality: str = "error") -> Check:
    return sql_check(
        f"{column}_not_future",
        f"{_name(column)} IS NULL OR {_name(column)} <= {today}",
        f"{column} lies in the future",
        criticality,
    )


def has_length(column: str, length: int, criticality: str = "error") -> Check:
    return sql_check(
        f"{column}_length_valid",
        f"LENGTH({_name(column)}) = {length}",
        f"{column} must be exactly {length} characters",
        criticality,
    )


def load_checks(source: str | Path) -> list[Check]:
    """Checks from YAML: a list of name, criticality and check (function, arguments)."""
    return [
        Check(e["name"], e["criticality"], e["check"]["function"], e["check"].get("arguments", {}))
        for e in load_yaml(source) or []
    ]


def _any(checks: Iterable[Check]) -> Column:
    return reduce(or_, [c.fails() for c in checks], F.lit(False))


def _finding(name: str, message: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(message).alias("message"))


def _findings(checks: Sequence[Check]) -> Column:
    rows = [F.when(c.fails(), _finding(c.name, c.message())) for c in checks]
    return F.array_compact(F.array(*rows)) if rows else F.array().cast(_FINDINGS_TYPE)


def annotate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add the failed checks of each row as two lists."""
    return df.withColumns(
        {
            ERRORS: _findings([c for c in checks if c.criticality == "error"]),
            WARNINGS: _findings([c for c in checks if c.criticality == "warn"]),
        }
    )


def annotate_with(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Add one given error to every row."""
    found = F.array(_finding(name, f"{', '.join(columns)} must be unique")).cast(_FINDINGS_TYPE)
    return df.withColumns({ERRORS: found, WARNINGS: F.array().cast(_FINDINGS_TYPE)})


def split(
    df: DataFrame, checks: Sequence[Check], quarantine_warnings: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): rows with a failed error check are quarantined only.

    Both sides are plain filters, so no shuffle, and the scan sees the predicates.
    """
    stopping = [c for c in checks if c.criticality == "error" or quarantine_warnings]
    failed = _any(stopping)
    return df.filter(~failed), annotate(df.filter(failed), checks)


# The partition column of a dealt table.
REJECTED = "__rejected"


@dataclass(frozen=True)
class Split:
    """Both sides of a dealt table and what was counted while it was written."""

    valid: DataFrame
    quarantined: DataFrame
    n_total: int
    n_quarantined: int
    n_failed: Mapping[str, int]
    observed: Mapping[str, object]


def save_split(
    df: DataFrame,
    checks: Sequence[Check],
    path: str,
    quarantine_warnings: bool = False,
    observe: Mapping[str, Column] | None = None,
) -> Split:
    """``split`` in one pass: rows are written once, dealt by verdict, and each side is read back by its folder.

    Totals and failures per check are counted while the rows are written, as are further aggregates
    given in ``observe``, which may ask for ``__rejected``.  ``df`` should be a table and narrow steps
    on it: then a task that is tried again is not counted twice.
    """
    stopping = [c for c in checks if c.criticality == "error" or quarantine_warnings]
    counted = Observation()
    failures = {f"__failed_{i}": F.count_if(c.fails()) for i, c in enumerate(checks)}
    asked = {f"__asked_{name}": value for name, value in (observe or {}).items()}
    totals = {"__n": F.count(F.lit(1)), "__n_rejected": F.count_if(REJECTED), **failures, **asked}
    dealt = df.withColumn(REJECTED, _any(stopping)).observe(counted, *[v.alias(k) for k, v in totals.items()])
    dealt.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    found = counted.get
    spark = df.sparkSession

    def side(rejected: bool) -> DataFrame:
        n = found["__n_rejected"] if rejected else found["__n"] - found["__n_rejected"]
        if not n:  # no rows, no folder
            return spark.createDataFrame([], df.schema)
        return spark.read.schema(df.schema).parquet(f"{path}/{REJECTED}={str(rejected).lower()}")

    return Split(
        side(False),
        annotate(side(True), checks),
        found["__n"],
        found["__n_rejected"],
        {c.name: found[f"__failed_{i}"] for i, c in enumerate(checks)},
        {name: found[f"__asked_{name}"] for name in observe or {}},
    )


def counted_split(
    df: DataFrame,
    checks: Sequence[Check],
    quarantine_warnings: bool = False,
    observe: Mapping[str, Column] | None = None,
) -> Split:
    """``split`` with the counts of ``save_split``, from one aggregate over ``df``; no row is written.

    For a table whose sides are read once or not at all: counting it costs a fraction of writing it again.
    """
    stopping = [c for c in checks if c.criticality == "error" or quarantine_warnings]
    failures = {f"__failed_{i}": F.count_if(c.fails()) for i, c in enumerate(checks)}
    asked = {f"__asked_{name}": value for name, value in (observe or {}).items()}
    totals = {"__n": F.count(F.lit(1)), "__n_rejected": F.count_if(REJECTED), **failures, **asked}
    found = df.withColumn(REJECTED, _any(stopping)).agg(*[v.alias(k) for k, v in totals.items()]).first()
    valid, quarantined = split(df, checks, quarantine_warnings)
    return Split(
        valid if found["__n_rejected"] else df,
        quarantined,
        found["__n"],
        found["__n_rejected"],
        {c.name: found[f"__failed_{i}"] for i, c in enumerate(checks)},
        {name: found[f"__asked_{name}"] for name in observe or {}},
    )


def warnings(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that stay valid but have a failed warning."""
    stop = _any(c for c in checks if c.criticality == "error")
    warn = _any(c for c in checks if c.criticality == "warn")
    return annotate(df.filter(~stop & warn), checks)


def summary(df: DataFrame, checks: Sequence[Check], quarantine_warnings: bool = False) -> DataFrame:
    """Failures per check plus two totals, from one scan of the checked columns only."""
    stopping = [c for c in checks if c.criticality == "error" or quarantine_warnings]
    counters = [F.count_if(c.fails()) for c in checks] + [F.count_if(_any(stopping)), F.count("*")]
    labels = [(c.name, c.criticality) for c in checks] + [("__quarantined", "total"), ("__rows", "total")]
    counted = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counters)])
    rows = [
        F.struct(
            F.lit(name).alias("check_name"), F.lit(criticality).alias("criticality"), F.col(f"n{i}").alias("n_rows")
        )
        for i, (name, criticality) in enumerate(labels)
    ]
    return counted.select(F.inline(F.array(*rows)))


def row_counts(df: DataFrame, checks: Sequence[Check], quarantine_warnings: bool = False) -> DataFrame:
    """One row: total, quarantined, valid."""
    stopping = [c for c in checks if c.criticality == "error" or quarantine_warnings]
    return df.agg(F.count("*").alias("n_total"), F.count_if(_any(stopping)).alias("n_quarantined")).withColumn(
        "n_valid", F.col("n_total") - F.col("n_quarantined")
    )


def key_audit(df: DataFrame, checks: Sequence[Check], keys: Sequence[str]) -> DataFrame:
    """``row_counts`` plus the most valid rows that share a complete key, from one scan.

    Rows are counted per key before the shuffle, so a hot key arrives as a few numbers.
    """
    failed = _any(c for c in checks if c.criticality == "error")
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__rows"), F.count_if(failed).alias("__failed"))
    return per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("n_total"),
        F.coalesce(F.sum("__failed"), F.lit(0)).alias("n_quarantined"),
        F.coalesce(F.sum(F.col("__rows") - F.col("__failed")), F.lit(0)).alias("n_valid"),
        F.coalesce(F.max(F.when(complete, F.col("__rows") - F.col("__failed"))), F.lit(0)).alias("most_per_key"),
    )


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is complete."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once.  Counting is partial before the shuffle, so hot keys are cheap."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


class RepeatedKey(ValueError):
    """Rows share a key that has to be unique."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any complete key occurs twice; ``split_unique`` sets such rows aside."""
    found = pk_violations(with_keys(df, keys), keys).limit(1).collect()
    if found:
        shown = ", ".join(f"{k}={found[0][k]!r}" for k in keys)
        raise RepeatedKey(f"{found[0]['n_rows']} rows share the key {shown}")


def split_unique(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique, rows sharing a key); rows without a key share nothing.

    The rows stay on the left of a semi/anti join: if one key is hot, adaptive execution
    splits its partition, and if no key repeats, the join disappears at run time.
    """
    repeated = pk_violations(with_keys(df, keys), keys).select(
        *[F.col(k).alias(f"__repeated_{i}") for i, k in enumerate(keys)]
    )
    # The null-safe comparison gives the right side a shuffle of its own, without which a
    # hot partition of the left could not be split.
    same = [F.col(k).eqNullSafe(F.col(f"__repeated_{i}")) for i, k in enumerate(keys)]
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def fk_orphans(
    child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str] | None = None
) -> DataFrame:
    """Child rows whose key has no parent; a NULL key passes.

    The child is the left side of an anti join, which adaptive execution can split on a hot key.
    """
    parent_cols = list(parent_cols or child_cols)
    wanted = parent.select(*[F.col(p).alias(f"__parent_{i}") for i, p in enumerate(parent_cols)])
    return with_keys(child, child_cols).join(
        wanted, [F.col(c) == F.col(f"__parent_{i}") for i, c in enumerate(child_cols)], "left_anti"
    )
