"""A main table with the tables around it, joined by the keys that their contracts declare.

Satellites have a foreign key to the main table's primary key, code tables are what the main table's
own foreign keys lead to, and these may have code tables in turn.  Satellites are cut to one row a
key first, so the result has the main table's rows, each once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import SchemaMismatch, TableContract


@dataclass(frozen=True)
class Table:
    """A table of the star.

    ``order_by`` and ``measures`` are for satellites: the first row of a key in that order is shown, and
    expressions over all rows of a key, by name.  ``columns`` are those shown, by default all but the key.
    """

    contract: TableContract
    rows: DataFrame
    order_by: Sequence[str] = ()
    measures: Mapping[str, str] = field(default_factory=dict)
    columns: Sequence[str] | None = None


def _shown(table: Table, without: Sequence[str]) -> list[str]:
    names = [c.output_col for c in table.contract.columns if c.output_col in table.rows.columns]
    return [c for c in (names if table.columns is None else table.columns) if c not in without]


def _checked(df: DataFrame, added: Sequence[str], name: str) -> None:
    twice = sorted(set(df.columns) & set(added))
    if twice:
        raise SchemaMismatch(f"{name} brings {twice} a second time: give the table other prefixes or columns")


def _with_codes(df: DataFrame, contract: TableContract, prefix: str, tables: Mapping[str, Table], above: tuple[str, ...]) -> DataFrame:
    """Left joins with the code tables of ``contract``, each with its own code tables joined already."""
    for column, fk in contract.foreign_keys().items():
        mine = f"{prefix}{column}"
        if fk.table not in tables or mine not in df.columns:
            continue
        if fk.table in above:
            raise SchemaMismatch(f"foreign keys lead in a circle: {' -> '.join([*above, fk.table])}")
        code = tables[fk.table]
        label, key = f"{fk.table}_", f"__code_{len(above)}"
        rows = code.rows.select(
            F.col(fk.column).alias(key), *[F.col(c).alias(f"{label}{c}") for c in _shown(code, [fk.column])]
        )
        rows = _with_codes(rows, code.contract, label, tables, (*above, fk.table))
        added = [c for c in rows.columns if c != key]
        _checked(df, added, fk.table)
        # Rows are on the left, so a hot code can be split; whether codes are broadcast is left to their size.
        df = df.join(rows, F.col(mine) == F.col(key), "left").select(*df.columns, *added)
    return df


def _one_per_key(satellite: Table, columns: Sequence[str], label: str) -> DataFrame:
    """The satellite's first row of each key, its measures and its number of rows."""
    names = [f"__sat_{i}" for i in range(len(columns))]
    rows = satellite.rows.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))
    rows = rows.withColumns({n: F.col(c) for n, c in zip(names, columns)})
    measures = {"n_rows": "count(1)", **satellite.measures}
    counted = rows.groupBy(*names).agg(*[F.expr(e).alias(f"{label}{m}") for m, e in measures.items()])
    shown = _shown(satellite, columns) if satellite.order_by else []
    if not shown:
        return counted
    # The rank limit keeps one row a key on both sides of the shuffle.
    first = Window.partitionBy(*names).orderBy(*satellite.order_by)
    kept = rows.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1")
    kept = kept.select(*names, *[F.col(c).alias(f"{label}{c}") for c in shown])
    return kept.join(counted, names)


def enrich_star(main: Table, tables: Sequence[Table]) -> DataFrame:
    """The main table's rows with columns of every table that its contract or theirs connects with it.

    Columns come under ``<table>_``; a satellite also tells ``<table>_n_rows``, 0 where it has none.
    The main table is shuffled once for all its satellites, which are cut down by the same key; code
    tables small enough are broadcast, and otherwise take a shuffle each.  A NULL key finds nothing.
    Codes must be unique in their table.  Tables without a connection are an error.
    """
    by_name = {t.contract.name: t for t in tables}
    keys = main.contract.primary_keys()
    df, used = main.rows, {main.contract.name}
    for name, table in by_name.items():
        leads = {fk.column: c for c, fk in table.contract.foreign_keys().items() if fk.table == main.contract.name}
        if not leads:
            continue
        if sorted(leads) != sorted(keys):
            raise SchemaMismatch(f"{name} refers to {sorted(leads)} of {main.contract.name}, whose key is {keys}")
        label = f"{name}_"
        satellite = _one_per_key(table, [leads[k] for k in keys], label)
        added = [c for c in satellite.columns if not c.startswith("__sat_")]
        _checked(df, added, name)
        same = [F.col(k) == F.col(f"__sat_{i}") for i, k in enumerate(keys)]
        counts = F.coalesce(f"{label}n_rows", F.lit(0).cast("long")).alias(f"{label}n_rows")
        df = df.join(satellite, same, "left")
        df = df.select(*[c for c in df.columns if not c.startswith("__sat_") and c != f"{label}n_rows"], counts)
        used.add(name)
    reached = set(used)
    todo = [main.contract]
    while todo:
        for fk in todo.pop().foreign_keys().values():
            if fk.table in by_name and fk.table not in reached:
                reached.add(fk.table)
                todo.append(by_name[fk.table].contract)
    lost = sorted(set(by_name) - reached)
    if lost:
        raise SchemaMismatch(f"no declared key connects {lost} with {main.contract.name}")
    codes = {n: t for n, t in by_name.items() if n not in used}
    return _with_codes(df, main.contract, "", codes, (main.contract.name,))
