"""Table contracts: what a source column is called, what it becomes, and which keys hold."""

from __future__ import annotations

from dataclasses import dataclass, replace
from pathlib import Path
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A frame does not have the columns or types its target requires."""


class UnknownTable(LookupError):
    """No contract with that name."""


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str


@dataclass(frozen=True)
class ColumnContract:
    input_col: str
    output_col: str
    dtype: T.DataType | str = "string"
    nullable: bool = True
    pk: bool = False
    fk: ForeignKey | str | None = None
    description: str | None = None

    def __post_init__(self):
        # A bare table name means: the column has the same name over there.
        if isinstance(self.fk, str):
            object.__setattr__(self, "fk", ForeignKey(self.fk, self.output_col))

    @property
    def data_type(self) -> T.DataType:
        return self.dtype if isinstance(self.dtype, T.DataType) else T.DataType.fromDDL(self.dtype)

    @property
    def comment(self) -> str:
        return (self.description or "").replace("'", "")

    def field(self) -> T.StructField:
        metadata = {"comment": self.comment} if self.comment else None
        return T.StructField(self.output_col, self.data_type, self.nullable, metadata)


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnContract, ...]
    tracked: bool = False
    description: str = ""
    url: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        names = [c.output_col for c in self.columns]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise SchemaMismatch(f"{self.name}: columns declared twice: {twice}")
        if self.tracked and not any(c.pk for c in self.columns):
            raise SchemaMismatch(f"{self.name}: history needs a primary key")

    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.columns])

    def primary_keys(self) -> list[str]:
        return [c.output_col for c in self.columns if c.pk]

    def foreign_keys(self) -> dict[str, ForeignKey]:
        return {c.output_col: c.fk for c in self.columns if c.fk}

    def by_input(self) -> dict[str, ColumnContract]:
        return {c.input_col: c for c in self.columns}


# History columns, their order, types and comments.
HISTORY_COLUMNS = {
    "__valid_from": ("timestamp", "SCD2: Timestamp when this record version became valid"),
    "__valid_to": ("timestamp", "SCD2: Timestamp when this record version became invalid (NULL for current records)"),
    "__is_current": ("boolean", "SCD2: Boolean flag indicating if this is the current version of the record"),
    "__operation": ("string", "SCD2: Type of operation that created this record (INSERT, UPDATE, DELETE)"),
    "__processed_time": ("timestamp", "SCD2: Timestamp when this record was processed into the table"),
    "__row_hash": ("string", "SCD2: MD5 hash of tracked columns for change detection"),
    "__version": ("int", "SCD2: Version number of this record (increments with each update)"),
}


def history_schema(contract: TableContract) -> T.StructType:
    extra = [
        T.StructField(name, T.DataType.fromDDL(ddl), True, {"comment": comment})
        for name, (ddl, comment) in HISTORY_COLUMNS.items()
    ]
    return T.StructType(contract.schema().fields + extra)


def empty_table(spark: SparkSession, contract: TableContract, scd2: bool = False) -> DataFrame:
    return spark.createDataFrame([], history_schema(contract) if scd2 else contract.schema())


def with_comments(df: DataFrame, contract: TableContract) -> DataFrame:
    """Attach the contract's descriptions to the columns that are present."""
    for column in contract.columns:
        if column.comment and column.output_col in df.columns:
            df = df.withMetadata(column.output_col, {"comment": column.comment})
    return df


def comment_statements(contract: TableContract, table: str, scd2: bool = False) -> list[str]:
    """Statements that put the table's and its columns' descriptions into a catalog."""
    comments = {c.output_col: c.comment for c in contract.columns if c.comment}
    if scd2:
        comments.update({name: comment for name, (_, comment) in HISTORY_COLUMNS.items()})
    described = contract.description.replace("'", "")
    out = [f"COMMENT ON TABLE {table} IS '{described}'"] if described else []
    return out + [f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT '{text}'" for c, text in comments.items()]


def apply_comments(spark: SparkSession, contract: TableContract, table: str, scd2: bool = False) -> None:
    for statement in comment_statements(contract, table, scd2):
        spark.sql(statement)


def assert_compatible(df: DataFrame, schema: T.StructType) -> None:
    """Same names, same order, same types.  Nullability is left to the quality checks."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    if have != want:
        missing = [w for w in want if w not in have]
        extra = [h for h in have if h not in want]
        detail = f"missing {missing}, unexpected {extra}" if missing or extra else "other column order"
        raise SchemaMismatch(f"schema change rejected: {detail}")


def find_contract(contracts: Iterable[TableContract], name: str) -> TableContract:
    contracts = list(contracts)
    for contract in contracts:
        if contract.name == name:
            return contract
    raise UnknownTable(f"no table {name!r}; known: {', '.join(sorted(c.name for c in contracts))}")


def load_yaml(source: str | Path):
    """Parse YAML text, or a YAML file when ``source`` is a path."""
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - only without PyYAML
        raise RuntimeError("reading YAML needs the PyYAML package") from error
    is_path = isinstance(source, Path) or "\n" not in source
    return yaml.safe_load(Path(source).read_text() if is_path else source)


def contracts_from_yaml(source: str | Path) -> list[TableContract]:
    return contracts_from_entries(load_yaml(source))


def contracts_from_entries(entries: Iterable[dict]) -> list[TableContract]:
    """One entry per table; a column is ``[input, output, type, pk|fk=table]``, the last two optional."""
    out = []
    for entry in entries:
        columns = []
        for input_col, output_col, *rest in entry["columns"]:
            column = ColumnContract(input_col, output_col, rest[0] if rest else "string")
            role = rest[1] if len(rest) > 1 else ""
            if role == "pk":
                column = replace(column, pk=True, nullable=False)
            elif role.startswith("fk="):
                column = replace(column, fk=ForeignKey(role[3:], output_col))
            columns.append(column)
        out.append(
            TableContract(
                entry["name"],
                tuple(columns),
                entry.get("tracked", False),
                entry.get("description", ""),
                entry.get("url"),
            )
        )
    return out
