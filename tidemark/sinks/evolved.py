"""Parquet tables whose columns may be added and whose types may widen from write to write.

The table's schema lies beside its rows, one line per change, so nobody opens the footers of all
files to learn it.  Rows are always written in the table's schema.  Older files are never rewritten:
a column they lack reads as NULL, and a narrower type is widened by the Parquet reader as it
reads.  An append adds its schema line first and its rows afterwards, an overwrite writes rows to a
folder of their own and adds the line last; so a run that died in between leaves a table that reads
as before.  One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import SchemaMismatch

_LINE = "n int, rows string, schema string"
# Whole digits from which the reader takes a file's column of the type for a decimal.
_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}
_WHOLE = list(_DIGITS)
_MOST_DIGITS = 38


def wider_type(a: T.DataType, b: T.DataType, where: str = "value") -> T.DataType:
    """The narrowest type that holds every value of both, unchanged; none is a ``SchemaMismatch``.

    Whole numbers widen to larger ones, to decimals and, up to 32 bits, to doubles; floats to doubles;
    decimals to more digits on either side; dates to timestamps without a zone.  Structs take the
    fields of both; arrays and maps widen by their elements.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema(a, b, f"{where}.")
    if kinds == {T.ArrayType}:
        return T.ArrayType(wider_type(a.elementType, b.elementType, f"{where}[]"))
    if kinds == {T.MapType}:
        key = wider_type(a.keyType, b.keyType, f"{where} key")
        return T.MapType(key, wider_type(a.valueType, b.valueType, f"{where} value"))
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE[:3], T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds <= {*_WHOLE, T.DecimalType}:
        scales = [getattr(t, "scale", 0) for t in (a, b)]
        whole = [t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[type(t)] for t in (a, b)]
        if max(whole) + max(scales) <= _MOST_DIGITS:
            return T.DecimalType(max(whole) + max(scales), max(scales))
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    raise SchemaMismatch(f"{where}: no type holds both {a.simpleString()} and {b.simpleString()}")


def wider_schema(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of ``a`` in their order and spelling, then those that only ``b`` has; all may be NULL."""
    other = {f.name.lower(): f for f in b}
    for schema in (a, b):
        if len({f.name.lower() for f in schema}) < len(schema):
            raise SchemaMismatch(f"columns named twice: {prefix}{schema.simpleString()}")
    fields = []
    for f in a:
        match = other.pop(f.name.lower(), None)
        kind = f.dataType if match is None else wider_type(f.dataType, match.dataType, prefix + f.name)
        fields.append(T.StructField(f.name, _nullable(kind), True, f.metadata))
    return T.StructType(fields + [T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in other.values()])


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LINE).parquet(f"{path}/schemas")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _last_line(spark: SparkSession, path: str) -> Row | None:
    lines = _lines(spark, path)
    return None if lines is None else lines.orderBy(F.desc("n")).first()


def _schema_of(line: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(line["schema"]))


def evolved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema, or None where there is no table."""
    line = _last_line(spark, path.rstrip("/"))
    return None if line is None else _schema_of(line)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All rows in the table's schema, whichever schema they were written in."""
    path = path.rstrip("/")
    line = _last_line(spark, path)
    if line is None:
        raise LookupError(f"no table at {path}")
    try:
        return spark.read.schema(_schema_of(line)).parquet(f"{path}/{line['rows']}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # the first append died before its rows
            raise
        return spark.createDataFrame([], _schema_of(line))


def _converted(have: T.DataType, want: T.DataType, value):
    """``value`` as ``want``, struct fields by name."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by_name = {f.name.lower(): f for f in have}
        parts = []
        for f in want:
            own = by_name.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if own is None else _converted(own.dataType, f.dataType, value.getField(own.name))
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _converted(have.elementType, want.elementType, x))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform_keys(value, lambda k, _: _converted(have.keyType, want.keyType, k))
        return F.transform_values(keys, lambda _, v: _converted(have.valueType, want.valueType, v))
    return value.cast(want)


def _as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    own = {f.name.lower(): f for f in df.schema}
    columns = []
    for f in schema:
        have = own.get(f.name.lower())
        quoted = None if have is None else F.col("`" + have.name.replace("`", "``") + "`")
        value = F.lit(None).cast(f.dataType) if have is None else _converted(have.dataType, f.dataType, quoted)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def save_evolved(
    df: DataFrame, path: str, mode: str = "append", merge_schema: bool = True, overwrite_schema: bool = False
) -> T.StructType:
    """Write ``df`` and return the table's schema.

    Columns are matched by name, without regard to case; those that ``df`` lacks become NULL.  With
    ``merge_schema`` new columns are added at the end and types widen by ``wider_type``; without it
    either is a ``SchemaMismatch``, found before anything is written.  ``mode="overwrite"`` replaces
    the rows, and with ``overwrite_schema`` the schema as well, whatever it was.  ``df`` may be read
    from the table that it overwrites.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode is append or overwrite, not {mode!r}")
    if overwrite_schema and mode != "overwrite":
        raise ValueError("only an overwrite can replace the schema")
    spark, path = df.sparkSession, path.rstrip("/")
    line = _last_line(spark, path)
    before = T.StructType([]) if line is None or overwrite_schema else _schema_of(line)
    schema = wider_schema(before, df.schema)
    if line is not None and not merge_schema and not overwrite_schema and schema != before:
        raise SchemaMismatch(f"schema change rejected: from {before.simpleString()} to {schema.simpleString()}")
    n = 1 if line is None else line["n"] + 1
    folder = f"rows/{n}" if line is None or mode == "overwrite" else line["rows"]
    changed = spark.createDataFrame([(n, folder, schema.json())], _LINE).coalesce(1)
    rows = _as_schema(df, schema)
    if line is not None and mode == "overwrite":
        rows.write.mode("overwrite").parquet(f"{path}/{folder}")
        changed.write.mode("append").parquet(f"{path}/schemas")
        # The rows before are given up; an empty table of their schema stays in their place.
        empty = spark.createDataFrame([], _schema_of(line))
        empty.write.mode("overwrite").parquet(f"{path}/{line['rows']}")
        return schema
    if line is None or schema != before:
        changed.write.mode("append").parquet(f"{path}/schemas")
    rows.write.mode("append").parquet(f"{path}/{folder}")
    return schema
