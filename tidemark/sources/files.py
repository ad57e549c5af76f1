"""Tables and files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

# Holds a line that does not fit the header.
BAD_LINE = "_bad_line"
# What no line holds: with it as separator and without quotes, the reader leaves lines whole.
_NO_SEPARATOR = "\x1e\x1f\x1e"
# What makes a line more than values and commas: quotes, escapes, and what the parser takes for no character.
_PARSED = ('"', "\\", "\0")
# A quoted text over more lines than this is taken for two stray quotes.
RECORD_LINES = 10_000

Paths = str | list[str]


def _header(spark: SparkSession, path: Paths) -> tuple[str, list[str]] | None:
    """The header line as text and its column names, or None where there is no line; only that line is read."""
    first = spark.read.text(path).first()
    if first is None:
        return None
    named = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return first["value"], named.columns


def _whole_lines(spark: SparkSession, path: Paths, header: str, with_file: bool = True) -> DataFrame:
    """``value``, a line without its break, and ``__file``; header lines are checked and left out."""
    options = {"header": True, "enforceSchema": False, "columnPruning": False, "sep": _NO_SEPARATOR, "quote": ""}
    layout = T.StructType([T.StructField(header, T.StringType())])
    lines = spark.read.options(**options).option("mode", "FAILFAST").schema(layout).csv(path)
    named = lines.toDF("value")
    return named.withColumn("__file", F.col("_metadata.file_path") if with_file else F.lit(None).cast("string"))


def _odd(line: Column) -> Column:
    """Whether a line holds an odd number of quotes: a quoted text begins or ends there, but not both."""
    count = F.length(F.regexp_replace(line, r'\\.|[^"]', ""))
    return F.when(line.contains('"'), count % 2 == 1).otherwise(F.lit(False))


def _records(spark: SparkSession, path: Paths, header: str, most: int = RECORD_LINES) -> DataFrame:
    """``value`` and ``__file`` of each record, which is one line or, where a quoted text goes on, several.

    Files without an open line pass as they are.  In the others, each block that a task reads counts
    its quotes by itself; a running total over the blocks, one row each, tells whether a quote is
    open where a block begins, and which line began it.  So a file is as many tasks as it has blocks,
    and only lines of records with breaks are grouped.  Where quotes do not pair up by the end of the file,
    or stay open for more than ``most`` lines, each line stands for itself.
    """
    lines = _whole_lines(spark, path, header)
    opened = stored(lines.filter(_odd(F.col("value"))).select("__file").distinct(), "open-files")
    if opened.isEmpty():
        return lines
    opened = opened.withColumnRenamed("__file", "__open_file")
    same_file = F.col("__file") == F.col("__open_file")
    closed = lines.join(opened, same_file, "left_anti")

    text = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
    )
    # Written, so that every later step sees the same numbers.
    text = stored(text.join(opened, same_file, "left_semi").withColumn("__odd", _odd(F.col("value")).cast("int")), "lines")
    in_block = Window.partitionBy("__file", "__block").orderBy("__id")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    text = text.withColumn("__odd_before", F.coalesce(F.sum("__odd").over(before), F.lit(0)) % 2)
    blocks = text.groupBy("__file", "__block").agg(
        (F.sum("__odd") % 2).alias("__parity"),
        # The last line that begins a record, should the block begin outside a quote or inside one.
        F.max(F.when(F.col("__odd_before") == 0, F.col("__id"))).alias("__last_outside"),
        F.max(F.when(F.col("__odd_before") == 1, F.col("__id"))).alias("__last_inside"),
    )
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__open_at", F.coalesce(F.sum("__parity").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("__last", F.when(F.col("__open_at") == 0, F.col("__last_outside")).otherwise(F.col("__last_inside")))
    blocks = blocks.select(
        F.col("__file").alias("__of_file"),
        F.col("__block").alias("__of_block"),
        "__open_at",
        F.last("__last", ignorenulls=True).over(earlier).alias("__carried"),
        (F.sum("__parity").over(Window.partitionBy("__file")) % 2 == 1).alias("__unpaired"),
    )
    placed = text.join(blocks, (F.col("__file") == F.col("__of_file")) & (F.col("__block") == F.col("__of_block")))
    goes_on = (F.col("__odd_before") + F.col("__open_at")) % 2 == 1
    begun = F.last(F.when(~F.col("__goes_on"), F.col("__id")), ignorenulls=True).over(so_far)
    other = F.raise_error(F.concat(F.lit("CSV header differs from the first file's: "), F.col("value"))).cast("boolean")
    placed = (
        placed.withColumn("__goes_on", goes_on)
        .withColumn("__begun", F.coalesce(begun, F.col("__carried")))
        .withColumn("__first", (F.col("__block") == 0) & (F.row_number().over(in_block) == 1))
        .withColumn("__broken", ~F.col("__unpaired") & (F.col("__goes_on") | (F.col("__odd") == 1)))
        .filter(F.when(~F.col("__first"), True).when(F.col("value") == F.lit(header), False).otherwise(other))
        .select("value", "__file", "__id", "__begun", "__broken")
    )
    placed = stored(placed, "records")
    broken, single = placed.filter("__broken"), placed.filter("NOT __broken")
    sizes = broken.groupBy("__file", "__begun").agg(F.count(F.lit(1)).alias("__n"))
    long = sizes.filter(F.col("__n") > most).select(F.col("__file").alias("__f"), F.col("__begun").alias("__b"))
    in_long = (F.col("__file") == F.col("__f")) & (F.col("__begun") == F.col("__b"))
    joined = broken.join(long, in_long, "left_anti").groupBy("__file", "__begun")
    joined = joined.agg(F.sort_array(F.collect_list(F.struct("__id", "value"))).alias("__lines"))
    joined = joined.select(F.array_join(F.col("__lines.value"), "\n").alias("value"), "__file")
    stray = broken.join(long, in_long, "left_semi")
    single = single.unionByName(stray).filter(F.trim("value") != "").select("value", "__file")
    return closed.unionByName(single).unionByName(joined)


def read_csv(spark: SparkSession, path: Paths, multi_line: bool = False, file_column: str | None = None) -> DataFrame:
    """CSV with a header line, every column as text, and ``_bad_line``: a line that does not fit, whole.

    Columns of a bad line are NULL, and ``_bad_line`` of a good one.  Lines are read once, as text;
    one with fields too many or too few, or with a quote that it opens and does not close, is bad.
    Without inference codes keep their leading zeros.  A file whose header differs from the first one's fails
    instead of shifting columns.

    With ``multi_line`` a quoted text may go on over line breaks (which become line feeds).  Large
    files are still read by many tasks; the lines are first searched for open quotes, and only files
    that have any are read again, in order.
    """
    found = _header(spark, path)
    if found is None:
        return spark.createDataFrame([], f"{BAD_LINE} string" + (f", {file_column} string" if file_column else ""))
    header, columns = found
    lines = _records(spark, path, header) if multi_line else _whole_lines(spark, path, header, file_column is not None)
    names = [f"c{i}" for i in range(len(columns))]
    ddl = ", ".join(f"{n} string" for n in [*names, BAD_LINE])
    # Several lines reach the parser only where a quoted text goes on.
    options = {"columnNameOfCorruptRecord": BAD_LINE, "mode": "PERMISSIVE", "multiLine": str(multi_line).lower()}
    # Most lines hold nothing but values and commas, and splitting is several times cheaper than the parser.
    plain = ~reduce(or_, [F.contains("value", F.lit(c)) for c in _PARSED])
    lines = lines.withColumn("__parts", F.when(plain, F.split("value", ",")))
    values = [F.nullif(F.get("__parts", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    split = F.struct(*values, F.lit(None).cast("string").alias(BAD_LINE))
    fits = F.size("__parts") == len(names)
    row = F.when(fits, split).otherwise(F.from_csv("value", ddl, options))
    # A generator, so that later filters look at the parsed row instead of parsing once more.
    parsed = lines.select("__file", "value", F.inline(F.array(row)))
    bad = F.when(F.col(BAD_LINE).isNotNull() | _odd(F.col("value")), F.col("value"))
    parsed = parsed.select("__file", *names, bad.alias(BAD_LINE))
    shown = [F.when(F.col(BAD_LINE).isNull(), F.col(n)).alias(c) for n, c in zip(names, columns)]
    file = [F.col("__file").alias(file_column)] if file_column else []
    return parsed.select(*shown, BAD_LINE, *file)


def scan_csv(spark: SparkSession, path: Paths, multi_line: bool = False, file_column: str | None = None) -> DataFrame:
    """As ``read_csv``, but a bad line is an error, whichever columns are used; in one pass."""
    rows = read_csv(spark, path, multi_line, file_column)
    text = F.concat(F.lit("MALFORMED_RECORD: a line does not fit the header or opens a quote: "), F.substring(BAD_LINE, 1, 200))
    refused = F.raise_error(text).cast("boolean")
    return rows.filter(F.when(F.col(BAD_LINE).isNull(), True).otherwise(refused)).drop(BAD_LINE)


def split_csv(spark: SparkSession, path: Paths, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of ``read_csv``; each of the two reads the files when it is used."""
    rows = read_csv(spark, path, multi_line)
    return rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE), rows.filter(F.col(BAD_LINE).isNotNull()).select(BAD_LINE)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def scan_parquet(spark: SparkSession, path: str | None, schema: T.StructType | None = None) -> DataFrame | None:
    """Parquet at ``path``; no path means there is no earlier snapshot."""
    if not path:
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def load_limited(
    df: DataFrame, equals: Mapping[str, object], order_by: list[Column | str], limit: int | None = None
) -> DataFrame:
    """Rows of one category; with a limit, the first ones in the given order."""
    for name, value in equals.items():
        df = df.filter(F.col(name) == value)
    return df.orderBy(*order_by).limit(limit) if limit else df
