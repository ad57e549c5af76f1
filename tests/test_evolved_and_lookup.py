"""Tables with merged schemas, and tables laid out for look-ups by key."""

import datetime as dt
import re
import uuid
from decimal import Decimal

import pytest
from conftest import rows

from tidemark.contracts import SchemaMismatch
from tidemark.operators.explore import key_lookup
from tidemark.scratch import new_folder
from tidemark.sinks.evolved import evolved_schema, read_evolved, save_evolved
from tidemark.sinks.tables import save_for_lookup


def one(spark, kind, text):
    value = "NULL" if text is None else f"'{text}'"
    return spark.sql(f"SELECT CAST({value} AS {kind}) AS v, ARRAY(STRUCT(CAST({value} AS {kind}) AS q)) AS deep")


@pytest.mark.parametrize(
    "old, new, both, value",
    [
        ("tinyint", "bigint", "bigint", 7),
        ("bigint", "int", "bigint", 7),
        ("int", "double", "double", 7.0),
        ("float", "smallint", "double", 7.0),
        ("smallint", "decimal(5,1)", "decimal(11,1)", Decimal("7.0")),
        ("bigint", "decimal(5,1)", "decimal(21,1)", Decimal("7.0")),
        ("decimal(8,2)", "decimal(7,4)", "decimal(10,4)", Decimal("7.0000")),
    ],
)
def test_types_widen_over_old_files(spark, old, new, both, value):
    path = new_folder(spark, "evolved")
    save_evolved(one(spark, old, "7"), path)
    save_evolved(one(spark, new, "7"), path)
    save_evolved(one(spark, old, None), path)
    got = read_evolved(spark, path)
    assert got.schema["v"].dataType.simpleString() == both
    assert got.schema["deep"].dataType.simpleString() == f"array<struct<q:{both}>>"
    values = sorted((r["v"], r["deep"][0]["q"]) for r in got.filter("v IS NOT NULL").collect())
    assert values == [(value, value)] * 2 and got.count() == 3


def test_dates_become_timestamps(spark):
    path = new_folder(spark, "evolved")
    save_evolved(spark.sql("SELECT DATE '2024-02-03' AS d"), path)
    save_evolved(spark.sql("SELECT TIMESTAMP_NTZ '2024-02-03 04:00:00' AS d"), path)
    assert rows(read_evolved(spark, path)) == [(dt.datetime(2024, 2, 3),), (dt.datetime(2024, 2, 3, 4),)]


@pytest.mark.parametrize("old, new", [("bigint", "double"), ("string", "int"), ("date", "timestamp"), ("decimal(38,0)", "decimal(38,2)")])
def test_types_without_a_common_one_are_refused_before_writing(spark, old, new):
    path = new_folder(spark, "evolved")
    save_evolved(one(spark, old, None), path)
    with pytest.raises(SchemaMismatch):
        save_evolved(one(spark, new, None), path)
    assert read_evolved(spark, path).count() == 1


def test_columns_are_added_and_matched_by_name(spark):
    path = new_folder(spark, "evolved")
    save_evolved(spark.sql("SELECT 1 AS id, STRUCT(1 AS a) AS s"), path)
    save_evolved(spark.sql("SELECT STRUCT('x' AS b, 2L AS A) AS S, 2L AS ID, 'new' AS `odd.name`"), path)
    save_evolved(spark.sql("SELECT 3 AS id, CAST(NULL AS STRUCT<a: INT>) AS s"), path)
    got = read_evolved(spark, path)
    assert got.columns == ["id", "s", "odd.name"] and evolved_schema(spark, path) == got.schema
    assert got.schema["s"].dataType.simpleString() == "struct<a:bigint,b:string>"
    found = {r["id"]: (r["s"] and tuple(r["s"]), r["odd.name"]) for r in got.collect()}
    assert found == {1: ((1, None), None), 2: ((2, "x"), "new"), 3: (None, None)}


def test_without_merging_a_change_is_refused(spark):
    path = new_folder(spark, "evolved")
    save_evolved(spark.sql("SELECT 1L AS id, 'x' AS t"), path, merge_schema=False)
    save_evolved(spark.sql("SELECT 2 AS id"), path, merge_schema=False)  # narrower, and one is missing
    for change in ("SELECT 1 AS id, 2 AS n", "SELECT CAST(1 AS DECIMAL(22,1)) AS id"):
        with pytest.raises(SchemaMismatch):
            save_evolved(spark.sql(change), path, merge_schema=False)
    assert rows(read_evolved(spark, path)) == [(1, "x"), (2, None)]
    with pytest.raises(SchemaMismatch):
        save_evolved(spark.sql("SELECT 1 AS a, 2 AS A"), new_folder(spark, "evolved"))


def test_overwriting(spark):
    path = new_folder(spark, "evolved")
    save_evolved(spark.sql("SELECT 1 AS id, 'x' AS t"), path)
    # From what the table itself holds; the schema is merged.
    save_evolved(read_evolved(spark, path).selectExpr("CAST(id AS BIGINT) + 1 AS id"), path, mode="overwrite")
    assert rows(read_evolved(spark, path)) == [(2, None)]
    save_evolved(spark.sql("SELECT 'text' AS id"), path, mode="overwrite", overwrite_schema=True)
    save_evolved(spark.createDataFrame([], "id string, more int"), path)
    assert rows(read_evolved(spark, path)) == [("text", None)]
    with pytest.raises(ValueError):
        save_evolved(spark.range(1), path, overwrite_schema=True)


def test_a_run_that_died_leaves_the_table_as_it_was(spark):
    path = new_folder(spark, "evolved")
    with pytest.raises(LookupError):
        read_evolved(spark, path)
    save_evolved(spark.sql("SELECT 1 AS id"), path)
    broken = spark.sql("SELECT RAISE_ERROR('lost') AS text, 5L AS id")
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            save_evolved(broken, path, mode=mode)
        assert rows(read_evolved(spark, path).select("id")) == [(1,)]
    assert rows(save_evolved(spark.sql("SELECT 2 AS id"), path) and read_evolved(spark, path).select("id")) == [(1,), (2,)]
    fresh = new_folder(spark, "evolved")
    with pytest.raises(Exception, match="lost"):
        save_evolved(broken, fresh)
    assert read_evolved(spark, fresh).count() == 0


def test_filters_and_columns_reach_the_scan(spark):
    path = new_folder(spark, "evolved")
    save_evolved(spark.range(10).selectExpr("CAST(id AS INT) AS id", "id AS other"), path)
    save_evolved(spark.range(10, 20), path)
    picked = read_evolved(spark, path).filter("id = 3").select("id")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan and "ReadSchema: struct<id:bigint>" in plan and rows(picked) == [(3,)]


# --- look-ups -----------------------------------------------------------------------------


@pytest.fixture
def gold(spark):
    name = f"tidemark_lookup_{uuid.uuid4().hex}"
    data = spark.range(4000).selectExpr("CONCAT('AB', LPAD(id, 6, '0')) AS key", "id AS n")
    save_for_lookup(data.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS key, -1L AS n")), name, "key", 16, new_folder(spark, "lookup"))
    yield spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")


def test_a_look_up_opens_one_file(spark, gold):
    files = gold.selectExpr("_metadata.file_path AS f").distinct().count()
    assert files == 16 and gold.count() == 4001
    found = key_lookup(gold, "key", " ab-0007 77")
    assert rows(found) == [("AB000777", 777)] and files_opened(found) == 1
    assert files_opened(gold.filter("n = 777")) == 16
    assert rows(key_lookup(gold, "key", "none")) == []


def files_opened(df):
    """Files that the tasks of the only scan are given."""
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    parts = node.inputRDD().filePartitions()
    return sum(len(parts.apply(i).files()) for i in range(parts.size()))


def test_rows_lie_in_key_order_with_bloom_filters(spark, gold):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for (path,) in rows(gold.selectExpr("_metadata.file_path AS f").distinct()):
        # One task reads so small a file, front to back.
        keys = [k for (k,) in spark.read.parquet(path).filter("key IS NOT NULL").select("key").collect()]
        assert keys == sorted(keys) and keys
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        offsets = [c.getBloomFilterOffset() for c in reader.getFooter().getBlocks().get(0).getColumns()]
        reader.close()
        assert offsets[0] > 0 and offsets[1] <= 0


def test_many_keys_move_only_their_own_side(spark, gold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.range(0, 8000, 50).selectExpr("CONCAT('ab ', LPAD(id, 6, '0')) AS typed")
        found = key_lookup(gold, "key", wanted.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS typed")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("Exchange hashpartitioning", plan)) == 1
        assert rows(found.select("n"), "n") == sorted([(i,) for i in range(0, 4000, 50)], key=lambda t: str(t[0]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
