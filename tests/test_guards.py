"""Nothing is lost, cut or taken silently."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.contracts import ColumnContract, ForeignKey, SchemaMismatch, TableContract
from tidemark.operators import explore, history as h, metrics, quality as q
from tidemark.plans import jobs
from tidemark.scratch import new_folder, shared_dir
from tidemark.sinks.history_store import HistoryStore
from tidemark.sinks.tables import save_named_table
from tidemark.sources.files import BAD_LINE, scan_csv, split_csv
from tidemark.sources.landing import folder_time


def frame(spark, values, ddl="k long, v string"):
    return spark.createDataFrame(values, ddl)


def stacked(spark, values):
    return frame(spark, values, "k long, v string, t string").withColumn("t", F.col("t").cast("timestamp"))


# --- replay ------------------------------------------------------------------------------


def test_replay_refuses_rows_of_no_known_time(spark):
    data = [(1, "a", "2024-01-01"), (1, "b", "2024-02-01"), (2, "a", None)]
    with pytest.raises(Exception, match="NULL or not one of"):
        h.replay(stacked(spark, data), ["k"], "t").collect()
    with pytest.raises(Exception, match="NULL or not one of"):
        h.replay(stacked(spark, data[:2]), ["k"], "t", times=["2024-01-01"]).collect()
    assert h.replay(stacked(spark, data[:2]), ["k"], "t").count() == 2


def test_replay_refuses_a_repeated_key(spark):
    data = [(1, "a", "2024-01-01"), (1, "b", "2024-01-01"), (2, "a", "2024-01-01")]
    with pytest.raises(Exception, match="repeats a key: k"):
        h.replay(stacked(spark, data), ["k"], "t").collect()
    # Rows without a key equal nothing, not even each other.
    assert h.replay(stacked(spark, [(None, "a", "2024-01-01")] * 2), ["k"], "t").count() == 2


def test_replay_over_many_years_follows_the_loop(spark):
    times = [f"{year}-{month:02d}-01" for year in range(1999, 2005) for month in (1, 6, 12)] + ["2011-03-01"]
    data = [(k, f"v{(i // (k + 1)) % 3}", t) for i, t in enumerate(times) for k in range(6) if (i + k) % 4]
    replayed = h.replay(stacked(spark, data), ["k"], "t", processed_time="2024-01-01")
    history = None
    for t in times:
        step = frame(spark, [(k, v) for k, v, at in data if at == t])
        history = h.apply_snapshot(history, step, ["k"], t, processed_time="2024-01-01")
        history = spark.createDataFrame(history.collect(), history.schema)
    kept = [c for c in history.columns if c != h.PROCESSED]
    assert rows(replayed, *kept) == rows(history, *kept)


def test_an_empty_snapshot_between_is_seen(spark):
    data = [(1, "a", "2024-01-01"), (1, "a", "2024-03-01")]
    got = h.replay(stacked(spark, data), ["k"], "t", times=["2024-01-01", "2024-02-01", "2024-03-01"])
    assert sorted((r[h.OPERATION], r[h.VERSION]) for r in got.collect()) == [("DELETE", 1), ("INSERT", 1)]


# --- CSV ---------------------------------------------------------------------------------


def write_text(spark, lines):
    path = new_folder(spark, "csv")
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("broken", ["1,2,3", "7", '5,"x'])
def test_lines_that_do_not_fit_are_not_cut(spark, broken):
    path = write_text(spark, ["a,b", "1,x", broken, '2,"y, z"'])
    with pytest.raises(Exception):  # noqa: B017 - the reader's own error, by kind of damage
        scan_csv(spark, path).select("a").collect()
    good, bad = split_csv(spark, path)
    assert rows(good) == [("1", "x"), ("2", "y, z")]
    assert bad.count() == 1 and broken.replace('"', "") in bad.first()[BAD_LINE].replace('"', "")
    assert rows(good.select("a")) == [("1",), ("2",)]


def test_line_breaks_in_quotes_need_multi_line(spark):
    path = write_text(spark, ["a,b", '5,"x', 'y"', "6,z"])
    good, bad = split_csv(spark, path)
    assert rows(good) == [("6", "z")] and bad.count() == 2
    assert rows(scan_csv(spark, path, multi_line=True)) == [("5", "x\ny"), ("6", "z")]


def test_folder_time_is_that_of_the_folder_above_the_table(spark):
    paths = ["/x/2020-01-01T0-0/land/2024-05-05T1-1/t.csv", "/x/2020-01-01T0-0/t.csv/part-0.csv", "/x/2020-01-01T0-0/land/t.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [str(r[0]) for r in df.select(folder_time(F.col("p"), "t")).collect()]
    assert got == ["2024-05-05 01:01:00", "2020-01-01 00:00:00", "None"]


# --- filters and checks ------------------------------------------------------------------


def test_zero_and_false_are_choices(spark):
    df = frame(spark, [(0, "a"), (1, "b")]).withColumn("f", F.col("k") == 1)
    assert explore.facet_filter(df, explore.FilterSpec(equals={"k": 0})).count() == 1
    assert explore.facet_filter(df, explore.FilterSpec(equals={"f": False})).count() == 1
    assert explore.facet_filter(df, explore.FilterSpec(equals={"v": "", "k": None})).count() == 2


def test_bounds_of_any_type(spark):
    values = [(date(2020, 1, 1), datetime(2020, 1, 1, 12), Decimal("1.50"), 0.5, "it's", True), (None,) * 6]
    df = spark.createDataFrame(values, "`a day` date, t timestamp, d decimal(5,2), f double, s string, b boolean")
    passing = [
        q.in_range("a day", date(2019, 1, 1), date(2021, 1, 1)),
        q.in_range("t", datetime(2020, 1, 1), datetime(2020, 1, 2)),
        q.in_range("d", Decimal("1.5"), Decimal("2")),
        q.in_range("f", 0.25, float("inf")),
        q.in_list("a day", [date(2020, 1, 1), None]),
        q.in_list("s", ["it's"]),
        q.in_list("b", [True]),
        q.has_length("s", 4),
        q.not_future("a day"),
        q.cross_column("a day", "<", "t"),
    ]
    assert q.split(df, passing)[1].count() == 0
    failing = [q.in_range("a day", date(2021, 1, 1), date(2022, 1, 1)), q.in_list("b", [False]), q.in_list("d", [Decimal("2")])]
    assert [len(r["_errors"]) for r in q.split(df, failing)[1].collect()] == [3]


def test_a_gap_has_no_period_before_it(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-03-01",), ("2024-04-30",), ("2024-04-01",)], "d string")
    df = df.withColumn("d", F.col("d").cast("timestamp"))
    for period, want in (("MONTH", [None, None, 1]), ("QUARTER", [None, 2]), ("YEAR", [None])):
        got = metrics.period_compare(df, "d", period, "COUNT(*)", name="n").orderBy("period").collect()
        assert [r["previous_n"] for r in got] == want


# --- histories ---------------------------------------------------------------------------


def test_merged_histories_have_one_current_row(spark):
    at = {"ts": "2024-01-01", "processed_time": "2024-01-01"}
    a = h.create_history_records(frame(spark, [(1, "x"), (1, "x"), (2, "y"), (None, "z"), (None, "z")]), h.INSERT, **at)
    b = h.create_history_records(frame(spark, [(1, "x"), (1, "w"), (2, "y")]), h.INSERT, **at)
    merged = h.merge_histories(a, b, ["k"])
    assert merged.count() == 8 and merged.columns == a.columns
    current = merged.filter(h.CURRENT)
    assert rows(current.groupBy("k").count()) == [(None, 1), (1, 1), (2, 1)]
    assert rows(current, "k", "v") == [(None, "z"), (1, "x"), (2, "y")]


def test_overlapping_versions_are_found(spark):
    ddl = f"k long, {h.FROM} string, {h.TO} string, {h.CURRENT} boolean, {h.VERSION} int"
    values = [
        (1, "2020-01-01", "2022-01-01", False, 1),
        (1, "2021-01-01", "2023-01-01", False, 1),
        (2, "2020-01-01", "2021-01-01", False, 1),
        (2, "2021-01-01", None, True, 2),
        (3, "2020-01-01", None, True, 1),
        (3, "2021-01-01", "2022-01-01", False, 2),
        *[(4, "2020-01-01", "2020-06-01", False, 1)] * 9,
    ]
    history = frame(spark, values, ddl).withColumns({c: F.col(c).cast("timestamp") for c in (h.FROM, h.TO)})
    found = {(r["k"], r["rule"], r["n_rows"]) for r in h.invariant_violations(history, ["k"]).collect()}
    assert found == {
        (1, "versions_do_not_overlap", 1),
        (3, "versions_do_not_overlap", 1),
        (3, "follows_previous_version", 1),
        (4, "more_rows_than_times", 9),
    }


def test_the_store_refuses_what_would_break_it(spark):
    store = HistoryStore(spark, new_folder(spark, "history"))
    store.merge(frame(spark, [(1, "a")]), ["k"], "2024-01-01")
    with pytest.raises(q.RepeatedKey, match="rows share the key k=1$"):
        store.merge(frame(spark, [(1, "b"), (1, "c")]), ["k"], "2024-02-01")
    with pytest.raises(ValueError, match="older than the history"):
        store.merge(frame(spark, [(1, "b")]), ["k"], "2023-01-01")
    with pytest.raises(SchemaMismatch, match="v from string to bigint"):
        store.merge(frame(spark, [(1, 5)], "k long, v long"), ["k"], "2024-02-01")
    assert store.read_all().count() == 1
    store.merge(frame(spark, [(1, "b"), (None, "x"), (None, "x")]), ["k"], "2024-02-01")
    assert store.read_all().count() == 4


def test_every_superseded_run_is_freed(spark):
    path = new_folder(spark, "history")
    for day in range(1, 5):
        HistoryStore(spark, path, keep=None).merge(frame(spark, [(1, "a"), (2, f"b{day}")]), ["k"], f"2024-01-0{day}")
    before = rows(HistoryStore(spark, path).read_all(), "k", "v", h.VERSION)
    store = HistoryStore(spark, path)
    store.merge(frame(spark, [(1, "a"), (2, "b4")]), ["k"], "2024-01-05")
    held = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows/gen=*/{h.CURRENT}=true")
    # The last dump changes nothing, so its run refers to the rows of the one before.
    assert rows(held.select("gen").distinct()) == [(4,)]
    assert rows(store.read_all(), "k", "v", h.VERSION) == before


CONTRACT = TableContract(
    "t", (ColumnContract("k", "k", "bigint", pk=True), ColumnContract("v", "v", fk=ForeignKey("p", "v"))), tracked=True
)


def test_silver_counts_repeats_and_orphans_and_ignores_the_file(spark):
    layers = jobs.Layers(new_folder(spark, "job"), "t")

    def run(values, ts):
        frame(spark, values, "k long, v string, _file_name string").write.mode("overwrite").parquet(layers.bronze)
        return jobs.job_silver(spark, CONTRACT, [], layers, ts, parents={"p": frame(spark, [(0, "a")]).select("v")})

    first = run([(1, "a", "f1"), (2, "b", "f1"), (3, "a", "f1"), (3, "a", "f1")], "2024-01-01")
    assert (first.n_total, first.n_quarantined, first.keys_unique, first.n_orphans) == (4, 2, False, {"v": 1})
    second = run([(1, "a", "f2"), (2, "c", "f2")], "2024-02-01")
    assert (second.n_quarantined, second.n_orphans) == (0, {"v": 1})
    history = HistoryStore(spark, layers.silver).read_all()
    assert rows(history, "k", "v", h.OPERATION, h.VERSION) == [
        (1, "a", "INSERT", 1), (2, "b", "INSERT", 1), (2, "c", "UPDATE", 2)
    ]


def test_comparing_snapshots_refuses_a_repeated_key(spark):
    folder = new_folder(spark, "compare")
    frame(spark, [(1, "a"), (1, "b")]).write.parquet(f"{folder}/new")
    with pytest.raises(q.RepeatedKey):
        jobs.compare_snapshots(spark, None, f"{folder}/new", ["k"], f"{folder}/out", "2024-01-01")


# --- tables and folders ------------------------------------------------------------------


def test_named_tables_keep_their_schema_and_comments(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tidemark_tests LOCATION '{new_folder(spark, 'catalog')}'")
    contract = TableContract("t", (ColumnContract("k", "k", "bigint", description="The key"),), description="A table")
    name = f"tidemark_tests.t_{abs(hash(new_folder(spark, 'x')))}"
    save_named_table(frame(spark, [(1, "a")]), name, contract=contract)
    save_named_table(frame(spark, [(2, "b")]), name, mode="append")
    with pytest.raises(SchemaMismatch):
        save_named_table(frame(spark, [(2,)], "k long"), name)
    assert rows(spark.read.table(name)) == [(1, "a"), (2, "b")]
    assert [c.description for c in spark.catalog.listColumns(name)] == ["The key", None]
    untracked = TableContract("u", contract.columns, description="Plain")
    layers = jobs.Layers(new_folder(spark, "job"), "u")
    other = f"{name}_u"
    assert jobs.job_prepare_silver(spark, untracked, layers, other)
    assert not jobs.job_prepare_silver(spark, untracked, layers, other)
    assert spark.read.table(other).count() == 0
    assert spark.catalog.listColumns(other)[0].description == "The key"


def test_working_tables_lie_where_the_executors_share(spark):
    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("__", "."): v for k, v in conf.items()}

    unset = Session(spark__sql__warehouse__dir="file:/warehouse/")
    assert shared_dir(unset) == "file:/warehouse/_work"
    named = Session(spark__checkpoint__dir="file:///shared/place/", spark__sql__warehouse__dir="file:/warehouse")
    assert new_folder(named, "x").startswith("file:///shared/place/tidemark/x-")
    assert shared_dir(spark)
