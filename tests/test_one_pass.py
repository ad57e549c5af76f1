"""One pass where one is enough: CSV lines, the silver split, key guards, and snapshots that change nothing."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import NO_BROADCAST, plan, settings, shuffles

from tidemark.contracts import ColumnContract, TableContract
from tidemark.operators import history as h
from tidemark.operators import quality
from tidemark.plans import jobs
from tidemark.plans.queries.snapshots import KEYS, TIMES, snapshot
from tidemark.scratch import stored
from tidemark.sinks.history_store import HistoryStore
from tidemark.sources.files import BAD_LINE, read_csv, scan_csv, split_csv

T1, T2, T3, T4 = "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"
THINGS = TableContract(
    "things",
    (ColumnContract("Id", "id", "int", nullable=False, pk=True), ColumnContract("Name", "name"), ColumnContract("N", "n", "int")),
    tracked=True,
)
CHECKS = [quality.is_not_null("id"), quality.in_range("n", 0, 100), quality.in_list("name", ["a", "b"], "warn")]


# --- CSV ---------------------------------------------------------------------------------


def test_csv_is_parsed_once_in_one_scan(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2\n")
    text = plan(scan_csv(spark, f"{tmp_path}/t.csv").select("a"))
    assert text.count("FileScan") == 1 and text.count("from_csv") == 1 and shuffles(scan_csv(spark, f"{tmp_path}/t.csv")) == 0
    good, bad = split_csv(spark, f"{tmp_path}/t.csv")
    assert all(plan(df).count("from_csv") == 1 and shuffles(df) == 0 for df in (good, bad))


def test_lines_are_kept_whole(spark, tmp_path):
    lines = ['a,"b x",c', '1,"x, y",3', "", '4,"open,5', " 5 , six ,7,8", "6,,ü", '7,5" pipe,z', "8,\\\",z", "   "]
    (tmp_path / "t.csv").write_text("\r\n".join(lines))
    df = read_csv(spark, f"{tmp_path}/t.csv")
    assert df.columns == ["a", "b x", "c", BAD_LINE]
    good, bad = split_csv(spark, f"{tmp_path}/t.csv")
    assert rows(good) == [("1", "x, y", "3"), ("6", None, "ü"), ("8", '\\"', "z")]
    assert sorted(r[0] for r in bad.collect()) == sorted([lines[3], lines[4], lines[6]])


def test_no_lines_and_header_alone(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_csv(spark, f"{tmp_path}/none.csv").count() == 0
    assert scan_csv(spark, f"{tmp_path}/head.csv").columns == ["a", "b"] and scan_csv(spark, f"{tmp_path}/head.csv").count() == 0


SMALL = {"spark__sql__files__maxPartitionBytes": "700", "spark__sql__files__openCostInBytes": "10"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_line_breaks_over_many_blocks(spark, tmp_path, seed):
    """The rows of Spark's own reader of whole files, from many tasks."""
    draw = random.Random(seed)

    def field():
        kind = draw.random()
        if kind < 0.3:
            return '"' + "\n".join(draw.choice(["x, y", "", " p ", "line"]) for _ in range(draw.choice([1, 2, 3, 40]))) + '"'
        return draw.choice(["plain", "", '"quoted"', "7"])

    for name, n in (("a", 200), ("b", 5), ("plain", 0)):
        records = [f"{i},{field()},{field()}" for i in range(n)] if n else ["1,x,y"] * 50
        (tmp_path / "t.csv").mkdir(exist_ok=True)
        (tmp_path / "t.csv" / f"{name}.csv").write_text("\n".join(["k,v,w", *records]) + "\n")
    path = f"{tmp_path}/t.csv"
    want = spark.read.options(header=True, multiLine=True).schema("k string, v string, w string").csv(path)
    with settings(spark, **SMALL):
        got = stored(scan_csv(spark, path, multi_line=True), "csv")
        assert spark.read.text(path).rdd.getNumPartitions() >= 8
    assert rows(got) == rows(want) and got.filter("v LIKE '%\n%'").count() > 20


def test_quotes_that_do_not_pair_up(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "a.csv").write_text('k,v\n1,"x\n2,y\n3,z\n')
    (tmp_path / "t.csv" / "b.csv").write_text('k,v\n4,"x\ny"\n5,z\n')
    good, bad = split_csv(spark, f"{tmp_path}/t.csv", multi_line=True)
    assert rows(good) == [("2", "y"), ("3", "z"), ("4", "x\ny"), ("5", "z")]
    assert [r[0] for r in bad.collect()] == ['1,"x']
    (tmp_path / "t.csv" / "c.csv").write_text('v,k\n4,"x\ny"\n')
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, f"{tmp_path}/t.csv", multi_line=True).collect()


# --- the split ---------------------------------------------------------------------------


def things(spark, data):
    return spark.createDataFrame(data, "id int, name string, n int")


def test_split_is_one_write_with_its_counts(spark, tmp_path):
    df = things(spark, [(1, "a", 1), (None, "a", 2), (3, "c", 300), (4, "c", 4), (None, "b", -1)])
    df = stored(df, "things")
    valid, quarantined = quality.split(df, CHECKS)
    dealt = quality.save_split(df, CHECKS, f"{tmp_path}/dealt", observe={"most": F.max("n")})
    assert rows(dealt.valid) == rows(valid) and rows(dealt.quarantined) == rows(quarantined)
    assert dealt.valid.columns == df.columns and dealt.quarantined.columns == quarantined.columns
    assert (dealt.n_total, dealt.n_quarantined, dealt.observed["most"]) == (5, 3, 300)
    counted = {r["check_name"]: r["n_rows"] for r in quality.summary(df, CHECKS).collect()}
    assert dict(dealt.n_failed) == {c.name: counted[c.name] for c in CHECKS}
    none = quality.save_split(df.limit(0), CHECKS, f"{tmp_path}/none")
    assert none.valid.count() == none.quarantined.count() == none.n_total == 0


def csv(folder, lines, name="things"):
    folder.mkdir(parents=True)
    (folder / f"{name}.csv").write_text("\n".join(["Id,Name,N", *lines]) + "\n")




def test_bronze_and_silver_read_their_input_once(spark, tmp_path):
    """Clean files are read by the header's line and one scan; bronze by one scan."""
    csv(tmp_path / "landing" / "2024-01-01T0-0", ["1,a,1", "2,b,2"])
    layers = jobs.Layers(f"{tmp_path}/out", "things")
    scans = []
    original = spark._jsparkSession.sharedState().statusStore()

    def record(run):
        n = int(original.executionsCount())
        run()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        executions = original.executionsList()
        texts = [executions.apply(i).physicalPlanDescription() for i in range(n, executions.size())]
        scans.append([t for t in texts if "InsertIntoHadoopFsRelation" in t])

    record(lambda: jobs.job_bronze(spark, THINGS, f"{tmp_path}/landing", layers))
    assert len(scans[0]) == 1 and scans[0][0].count("Location: InMemoryFileIndex") == 1
    record(lambda: jobs.job_silver(spark, THINGS, CHECKS, layers, T1))
    assert sum(t.count("/bronze/things]") for t in scans[1]) == 1


def test_silver_counts_and_sets_aside(spark, tmp_path):
    layers = jobs.Layers(f"{tmp_path}/out", "things")
    csv(tmp_path / "landing" / "2024-01-01T0-0", ["1,a,1", "2,b,2", ",a,3", "4,a,400", "5"])
    jobs.job_bronze(spark, THINGS, f"{tmp_path}/landing", layers)
    assert rows(spark.read.parquet(layers.bad_lines)) == [("5",)]
    first = jobs.job_silver(spark, THINGS, CHECKS, layers, T1)
    assert (first.n_total, first.n_quarantined, first.keys_unique, first.gen) == (4, 2, True, 1)
    csv(tmp_path / "landing" / "2024-02-01T0-0", ["1,a,1", "2,b,3", "2,b,4", "3,a,1", ",a,3"])
    jobs.job_bronze(spark, THINGS, f"{tmp_path}/landing", layers)
    second = jobs.job_silver(spark, THINGS, CHECKS, layers, T2)
    assert (second.n_total, second.n_quarantined, second.keys_unique, second.gen) == (5, 3, False, 2)
    assert spark.read.parquet(layers.quarantine).count() == 3
    current = HistoryStore(spark, layers.silver).current_records()
    assert rows(current) == [(1, "a", 1), (3, "a", 1)]


# --- repeated keys within the join -------------------------------------------------------


def test_the_guard_costs_no_shuffle_and_no_sort(spark, sf_dir):
    with settings(spark, **NO_BROADCAST):
        before = h.initial_load(snapshot(spark, sf_dir, "b"), KEYS, TIMES["b"])
        guarded = h.next_versions(before, snapshot(spark, sf_dir, "c"), KEYS, TIMES["c"])
        trusted = h.next_versions(before, snapshot(spark, sf_dir, "c"), KEYS, TIMES["c"], keys_unique=True)
        assert shuffles(guarded) == shuffles(trusted) == 2
        assert plan(guarded).count("Sort [") == plan(trusted).count("Sort [") == 2
    assert rows(guarded.drop(h.PROCESSED)) == rows(trusted.drop(h.PROCESSED))


@pytest.mark.parametrize("step", ["detect", "apply", "process"])
def test_repeated_keys_are_refused(spark, step):
    old, new = things(spark, [(1, "a", 1)]), things(spark, [(1, "a", 1), (2, "b", 1), (2, "b", 2)])
    history = h.initial_load(old, ["id"], T1)
    run = {
        "detect": lambda **o: h.detect_changes(new, old, ["id"], **o),
        "apply": lambda **o: h.apply_snapshot(history, new, ["id"], T2, **o),
        "process": lambda **o: h.process(new, history, ["id"], T2, **o)[1],
    }[step]
    with pytest.raises(Exception, match="rows share the key id=2"):
        run().collect()
    assert len(run(keys_unique=True).collect()) >= 2
    # Rows without a key are no repetition.
    new = things(spark, [(1, "a", 1), (None, "b", 1), (None, "b", 1)])
    assert len(run().collect()) >= 2


@pytest.mark.parametrize("buckets", [None, 4])
def test_the_store_refuses_and_then_takes_the_snapshot(spark, tmp_path, buckets):
    store = HistoryStore(spark, f"{tmp_path}/store", buckets)
    store.merge(things(spark, [(1, "a", 1), (2, "b", 1)]), ["id"], T1)
    with pytest.raises(quality.RepeatedKey, match="id=2"):
        store.merge(things(spark, [(1, "a", 1), (2, "b", 2), (2, "b", 3)]), ["id"], T2)
    assert store.merge(things(spark, [(1, "a", 1), (2, "b", 2)]), ["id"], T2) == 2
    assert rows(store.current_records()) == [(1, "a", 1), (2, "b", 2)] and store.read_all().count() == 3


# --- snapshots that change nothing -------------------------------------------------------


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("rows/**/*.parquet")}


@pytest.mark.parametrize("buckets", [None, 4])
def test_an_unchanged_snapshot_writes_no_rows(spark, tmp_path, buckets):
    store, history = HistoryStore(spark, f"{tmp_path}/store", buckets), None
    a, b = [(1, "a", 1), (2, "b", None)], [(1, "a", 1), (2, "b", 5), (3, "c", 1)]
    times = [T1, T2, T3, T4, "2024-05-01", "2024-06-01", "2024-07-01", "2024-08-01"]
    for i, data in enumerate([a, a, a, b, b, a, a, b]):
        new = things(spark, data).repartition(i + 1)
        assert store.merge(new, ["id"], times[i], processed_time=T1) == i + 1
        if i in (1, 2, 4, 6):
            assert not [p for p in files(store.path) if f"/gen={i + 1}/" in p]
        history = h.apply_snapshot(history, new, ["id"], times[i], processed_time=T1)
        history = stored(history, "history")
        assert rows(store.read_all()) == rows(history) and rows(store.read_open()) == rows(history.filter(h.CURRENT))
        assert store.has_commit(times[i]) and store.last_commit()["gen"] == i + 1


def test_what_counts_as_a_change(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.merge(things(spark, [(1, "a", 1), (2, "b", 2)]), ["id"], T1, exclude=["n"])
    gens = lambda: store.last_commit()["rows_gen"]
    store.merge(things(spark, [(2, "b", 9), (1, "a", 9)]), ["id"], T2, exclude=["n"])  # not compared
    assert gens() == 1
    store.merge(things(spark, [(1, "b", 1), (2, "a", 2)]), ["id"], T3, exclude=["n"])  # values change places
    assert gens() == 3
    store.merge(things(spark, [(1, "b", 1), (2, "a", 2)]), ["id"], T4)  # other columns are compared
    assert gens() == 4
    store.merge(things(spark, [(1, "b", 1), (2, "a", 2)]).withColumn("m", F.lit(1)), ["id"], "2024-05-01")
    assert gens() == 5
    store.merge(things(spark, [(1, "b", 1), (None, "a", 2)]).withColumn("m", F.lit(1)), ["id"], "2024-06-01")
    store.merge(things(spark, [(1, "b", 1), (None, "a", 2)]).withColumn("m", F.lit(1)), ["id"], "2024-07-01")
    assert gens() == 7  # a row without a key is new every time


def test_what_a_dead_run_left_is_not_seen_after_an_unchanged_one(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.merge(things(spark, [(1, "a", 1)]), ["id"], T1)
    junk = h.create_history_records(h.initial_load(things(spark, [(9, "x", 1)]), ["id"], T1), h.DELETE, T2)
    junk.unionByName(h.initial_load(things(spark, [(8, "x", 1)]), ["id"], T2)).write.partitionBy(h.CURRENT).parquet(
        f"{store.path}/rows/gen=2"
    )
    assert store.merge(things(spark, [(1, "a", 1)]), ["id"], T2) == 2
    assert rows(store.read_all(), "id") == [(1,)]
