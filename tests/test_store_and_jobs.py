"""Sinks, landing folders, the history store, jobs and the stream."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.contracts import ColumnContract, SchemaMismatch, TableContract
from tidemark.operators import history as h
from tidemark.operators import quality
from tidemark.plans import jobs
from tidemark.scratch import new_folder, shared_dir
from tidemark.sinks.history_store import HistoryStore
from tidemark.sinks.tables import create_if_missing, save_quarantine, save_table
from tidemark.sources.files import scan_csv, scan_parquet
from tidemark.sources.landing import all_snapshots, latest_snapshot, latest_snapshot_path, list_snapshots
from tidemark.streaming.history_stream import late_folders, start_history_stream

T1, T2, T3 = "2024-01-01", "2024-02-01", "2024-03-01"

CARS = TableContract(
    "cars",
    (
        ColumnContract("Plate", "plate", "string", nullable=False, pk=True),
        ColumnContract("Make", "make", "string"),
        ColumnContract("Seats", "seats", "int"),
        ColumnContract("Code", "code", "string", fk="codes"),
    ),
    tracked=True,
)


def cars(spark, data):
    return spark.createDataFrame(data, "plate string, make string")


def land(base, folder, lines, name="cars"):
    path = Path(base) / folder
    path.mkdir(parents=True)
    (path / f"{name}.csv").write_text("\n".join(["Plate,Make,Seats,Code", *lines]) + "\n")


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_save_table_rejects_schema_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(cars(spark, [("A", "Audi")]), path)
    save_table(cars(spark, [("B", "BMW")]), path, mode="append")
    assert rows(scan_parquet(spark, path)) == [("A", "Audi"), ("B", "BMW")]
    wider = cars(spark, [("C", "c")]).withColumn("n", F.lit(1))
    with pytest.raises(SchemaMismatch):
        save_table(wider, path)
    with pytest.raises(SchemaMismatch):
        save_table(wider, str(tmp_path / "new"), schema=CARS.schema())
    save_table(wider, path, allow_schema_change=True)
    assert scan_parquet(spark, path).columns == ["plate", "make", "n"]
    assert scan_parquet(spark, None) is None


def test_create_if_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert create_if_missing(spark, CARS, path, scd2=True)
    assert not create_if_missing(spark, CARS, path, scd2=True)
    assert scan_parquet(spark, path).columns[-1] == h.VERSION


def test_quarantine_is_left_alone_by_a_clean_run(spark, tmp_path):
    path = str(tmp_path / "q")
    bad, none = cars(spark, [(None, "x")]), cars(spark, [])
    assert save_quarantine(bad, path) and not save_quarantine(none, path) and not save_quarantine(bad, path, 0)
    assert scan_parquet(spark, path).count() == 1


def test_csv_keeps_codes_and_refuses_shifted_columns(spark, tmp_path):
    land(tmp_path, "a", ["A1,Audi,4,07", "B2,BMW,,"])
    assert rows(scan_csv(spark, f"{tmp_path}/a/cars.csv")) == [("A1", "Audi", "4", "07"), ("B2", "BMW", None, None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cars.csv").write_text("Make,Plate,Seats,Code\nAudi,A1,4,07\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, [f"{tmp_path}/a/cars.csv", f"{tmp_path}/b/cars.csv"]).collect()


def test_landing_folders(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, f"{base}/none", "cars")
    land(base, "not-a-time", ["Z,z,1,00"])
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, base, "cars")
    land(base, "2024-01-01T9-5", ["A,a,1,00"])
    land(base, "2024-01-01T10-0", ["B,b,1,00"])
    land(base, "2023-12-31T23-59", ["C,c,1,00"])
    land(base, "2025-01-01T0-0", ["D,d,1,00"], name="boats")
    assert rows(latest_snapshot(spark, base, "cars"), "Plate") == [("B",)]
    assert list_snapshots(spark, base, "cars").count() == 3
    stacked = all_snapshots(spark, base, "cars")
    assert rows(stacked.select("Plate", F.date_format("__snapshot_ts", "yyyy-MM-dd HH:mm"))) == [
        ("A", "2024-01-01 09:05"),
        ("B", "2024-01-01 10:00"),
        ("C", "2023-12-31 23:59"),
    ]


@pytest.mark.parametrize("seed", [5, 6])
def test_store_equals_apply(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, history = HistoryStore(spark, f"{tmp_path}/store"), None
    assert not store.exists()
    for ts in (T1, T2, T3):
        new = cars(spark, [(f"P{k}", rng.choice("ab")) for k in range(30) if rng.random() < 0.7])
        assert store.merge(new, ["plate"], ts, processed_time=T1) == ["", T1, T2, T3].index(ts)
        history = h.apply_snapshot(history, new, ["plate"], ts, processed_time=T1)
    assert rows(store.read_all()) == rows(history)
    assert rows(store.read_open()) == rows(history.filter(h.CURRENT))
    assert rows(store.current_records()) == rows(h.current_records(history))
    assert store.schema().names == history.columns
    assert store.has_commit(T2) and not store.has_commit("2024-02-02")


def test_store_ignores_and_replaces_an_unfinished_run(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.merge(cars(spark, [("A", "a")]), ["plate"], T1, processed_time=T1)
    # A run that died after writing rows, before its commit line.
    junk = h.initial_load(cars(spark, [("X", "x")]), ["plate"], T2)
    junk.write.partitionBy(h.CURRENT).parquet(f"{store.path}/rows/gen=2")
    assert rows(store.read_all(), "plate") == [("A",)]
    assert store.merge(cars(spark, [("A", "b")]), ["plate"], T2) == 2
    assert rows(store.read_all(), "plate", "make", h.VERSION) == [("A", "a", 1), ("A", "b", 2)]


def test_store_never_rewrites_closed_files(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    for i, ts in enumerate((T1, T2, T3)):
        before = {p: p.stat().st_mtime_ns for p in Path(store.path).rglob("*__is_current=false/*.parquet")}
        store.merge(cars(spark, [("A", str(i)), ("B", "b")]), ["plate"], ts)
        assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert store.read_all().filter("plate = 'A'").count() == 3


def test_store_takes_new_columns_and_empty_snapshots(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    assert store.create(CARS) and not store.create(CARS)
    assert store.read_all().isEmpty() and store.read_open().columns[:4] == ["plate", "make", "seats", "code"]
    full = spark.createDataFrame([("A", "a", 4, "00")], "plate string, make string, seats int, code string")
    store.merge(full, ["plate"], T1)
    store.merge(full.withColumn("color", F.lit("red")), ["plate"], T2)
    assert rows(store.read_all(), "plate", "color", h.VERSION) == [("A", None, 1), ("A", "red", 2)]
    # The next run trusts the stored hashes, which cover the new column by now.
    both = full.withColumn("color", F.lit("red")).unionByName(
        spark.createDataFrame([("B", "b", 2, "07", None)], "plate string, make string, seats int, code string, color string")
    )
    store.merge(both, ["plate"], "2024-02-10")
    store.merge(both, ["plate"], "2024-02-20")
    assert rows(store.read_all(), "plate", h.VERSION) == [("A", 1), ("A", 2), ("B", 1)]
    store.merge(full.limit(0), ["plate"], T3)
    assert store.read_open().isEmpty() and store.read_all().count() == 3
    with pytest.raises(LookupError):
        HistoryStore(spark, f"{tmp_path}/none").read_all()


def test_store_hashes_again_when_other_columns_are_compared(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    wide = spark.createDataFrame([("A", "a", "x"), ("B", "b", "x")], "plate string, make string, note string")
    store.merge(wide, ["plate"], T1)
    moved = wide.withColumn("note", F.lit("y"))
    store.merge(moved, ["plate"], T2, exclude=["note"])
    store.merge(moved, ["plate"], T3, exclude=["note"])
    assert store.read_all().count() == 2
    plans = [
        store.next_rows(store.last_commit(), moved, ["plate"], "2024-04-01", exclude=e)._jdf.queryExecution()
        for e in (["note"], [])
    ]
    assert [p.optimizedPlan().toString().count("md5") for p in plans] == [1, 2]
    # The stored row still has its first note, so comparing it again finds a change.
    store.merge(moved, ["plate"], "2024-04-01")
    assert rows(store.read_open(), "plate", "note", h.VERSION) == [("A", "y", 2), ("B", "y", 2)]


def test_store_gives_up_superseded_open_rows(spark, tmp_path):
    kept, lean = HistoryStore(spark, f"{tmp_path}/kept", keep=None), HistoryStore(spark, f"{tmp_path}/lean")
    for i in range(5):
        new = cars(spark, [("A", str(i)), ("B", "b"), (f"C{i}", "c")])
        for store in (kept, lean):
            store.merge(new, ["plate"], f"2024-0{i + 1}-01", processed_time=T1)
    assert rows(lean.read_all()) == rows(kept.read_all())
    held = [spark.read.parquet(f"{lean.path}/rows/gen={g}/{h.CURRENT}=true").count() for g in range(1, 6)]
    assert held == [0, 0, 0, 3, 3]
    with pytest.raises(ValueError):
        HistoryStore(spark, lean.path, keep=1)


def test_backfill_then_merge(spark, tmp_path):
    stacked = cars(spark, [("A", "a"), ("B", "b")]).withColumn("ts", F.lit(T1).cast("timestamp")).unionByName(
        cars(spark, [("A", "x")]).withColumn("ts", F.lit(T2).cast("timestamp"))
    )
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.append(h.replay(stacked, ["plate"], "ts"), T2, ["plate"])
    store.merge(cars(spark, [("A", "x"), ("B", "b")]), ["plate"], T3)
    assert rows(store.read_all(), "plate", h.OPERATION, h.CURRENT, h.VERSION) == [
        ("A", "INSERT", False, 1),
        ("A", "UPDATE", True, 2),
        ("B", "DELETE", False, 1),
        ("B", "INSERT", True, 1),
    ]
    with pytest.raises(ValueError):
        store.append(store.read_all(), T3, ["plate"])


CHECKS = [quality.is_not_null("plate"), quality.in_list("code", ["00", "07"])]
GOLD = jobs.GoldSpec({"make": "Audi"}, ["plate", "seats"], ["seats"], ["seats", "code"], ["plate"])


def test_layers(spark, tmp_path):
    base, layers = str(tmp_path / "landing"), jobs.Layers(str(tmp_path), "cars")
    land(base, "2024-01-01T0-0", ["A,Audi,4,00", "B,Audi,4,07", "C,BMW,2,00", "D,Audi,5.0,99", ",Audi,1,00"])
    run = jobs.job_all_layers(spark, CARS, CHECKS, GOLD, base, layers, T1)
    assert run == jobs.SilverRun(n_total=5, n_quarantined=2, keys_unique=True, gen=1)
    assert rows(scan_parquet(spark, layers.gold)) == [("A", 4), ("B", 4)]
    assert rows(scan_parquet(spark, layers.gold_dedup)) == [(4, "00")]
    land(base, "2024-02-01T0-0", ["A,Audi,7,00", "E,Audi,4,00", "E,Audi,3,00", "C,BMW,2,00"])
    run = jobs.job_all_layers(spark, CARS, CHECKS, GOLD, base, layers, T2)
    assert not run.keys_unique and run.gen == 2
    silver = HistoryStore(spark, layers.silver)
    assert rows(silver.read_all(), "plate", h.OPERATION, h.CURRENT) == [
        ("A", "INSERT", False),
        ("A", "UPDATE", True),
        ("B", "DELETE", False),
        ("C", "INSERT", True),
    ]
    aside = scan_parquet(spark, layers.quarantine)
    assert rows(aside.select("plate", "seats", F.array_join("_errors.name", ","))) == [
        ("E", 3, "pk_unique"),
        ("E", 4, "pk_unique"),
    ]


def test_untracked_table_is_overwritten(spark, tmp_path):
    plain = TableContract("cars", CARS.columns)
    base, layers = str(tmp_path / "landing"), jobs.Layers(str(tmp_path), "cars")
    land(base, "2024-01-01T0-0", ["A,Audi,4,00"])
    land(base, "2024-02-01T0-0", ["A,Audi,4,00", "A,Audi,5,07"])
    assert jobs.job_prepare_silver(spark, plain, layers) and not jobs.job_prepare_silver(spark, plain, layers)
    assert scan_parquet(spark, layers.silver).isEmpty()
    for folder in ("2024-01-01T0-0", "2024-02-01T0-0"):
        jobs.job_bronze(spark, plain, base, layers, folder)
        run = jobs.job_silver(spark, plain, CHECKS, layers, T1)
    assert run.gen is None and rows(scan_parquet(spark, layers.silver), "seats") == [(4,), (5,)]


def test_fk_report(spark):
    child = spark.createDataFrame([("A", "00"), ("B", "99"), ("C", None)], "plate string, code string")
    report = jobs.fk_report(child, CARS, {"codes": spark.createDataFrame([("00",)], "code string")})
    assert rows(report["code"], "plate") == [("B",)]
    assert jobs.fk_report(child, CARS, {}) == {}


def test_stream_restarts_and_sets_late_folders_aside(spark, tmp_path):
    base, layers = str(tmp_path / "landing"), jobs.Layers(str(tmp_path), "cars")
    store = HistoryStore(spark, layers.silver)

    def run(checkpoint="ckpt"):
        at = str(tmp_path / checkpoint)
        start_history_stream(spark, CARS, base, layers, at, CHECKS, splice_late=False).awaitTermination()

    land(base, "2024-01-01T9-0", ["A,Audi,4,00", "B,BMW,4,99"])
    land(base, "2024-01-01T10-0", ["A,Alfa,4,00", "C,Citroen,4,07"])
    run()
    run()  # nothing new
    land(base, "2024-03-01T0-0", ["C,Citroen,4,07"])
    run()
    assert rows(store.read_all(), "plate", "make", h.OPERATION, h.VERSION) == [
        ("A", "Alfa", "DELETE", 2),
        ("A", "Audi", "INSERT", 1),
        ("C", "Citroen", "INSERT", 1),
    ]
    # Without its checkpoint, the stream meets the same folders again and skips them.
    run("other")
    assert store.last_commit()["gen"] == 3
    assert rows(scan_parquet(spark, f"{layers.quarantine}/2024-01-01T9-0"), "plate") == [("B",)]
    land(base, "2024-02-01T0-0", ["A,Audi,4,00"])
    land(base, "2024-04-01T0-0", ["C,Citroen,4,07"])
    run()
    # The late folder is set aside; the one after it is taken.
    assert store.last_commit()["gen"] == 4 and store.has_commit("2024-04-01")
    late = spark.read.parquet(f"{late_folders(layers)}/*")
    assert rows(late) == [("2024-02-01T0-0", "2024-02-01 00:00:00")]


@pytest.mark.parametrize("seed", [11])
def test_bucketed_store_equals_apply_and_shuffles_only_the_snapshot(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, history = HistoryStore(spark, f"{tmp_path}/store", buckets=6), None
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for ts in (T1, T2, T3):
            new = cars(spark, [(f"P{k}", rng.choice("ab")) for k in range(40) if rng.random() < 0.7])
            last = store.last_commit()
            if last is not None:
                text = store.next_rows(last, new, ["plate"], ts)._jdf.queryExecution().executedPlan().toString()
                assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
            # An earlier try left files behind.
            junk = h.initial_load(cars(spark, [("X", "x")]), ["plate"], ts)
            gen = 1 if last is None else last["gen"] + 1
            junk.write.partitionBy(h.CURRENT).parquet(f"{store.path}/rows/gen={gen}")
            store.merge(new, ["plate"], ts, processed_time=T1)
            history = h.apply_snapshot(history, new, ["plate"], ts, processed_time=T1)
        assert rows(store.read_all()) == rows(history)
        assert rows(store.current_records()) == rows(h.current_records(history))
        # The bucketing may change from one run to the next.
        wider = HistoryStore(spark, store.path, buckets=3)
        wider.merge(new, ["plate"], "2024-04-01")
        assert rows(wider.read_all().drop(h.PROCESSED)) == rows(history.drop(h.PROCESSED))
        with pytest.raises(Exception, match="complete keys"):
            wider.merge(cars(spark, [(None, "x")]), ["plate"], "2024-05-01")
        assert wider.last_commit()["gen"] == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
