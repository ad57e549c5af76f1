"""Steps that large snapshots take: counted instead of copied, split instead of parsed, dealt without a sort."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_one_pass import CHECKS, THINGS, csv, things
from test_plans import NO_BROADCAST, plan, settings

from tidemark.operators import history as h
from tidemark.operators import quality
from tidemark.plans import jobs
from tidemark.scratch import shared_dir
from tidemark.sinks import history_store
from tidemark.sinks.history_store import HistoryStore
from tidemark.sources import files

T1, T2, T3 = "2024-01-01", "2024-02-01", "2024-03-01"


def plans_of(spark, run):
    """Physical plans of what ``run`` executes."""
    store, before = spark._jsparkSession.sharedState().statusStore(), 0
    executions = store.executionsList()
    if executions.size():
        before = max(executions.apply(i).executionId() for i in range(executions.size()))
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executions = store.executionsList()
    found = [executions.apply(i) for i in range(executions.size())]
    return [e.physicalPlanDescription() for e in found if e.executionId() > before]


def test_silver_does_not_write_bronze_again(spark, tmp_path):
    layers = jobs.Layers(f"{tmp_path}/out", "things")
    csv(tmp_path / "landing" / "2024-01-01T0-0", ["1,a,1", "2,b,200", ",a,3", "3,c,3"])
    jobs.job_bronze(spark, THINGS, f"{tmp_path}/landing", layers)
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("tidemark/dealt-*"))
    run = jobs.job_silver(spark, THINGS, CHECKS, layers, T1)
    assert set(shared.glob("tidemark/dealt-*")) == before
    assert (run.n_total, run.n_quarantined) == (4, 2)
    assert rows(HistoryStore(spark, layers.silver).current_records()) == [(1, "a", 1), (3, "c", 3)]
    assert h.HASH not in spark.read.parquet(layers.quarantine).columns


def test_counted_split_is_the_split(spark):
    df = things(spark, [(1, "a", 1), (None, "a", 2), (3, "c", 300), (4, "c", 4), (None, "b", -1)])
    for data in (df, df.filter("id = 1"), df.limit(0)):
        valid, quarantined = quality.split(data, CHECKS)
        counted = quality.counted_split(data, CHECKS, observe={"most": F.max("n")})
        assert rows(counted.valid) == rows(valid) and rows(counted.quarantined) == rows(quarantined)
        n = {r["check_name"]: r["n_rows"] for r in quality.summary(data, CHECKS).collect()}
        assert (counted.n_total, counted.n_quarantined) == (n.pop("__rows"), n.pop("__quarantined"))
        assert dict(counted.n_failed) == n


def test_fingerprint_sums_are_those_of_decimals(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("v")).union(spark.sql("SELECT 9223372036854775807L UNION ALL SELECT -9223372036854775808L"))
    for data in (df, df.limit(0)):
        exact, plain = data.agg(h._exact_sum(F.col("v")), F.coalesce(F.sum(F.col("v").cast("decimal(20,0)")), F.lit(0))).first()
        assert exact == plain


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_run_is_written_without_a_sort_by_flag(spark, tmp_path, buckets):
    store = HistoryStore(spark, f"{tmp_path}/store", buckets)
    store.merge(things(spark, [(1, "a", 1), (2, "b", 1)]), ["id"], T1)
    plans = plans_of(spark, lambda: store.merge(things(spark, [(1, "a", 2), (3, "b", 1)]), ["id"], T2))
    assert any("InsertIntoHadoopFsRelation" in p for p in plans)
    assert not any(f"[{h.CURRENT}" in line for p in plans for line in p.splitlines() if "Sort" in line or line.startswith("Arguments: [__is_current"))
    assert rows(store.current_records()) == [(1, "a", 2), (3, "b", 1)] and store.read_all().count() == 4


def test_plain_lines_are_split_as_the_parser_does(spark, tmp_path, monkeypatch):
    draw = random.Random(5)
    signs = [",", "a", " ", "\t", "\\", '"', "ü", " ", "#", "'", "", "NULL", "\x1e", "\x0b", "\x85"]
    fields = lambda: ["".join(draw.choice(signs) for _ in range(draw.choice([0, 1, 2, 3]))) for _ in range(draw.choice([3, 3, 3, 2, 4]))]
    lines = ["a,b,c", *[",".join(fields()) for _ in range(3000)]]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n", newline="")
    got = rows(files.read_csv(spark, f"{tmp_path}/t.csv"))
    monkeypatch.setattr(files, "_PARSED", ("",))  # every line holds it
    assert got == rows(files.read_csv(spark, f"{tmp_path}/t.csv")) and len(got) > 2500


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """A task's share is bounded, and every layout is read as it was written."""
    monkeypatch.setattr(history_store, "BUCKET_ROWS", 20)
    history, sizes = None, []
    times = [T1, T2, T3, "2024-04-01", "2024-05-01"]
    for i, n in enumerate([30, 70, 70, 75, 30]):
        # A new store each time, as a job has it; the third snapshot is the second.
        store = HistoryStore(spark, f"{tmp_path}/store", buckets=2)
        new = things(spark, [(k, "ab"[(k + min(i, 1) + i // 3) % 2], k) for k in range(n)])
        store.merge(new, ["id"], times[i], processed_time=T1)
        sizes.append(store.last_commit()["buckets"])
        history = h.apply_snapshot(history, new, ["id"], times[i], processed_time=T1)
        assert rows(store.read_all()) == rows(history)
    assert sizes == [2, 4, 4, 4, 4]
    late = things(spark, [(k, "a", 0) for k in range(40)])
    store = HistoryStore(spark, f"{tmp_path}/store", buckets=2)
    store.splice(late, ["id"], "2024-01-15", processed_time=T1)
    store.merge(things(spark, [(1, "a", 5)]), ["id"], "2024-06-01", processed_time=T1)
    assert store.read_open().count() == 1


def test_a_late_snapshot_hashes_its_own_rows_only(spark, tmp_path, monkeypatch):
    a, b, c = [things(spark, [(k, "ab"[(k * m) % 2], k % (m + 1)) for k in range(9 - m)]) for m in range(3)]
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.merge(a, ["id"], T1, processed_time=T1)
    store.merge(c, ["id"], T3, processed_time=T1)
    seen = []
    original = h.replay
    monkeypatch.setattr(h, "replay", lambda df, *rest: seen.append(df.columns) or original(df, *rest))
    store.splice(b, ["id"], T2, processed_time=T1)
    assert len(seen) == 1 and h.HASH in seen[0]
    in_turn = None
    for new, ts in ((a, T1), (b, T2), (c, T3)):
        in_turn = h.apply_snapshot(in_turn, new, ["id"], ts, processed_time=T1)
    assert rows(store.read_all().drop(h.PROCESSED)) == rows(in_turn.drop(h.PROCESSED))


# --- F3: hashes are computed for rows that need one ----------------------------------------


def test_a_stored_hash_spares_the_snapshots_hashes_before_the_join(spark):
    old = h.initial_load(things(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "NULL", 4), (5, "d", 5)]), ["id"], T1, processed_time=T1)
    new = things(spark, [(1, "a", 1), (2, "b", 9), (4, None, 4), (5, "d", 5), (6, "e", 6), (None, "x", 1)])
    with settings(spark, **NO_BROADCAST):
        step = h.next_versions(old, new, ["id"], T2, processed_time=T2, stored_hash=True)
        above, below = plan(step).split("SortMergeJoin", 1)
        # The one below computes the old side, which is no table here.
        assert above.count("md5(") == 1 and below.count("md5(") == 1
        assert rows(step) == rows(h.next_versions(old, new, ["id"], T2, processed_time=T2))
    assert rows(step.filter("id = 4"), h.CURRENT, h.OPERATION) == [(True, "INSERT")]  # NULL has the text of 'NULL'


@pytest.mark.parametrize("kind", ["double", "array<float>", "string collate UTF8_LCASE", "bigint"])
def test_values_that_are_equal_with_unequal_texts_keep_their_hashes(spark, kind):
    pairs = {"double": ("0.0D", "-0.0D"), "array<float>": ("array(0.0F)", "array(-0.0F)"), "bigint": ("1", "1")}
    first, second = pairs.get(kind, ("'a'", "'A'"))
    old = h.initial_load(spark.sql(f"SELECT 1 AS id, CAST({first} AS {kind}) AS v"), ["id"], T1, processed_time=T1)
    new = spark.sql(f"SELECT 1 AS id, CAST({second} AS {kind}) AS v")
    step = h.next_versions(old, new, ["id"], T2, processed_time=T2, stored_hash=True)
    assert rows(step, h.OPERATION, h.HASH) == rows(h.next_versions(old, new, ["id"], T2, processed_time=T2), h.OPERATION, h.HASH)
    assert step.count() == (1 if kind == "bigint" else 2)


def test_silver_hashes_only_a_snapshot_of_as_many_rows_as_are_open(spark, tmp_path):
    layers = jobs.Layers(f"{tmp_path}/out", "things")

    def silver(day, lines):
        csv(tmp_path / "landing" / f"{day}T0-0", lines)
        jobs.job_bronze(spark, THINGS, f"{tmp_path}/landing", layers)
        plans = plans_of(spark, lambda: jobs.job_silver(spark, THINGS, CHECKS, layers, day))
        return sum("md5(" in p and "InsertIntoHadoopFsRelation" not in p for p in plans), plans

    jobs.job_prepare_silver(spark, THINGS, layers)
    hashed, plans = silver(T1, ["1,a,1", "2,b,2"])
    assert hashed == 0 and not any("Join" in p for p in plans)  # nothing is stored that it could join
    assert silver(T2, ["1,a,1", "2,b,2", "3,a,3"])[0] == 0
    hashed, plans = silver(T3, ["1,a,1", "2,b,2", "3,a,3"])
    store = HistoryStore(spark, layers.silver)
    assert hashed == 1 and not any("Join" in p for p in plans) and store.last_commit()["rows_gen"] == 2
    assert silver("2024-04-01", ["1,a,1", "2,b,2", "3,a,4"])[0] == 1 and store.last_commit()["rows_gen"] == 4
    assert rows(store.current_records()) == [(1, "a", 1), (2, "b", 2), (3, "a", 4)]


def test_the_first_load_of_a_created_history_keeps_its_layout(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/store")
    store.create(THINGS)
    with pytest.raises(quality.RepeatedKey, match="id=2"):
        store.merge(spark.sql("SELECT 2 AS id, 5 AS m UNION ALL SELECT 2, 6"), ["id"], T1)
    assert store.merge(spark.sql("SELECT 5 AS m, 2 AS id UNION ALL SELECT 6, NULL UNION ALL SELECT 7, NULL"), ["id"], T1) == 1
    assert store.current_records().columns == ["id", "name", "n", "m"]
    assert rows(store.current_records()) == [(None, None, None, 6), (None, None, None, 7), (2, None, None, 5)]
    (file, *_) = Path(store.path).glob(f"rows/gen=1/{h.CURRENT}=true/*.parquet")
    assert str(pq.read_schema(file).field(h.FROM).type).startswith("timestamp[us")
