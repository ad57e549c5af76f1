"""A late snapshot, spliced into a history, gives the history of all snapshots in their order."""

import random

import pytest
from conftest import rows

from tidemark.contracts import SchemaMismatch
from tidemark.operators import history as h
from tidemark.operators.late import splice
from tidemark.operators.quality import RepeatedKey
from tidemark.scratch import stored
from tidemark.sinks.history_store import HistoryStore

TIMES = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
SHOWN = ["k", "v", h.FROM, h.TO, h.CURRENT, h.OPERATION, h.HASH, h.VERSION]
LAYOUT = "k long, v string"


def snapshots(spark, seed, n_keys=40):
    draw = random.Random(seed)
    out = []
    for _ in TIMES:
        kept = [(k, draw.choice(["a", "b", None])) for k in range(n_keys) if draw.random() < 0.7]
        out.append(spark.createDataFrame(kept, LAYOUT))
    return out


def built(frames, times):
    history = h.initial_load(frames[0], ["k"], times[0])
    for frame, ts in zip(frames[1:], times[1:]):
        history = stored(h.apply_snapshot(history, frame, ["k"], ts), "history")
    return history


@pytest.mark.parametrize("late", range(4))
def test_as_if_it_had_come_in_time(spark, late):
    frames = snapshots(spark, late)
    whole = built(frames, TIMES)
    others = [i for i in range(4) if i != late]
    times = [TIMES[i] for i in others]
    history = built([frames[i] for i in others], times)
    got = splice(history, frames[late], ["k"], TIMES[late], times)
    assert got.columns == history.columns and rows(got, *SHOWN) == rows(whole, *SHOWN)


def test_keys_in_the_same_state_keep_their_rows(spark):
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], LAYOUT)
    last = spark.createDataFrame([(1, "b"), (2, "a")], LAYOUT)
    history = stored(built([first, last], ["2024-01-01", "2024-03-01"]), "history")
    got = splice(history, spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], LAYOUT), ["k"], "2024-02-01", ["2024-01-01", "2024-03-01"])
    same = "k != 2"
    assert rows(got.filter(same)) == rows(history.filter(same))
    assert [(r["v"], r[h.VERSION], r[h.CURRENT]) for r in got.filter("k = 2").orderBy(h.FROM).collect()] == [
        ("a", 1, False), ("c", 2, False), ("a", 3, True)
    ]


def test_an_empty_late_snapshot_ends_all_versions(spark):
    frames = snapshots(spark, 9)[:2]
    empty = spark.createDataFrame([], LAYOUT)
    times = [TIMES[0], TIMES[2]]
    got = splice(built(frames, times), empty, ["k"], TIMES[1], times)
    assert rows(got, *SHOWN) == rows(built([frames[0], empty, frames[1]], TIMES[:3]), *SHOWN)


def test_what_does_not_fit_is_refused(spark):
    frames = snapshots(spark, 3)[:2]
    times = TIMES[:2]
    history = built(frames, times)

    def spliced(values, layout=LAYOUT, ts="2024-01-15", at=times):
        return splice(history, spark.createDataFrame(values, layout), ["k"], ts, at).collect()

    with pytest.raises(ValueError, match="already"):
        spliced([(1, "a")], ts=TIMES[1])
    with pytest.raises(SchemaMismatch):
        spliced([(1, "a", 2)], "k long, v string, w long")
    with pytest.raises(Exception, match=h.REPEATED):
        spliced([(1, "a"), (1, "b")])
    with pytest.raises(Exception, match="complete keys"):
        spliced([(None, "a")])
    with pytest.raises(Exception, match="not among"):
        spliced([], at=[TIMES[0], "2024-06-01"])


@pytest.mark.parametrize("buckets", [None, 3])
@pytest.mark.parametrize("order", [(3, 0, 2, 1), (1, 3, 0, 2)])
def test_store_takes_snapshots_in_any_order(spark, tmp_path, order, buckets):
    frames = snapshots(spark, 21)
    store = HistoryStore(spark, str(tmp_path / "store"), buckets)
    for i in order:
        take = store.splice if store.is_late(TIMES[i]) else store.merge
        take(frames[i], ["k"], TIMES[i])
    assert rows(store.read_all(), *SHOWN) == rows(built(frames, TIMES), *SHOWN)
    assert [str(t.date()) for t in store.times()] == TIMES
    # Later snapshots are taken as usual, the same one again without writing rows.
    store.merge(frames[0], ["k"], "2024-05-01")
    assert rows(store.read_all(), *SHOWN) == rows(built([*frames, frames[0]], [*TIMES, "2024-05-01"]), *SHOWN)
    store.merge(frames[0], ["k"], "2024-06-01")
    assert store.last_commit()["rows_gen"] == 5


def test_store_gives_up_rows_that_a_splice_replaced(spark, tmp_path):
    frames = snapshots(spark, 5)
    store = HistoryStore(spark, str(tmp_path / "store"))
    for i in (0, 2):
        store.merge(frames[i], ["k"], TIMES[i])
    before, seen = store.read_all(), rows(store.read_all())
    gen = store.splice(frames[1], ["k"], TIMES[1])
    assert rows(before) == seen  # a reader at work
    store.merge(frames[3], ["k"], TIMES[3])
    closed = spark.read.option("basePath", f"{store.path}/rows").parquet(f"{store.path}/rows/gen=*/{h.CURRENT}=false")
    assert gen == 3 and closed.filter("gen < 3").isEmpty()
    assert rows(store.read_all(), *SHOWN) == rows(built(frames, TIMES), *SHOWN)


def test_a_late_snapshot_that_changes_nothing_writes_no_rows(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], LAYOUT)
    store = HistoryStore(spark, str(tmp_path / "store"))
    for ts in (TIMES[0], TIMES[2]):
        store.merge(frame, ["k"], ts)
    seen = rows(store.read_all())
    assert store.splice(frame, ["k"], TIMES[1]) == 3 and store.last_commit()["rows_gen"] == 1
    assert rows(store.read_all()) == seen and store.has_commit(TIMES[1])


def test_store_refuses_what_is_not_late_or_does_not_fit(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a")], LAYOUT)
    store = HistoryStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="no snapshot later"):
        store.splice(frame, ["k"], TIMES[0])
    for ts in (TIMES[1], TIMES[2]):
        store.merge(frame, ["k"], ts)
    with pytest.raises(ValueError, match="no snapshot later"):
        store.splice(frame, ["k"], TIMES[3])
    with pytest.raises(ValueError, match="already"):
        store.splice(frame, ["k"], TIMES[1])
    with pytest.raises(RepeatedKey):
        store.splice(frame.union(frame), ["k"], TIMES[0])
    with pytest.raises(SchemaMismatch):
        store.splice(frame.withColumn("w", h.F.lit(1)), ["k"], TIMES[0])
    assert store.last_commit()["gen"] == 2
