"""Near-duplicates and repeated passages against all-pairs versions."""

import brute
import numpy as np
import pytest

from tidemark.llm import hyperminhash as hm
from tidemark.llm import substrings as sub
from tidemark.llm.components import components
from tidemark.llm.words import window_hashes, words_of


def w(n, seed=0):
    return [f"w{(seed * 7919 + i * 104729) % 1000003}" for i in range(n)]


def near_of(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_words_are_runs_of_other_bytes():
    texts = ["a b", "", " x\ty\x0bz\r\n", "ünï code ÄB", "one"]
    found = words_of([t.encode() for t in texts], lower=True)
    mine = [found.data[a:b] for a, b in zip(found.starts, found.ends)]
    assert mine == [x for t in texts for x in brute.words(t, True)]
    assert found.counts().tolist() == [len(brute.words(t)) for t in texts]


def test_equal_words_have_equal_hashes_anywhere():
    a, b = words_of([b"x yy zzz"], False), words_of([b"zzz", b"q x yy zzz"], False)
    assert a.hashes[2] == b.hashes[0] == b.hashes[4]
    assert window_hashes(a.hashes, 2)[1] == window_hashes(b.hashes, 2)[3]
    assert len(set(a.hashes.tolist())) == 3


def test_near_components_agree_with_all_pairs(documents, pairs):
    assert near_of(hm.near_components(documents)) == brute.near(pairs)


def variants(base, n, share, seed):
    """Texts that differ from one base in a share of their words."""
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        rate = draw.random() * share
        out.append(" ".join(x if draw.random() > rate else f"n{draw.integers(1 << 30)}" for x in base))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_a_large_group_of_near_copies(make, width):
    base = w(120)
    rows = list(enumerate(variants(base, 150, 0.16, width) + variants(w(120, 9), 30, 0.3, 4)))
    expected = {}
    sets = {d: brute.shingles(t, width) for d, t in rows}
    root = {d: d for d in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    expected = {d: (len(sets[d]), root[d]) for d in sets}
    assert 1 < len(set(root.values())) < len(rows)
    assert near_of(hm.near_components(make(rows), 0.8, width)) == expected


def test_near_edge_cases(make, empty_docs):
    long = " ".join(w(30000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Word"), (5, "word "), (6, "one two"), (7, "ONE\ttwo"), (8, long), (9, long + " x"), (None, "one two"), (6, "one two")]
    out = hm.near_components(make(rows)).orderBy("doc_id", "n_shingles").collect()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out]
    assert got == [
        (None, 1, None, True),
        (1, 0, 1, True),
        (2, 0, 2, True),
        (3, 0, 3, True),
        (4, 1, 4, True),
        (5, 1, 4, False),
        (6, 1, 6, True),
        (6, 1, 6, True),
        (7, 1, 6, False),
        (8, len(brute.shingles(long)), 8, True),
        (9, len(brute.shingles(long + " x")), 8, False),
    ]
    kept = hm.keep_one(make(rows))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert kept.columns == make(rows).columns
    assert hm.near_components(empty_docs).count() == 0


def test_registers_estimate_similarity():
    common = w(3000)
    a, b = " ".join(common), " ".join(common[:2700] + w(300, 5))
    sets = hm.shingle_sets([a.encode(), b.encode()])
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    registers = hm.sketches(sets)
    assert abs(hm.estimate(registers[0], registers[1]) - true) < 0.12
    assert (hm.sketches([np.empty(0, np.uint64)]) == 0).all()


def test_components_follow_long_paths(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7)]
    df = components(spark.createDataFrame(path, "a long, b long"))
    got = {r["vertex"]: r["root"] for r in df.collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 90, 90: 90, 95: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_second_hash_of_windows_is_another():
    texts = [" ".join(w(60, s)) for s in (1, 2)]
    words = words_of([t.encode() for t in texts], False)
    first, second = window_hashes(words.hashes, 50), window_hashes(sub.mix(words.hashes ^ sub._SECOND), 50)
    assert not set(first.tolist()) & set(second.tolist())
    # Equal windows agree in both, wherever they are.
    again = words_of([b"q " + texts[1].encode()], False).hashes
    assert window_hashes(sub.mix(again ^ sub._SECOND), 50)[1] == second[60] and window_hashes(again, 50)[1] == first[60]


def test_difference_covers_hold_every_distance():
    for period in (1, 2, 5, 12, 30, 31, 47):
        cover = sub.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def removed(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_repeats_agree_with_every_window(documents, pairs):
    assert removed(sub.remove_repeats(documents)) == brute.repeats(pairs)


@pytest.mark.parametrize("width", [3, 8, 50])
def test_passages_at_all_offsets(make, width):
    passage = w(width)
    rows = [(i, " ".join(w(i % 40, i) + passage + w(5, 1000 + i))) for i in range(45)]
    rows += [(100, " ".join(passage[:-1] + ["q"])), (101, " ".join(passage + passage)), (102, " ".join(["z"] * (3 * width)))]
    rows += [(103, " ".join(["z"] * (2 * width))), (104, rows[3][1]), (105, "\n".join(passage))]
    assert removed(sub.remove_repeats(make(rows), width)) == brute.repeats(rows, width)


def test_repeats_edge_cases(make, empty_docs):
    passage = " ".join(w(60))
    rows = [(1, None), (2, ""), (3, "short text"), (4, "short text"), (5, passage), (5, passage), (None, passage), (6, passage + " end")]
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in sub.remove_repeats(make(rows)).collect()))
    assert got == [(0, 60, 0), (1, 0, 0), (2, 0, 0), (3, 2, 0), (4, 2, 0), (5, 60, 0), (5, 60, 0), (6, 61, 60)]
    assert sub.remove_repeats(empty_docs).count() == 0


def test_no_pairs_in_the_plan(documents):
    plan = sub.remove_repeats(documents)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
