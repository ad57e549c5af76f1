"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, runs


def all_runs(words, least):
    """Every maximal stretch of every period, kept if no smaller period holds on it."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, 2 * q):
                part = words[s : s + length]
                if all(part[d:] != part[:-d] for d in range(1, q)):
                    found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([1, 2, 5, 12]))
def test_runs_of_small_alphabets(sequence, least):
    assert runs.runs_of(sequence, least) == all_runs(sequence, least)


def test_runs_of_structured_sequences():
    draw = random.Random(3)
    for _ in range(60):
        sequence = []
        while len(sequence) < 300:
            block = [draw.randrange(4) for _ in range(draw.randint(1, 15))]
            sequence += block * draw.choice([1, 1, 2, 3, 7])
        assert runs.runs_of(sequence) == all_runs(sequence, 12)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    assert runs.runs_of(fib[-1]) == all_runs(fib[-1], 12)
    assert runs.runs_of([7] * 5000) == [(0, 5000, 1)]


def test_candidates_hold_every_run():
    import numpy as np

    draw = random.Random(5)
    for least in (2, 3, 12):
        for _ in range(40):
            owner, words, expected, at = [], [], [], 0
            for k in range(4):
                text = []
                while len(text) < draw.randint(0, 120):
                    block = [draw.randrange(30) for _ in range(draw.randint(1, 12))]
                    text += block * draw.choice([1, 1, 1, 2, 4])
                expected += [(at + s, n) for s, n, _ in all_runs(text, least)]
                owner += [k] * len(text)
                words += text
                at += len(text)
            hashes = np.array([hash(("w", w)) & (2**64 - 1) for w in words], np.uint64)
            starts, ends = runs.candidates(hashes, np.array(owner, np.int64), least)
            for s, n in expected:
                assert any(a <= s and s + n <= b for a, b in zip(starts, ends))


def planted(doc_id, text):
    words = brute.words(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain(doc_id, text):
    words = planted(doc_id, text)
    found = all_runs(words, 12)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in found), default=None)
    four = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_agrees_with_the_plain_search(spark, sf_dir, pairs):
    short = {d for d, t in pairs if len(brute.words(t)) <= 3000}
    got = [tuple(r) for r in queries.QUERIES["op13_runs"](spark, sf_dir).collect()]
    assert len(got) == len(pairs)
    expected = sorted(plain(d, t) for d, t in pairs if d in short)
    assert sorted(r for r in got if r[0] in short) == expected
    assert sum(r[1] > 0 for r in expected) > 10


def test_edge_cases(make, empty_docs):
    line = "one two three four five six seven"
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "a " * 12),
        (5, "a " * 11),
        (6, f"{line}\n" * 2),
        (6, f"{line}\n" * 2),
        (None, f"x {line}  {line}\t{line} one y"),
        (8, "ß ß " * 30),
        (9, " ".join(["w"] * 150_000)),
    ]
    docs = make(rows)
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    found = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=str)
    assert found == sorted(
        [
            (1, [], ""),
            (2, [], ""),
            (3, [], ""),
            (4, [(0, 12, 1)], "a"),
            (5, [], " ".join("a" * 11)),
            (6, [(0, 14, 7)], line),
            (6, [(0, 14, 7)], line),
            (None, [(1, 22, 7)], f"x {line} y"),
            (8, [(0, 30, 1)], "ß ß"),
            (9, [(0, 150_000, 1)], "w"),
        ],
        key=str,
    )
    assert runs.digests(runs.periodic_runs(empty_docs)).count() == 0
    assert runs.periodic_runs(make([(1, "a b " * 6)]), min_length=20).first()["runs"] == []


def test_edit_of_tails(make):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:6] + [1, None]
    texts = ["", None, "one", " a b\tc  d " * 9, "p q r s t u v w x y z " * 7, "solo duo", "k l m", "n o"]
    docs = make(list(zip(ids, texts)))
    got = {r["doc_id"]: r["t"] for r in docs.select("doc_id", runs.repeat_tail(docs.text, docs.doc_id).alias("t")).collect()}
    for d, t in zip(ids, texts):
        assert brute.words(got[d]) == planted(d, t)
