"""The classifier and the language model: held-out results, brute force, edge cases."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hmm, nbsvm
from tidemark.llm.words import mix


def fold(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % 5 == k


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = nbsvm.quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == fold(r["doc_id"], 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_learned(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(nbsvm.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (nbsvm.quality(documents, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_quality_edge_cases(spark, make, empty_docs):
    rows = [(i, f"good words here {i}") for i in range(20)] + [(100 + i, f"!!! $$$ {i} ###") for i in range(20)]
    rows += [(200, None), (201, ""), (202, "x"), (None, "good words"), (203, "good words " * 40000), (3, "good words here 3")]
    labels = spark.createDataFrame(
        [(r[0], int(r[0] < 100), 0) for r in rows[:40]] + [(200, None, 0), (None, 1, 0), (5, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    out = {r["doc_id"]: r for r in nbsvm.quality(make(rows), labels).collect()}
    assert len(out) == 45 and out[203]["predicted"] == 1 and out[110]["predicted"] == 0 and 0 <= out[200]["score"] <= 1
    assert out[200]["score"] == out[201]["score"]
    assert nbsvm.quality(empty_docs, labels).count() == 0
    none = nbsvm.quality(make(rows), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    one = nbsvm.quality(make(rows), labels.filter("quality = 1")).collect()
    assert all(r["predicted"] == 1 for r in one)
    kept = nbsvm.keep_good(make(rows), labels)
    assert kept.columns == make(rows).columns and kept.filter("doc_id BETWEEN 100 AND 119").count() == 0


def test_packed_rows_are_whole_and_bounded():
    draw = np.random.default_rng(4)
    sizes = [1, 7, 5000, 8191, 8192, 9000, nbsvm.DIM]
    some = [np.sort(draw.choice(nbsvm.DIM, n, replace=False)) for n in sizes]
    kept = [nbsvm.packed(x) for x in some]
    assert max(map(len, kept)) == nbsvm.DIM // 8
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(nbsvm.Rows(kept), some))
    assert [len(x) for x in nbsvm.Rows(kept).pick(np.array([3, 0]))] == [8191, 1]


def test_the_model_is_fitted_on_3000_documents_of_each_class(make, spark, monkeypatch):
    rows = [(i, f"text {i % 97} {i % 89}") for i in range(6100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(6100)], "doc_id long, label int")
    seen = []
    monkeypatch.setattr(nbsvm, "fit", lambda rows, target, *rest: seen.append((len(rows), np.bincount(target).tolist())))
    nbsvm.train(make(rows), labels)
    assert seen == [(6000, [3000, 3000])]


def test_dual_coordinate_descent_meets_its_conditions():
    draw = np.random.default_rng(3)
    rows = [np.sort(draw.choice(50, 6, replace=False)) for _ in range(80)]
    signs = np.array([1.0 if (r < 12).any() else -1.0 for r in rows])
    ratios = np.ones(nbsvm.DIM)
    scale = nbsvm.scales(rows, ratios)
    values = [np.full(6, 6**-0.5) for _ in rows]
    w = nbsvm.fit_hinge(rows, ratios, scale, signs, np.full(80, 5.0), passes=2000)
    margins = np.array([w[r] @ v for r, v in zip(rows, values)])
    assert (np.sign(margins) == signs).mean() > 0.95

    def loss(x):
        return 0.5 * x @ x + 5 * sum(max(0, 1 - s * (x[r] @ v)) for r, v, s in zip(rows, values, signs))

    assert loss(w) < loss(w * 0.95) * 1.002 and loss(w) < loss(w * 1.05) * 1.002 and loss(w) < loss(w * 0)


def test_log_ratios_follow_the_counts():
    ones, zeros = np.zeros(nbsvm.DIM), np.zeros(nbsvm.DIM)
    ones[5], zeros[7], ones[9], zeros[9] = 50, 50, 20, 20
    r = nbsvm.log_ratios(ones, zeros)
    assert r[5] > 3 and r[7] < -3 and abs(r[9]) < 0.1


TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens_of(text):
    raw = (text or "").encode()
    return TOKEN.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw)) + [None]


def base_scores(rows):
    counts = {}
    for d, t in rows:
        if not (d is not None and fold(d, 1)):
            for x in tokens_of(t):
                counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        w = tokens_of(t)
        base = sum(math.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out[d] = (d is not None and fold(d, 1), len(w), sum(x in counts for x in w), n, base)
    return out


def check_base(df, rows):
    want, got = base_scores(rows), {r["doc_id"]: r for r in df.collect()}
    assert set(got) == set(want)
    for d, (held, n, known, total, base) in want.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r["score"] < 0 or n == 0
    return got


def test_scores_of_documents(documents, pairs):
    got = check_base(hmm.score(documents), pairs)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_are_counted_by_the_join(documents, pairs, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 64)
    check_base(hmm.score(documents, rounds=1), pairs)


def test_scores_of_edge_cases(make, empty_docs):
    rows = [(1, None), (2, ""), (3, "Word word WORD"), (None, "word other"), (4, "x " * 50000), (6, "new words only here"), (8, "ünï ÄÄ")]
    check_base(hmm.score(make(rows)), rows)
    assert hmm.score(empty_docs).count() == 0
    held = next(i for i in range(100) if fold(i, 1))
    alone = hmm.score(make([(held, "nothing to learn")])).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["base_score"] == 0


def test_forward_sums_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    draw = np.random.default_rng(5)
    emit = draw.random((4, 3))
    move = draw.random((3, 3))
    model = hmm.Model(np.array([0.2, 0.3, 0.5]), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    sequences = [np.array([0, 1, 2, 3, 1]), np.array([2]), np.array([3, 3, 0])]
    some = hmm._Batch(sequences)
    got, _, _ = some.forward(model)
    import itertools

    for s, x in zip(sequences, got):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for a, b, o in zip(path, path[1:], s[1:]):
                p *= model.move[a, b] * model.emit[o, b]
            total += p
        assert x == pytest.approx(math.log10(total), rel=1e-12)
    # Expected counts against the same sum over paths.
    starts, moves, emits, _, _ = some.expected(model, 4)
    want_moves, want_emits, want_starts = np.zeros((3, 3)), np.zeros((4, 3)), np.zeros(3)
    for s in sequences:
        weights = {}
        for path in itertools.product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for a, b, o in zip(path, path[1:], s[1:]):
                p *= model.move[a, b] * model.emit[o, b]
            weights[path] = p
        z = sum(weights.values())
        for path, p in weights.items():
            want_starts[path[0]] += p / z
            for o, a in zip(s, path):
                want_emits[o, a] += p / z
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / z
    assert np.allclose(starts, want_starts) and np.allclose(moves, want_moves) and np.allclose(emits, want_emits)


def random_model(draw, states, classes):
    emit, move, start = draw.random((classes, states)), draw.random((states, states)), draw.random(states)
    return hmm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_a_long_text_is_not_cut(monkeypatch):
    draw = np.random.default_rng(6)
    model, s = random_model(draw, hmm.STATES, 40), draw.integers(0, 40, 1000)
    whole = hmm._Batch([s])
    want, likelihood = whole.expected(model, 40), whole.forward(model)[0][0]
    for chunk in (1, 7, 100, 999, 1000):
        monkeypatch.setattr(hmm, "CHUNK_TOKENS", chunk)
        assert hmm._long_likelihood(model, s) == pytest.approx(likelihood, rel=1e-12)
        for a, b in zip(hmm._long_expected(model, s, 40), want):
            assert np.allclose(a, b, rtol=1e-9, atol=1e-12)


def test_scores_are_the_likelihood_of_whole_documents(spark, documents, pairs, monkeypatch):
    """Every document's score from the fitted model, word by word in plain Python."""
    kept = []
    fit = hmm.fit

    def keep(encoded, v, rounds):
        kept.append((fit(encoded, v, rounds), v))
        return kept[0][0]

    monkeypatch.setattr(hmm, "fit", keep)
    monkeypatch.setattr(hmm, "HEAD", 500)
    got = {r["doc_id"]: r["score"] for r in hmm.score(documents, rounds=2).collect()}
    (model, _), v = kept[0]
    counts = {}
    for d, t in pairs:
        if not fold(d, 1):
            for w in tokens_of(t):
                counts[w] = counts.get(w, 0) + 1
    own = dict(zip(v.words.tolist(), v.classes.tolist()))
    classes = {}
    for w in {w for _, t in pairs for w in tokens_of(t)}:
        if w is None:
            classes[w] = (own[int(hmm.END)], 1.0)
            continue
        found, shared, _, _ = hmm._distinct([w])
        if int(found[0]) in own:
            classes[w] = (own[int(found[0])], 1.0)
        else:
            c = int(shared[0])
            classes[w] = (v.n_own + c, (counts.get(w, 0) + 0.5) / (v.shared_tokens[c] + 0.5 * (v.shared_words[c] + 1)))
    assert 0 < v.share_without_own < 1
    for d, t in pairs:
        state, total = model.start, 0.0
        for k, w in enumerate(tokens_of(t)):
            c, p = classes[w]
            state = (state if k == 0 else state @ model.move) * model.emit[c]
            total += math.log10(state.sum()) + math.log10(p)
            state = state / state.sum()
        assert got[d] == pytest.approx(total, rel=1e-9)


def test_likelihood_rises_with_every_round(spark, documents):
    counts = documents.select("text").mapInArrow(hmm._count_batches, "word long, shared int, n long")
    counts = counts.groupBy("word").agg(F.min("shared").alias("shared"), F.sum("n").alias("n")).cache()
    v = hmm.vocabulary(counts)
    sent = spark.sparkContext.broadcast(v)
    encoded = documents.select("doc_id", "text", F.lit(False).alias("held_out")).mapInArrow(hmm._encode_batches(sent), hmm._ENCODED)
    _, likelihoods = hmm.fit(encoded.cache(), v, 5)
    assert likelihoods == sorted(likelihoods) and likelihoods[-1] > likelihoods[0]


def test_word_probabilities_of_a_shared_class_sum_to_one():
    v = hmm.Vocabulary(
        np.array([], np.uint64), np.array([]), np.array([], np.int32), 0, 10, 4, np.full(hmm.SHARED, 10.0), np.full(hmm.SHARED, 4.0)
    )
    counts = np.array([4, 3, 2, 1])
    p = (counts + 0.5) / (v.shared_tokens[0] + 0.5 * (v.shared_words[0] + 1))
    assert p.sum() + 0.5 / (v.shared_tokens[0] + 0.5 * (v.shared_words[0] + 1)) == pytest.approx(1)
    assert len(set(mix(np.arange(1000, dtype=np.uint64)).tolist())) == 1000
