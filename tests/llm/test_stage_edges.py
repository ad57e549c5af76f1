"""Pipeline stages on clashing names, repeated ids, NULLs and empty tables; nothing else goes with what goes."""

import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, hyperminhash, mixing

NAMES = ["__gone", "__text", "__rate", "__copy", "__source", "__hit", "__key", "__copy_"]
LONG = " ".join(f"word{i}" for i in range(60))


def clashing(make, rows):
    df = make(rows)
    for name in NAMES:
        df = df.withColumn(name, df.doc_id.cast("string"))
    return df


def test_near_dedup_loses_no_text(make):
    rows = [
        (1, LONG), (2, f"{LONG} more"), (3, "a text of its own here"), (3, "quite another text of its own"), (3, "a text of its own here"),
        (4, None), (4, ""), (5, None), (None, "no id here"), (None, "no id here"),
    ]
    kept = hyperminhash.keep_one(clashing(make, rows))
    assert set(kept.columns) == set(clashing(make, rows).columns)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [
        (1, LONG), (3, "a text of its own here"), (3, "quite another text of its own"), (5, None),
        (None, "no id here"), (None, "no id here"),
    ]
    # NULL and empty text of one id are the same: no words.
    assert [x for x in got if x[0] != 4] == sorted(want, key=str) and sum(x[0] == 4 for x in got) >= 1


def test_stages_take_clashing_names(spark, make):
    rows = [(1, "the secret item of the benchmark is in here now"), (2, "clean text"), (None, "clean text too")]
    docs = clashing(make, rows)
    bench = spark.createDataFrame([("i", "the secret item of the benchmark is in here now")], "item_id string, text string")
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(str(r["doc_id"]) for r in clean.collect()) == ["2", "None"]
    mixed = mixing.mix(docs)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken(docs).collect()}
    assert mixed.columns == docs.columns and mixed.count() == sum(taken.values())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_empty_and_odd_tables(spark, make, empty_docs, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, empty_docs, sf_dir).count() == 0
    rows = [(1, None), (2, ""), (2, ""), (None, "one two three"), (3, "tie " * 30), (3, "tie " * 30), (4, "x" * 200_000)]
    out = stage(spark, clashing(make, rows), sf_dir)
    assert out.count() >= 1
    if name != "shards":
        assert out.columns == corpus_pipeline.COLUMNS
