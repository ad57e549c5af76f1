"""Every registered query over the small tables, and the pipeline against a plain version of it."""

import brute
import pytest
from check_oracle import compare

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import mixing, nbsvm, queries, sharding
from tidemark.scratch import stored

COLUMNS = {
    "op1": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op2": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7": ["doc_id", "held_out", "score", "predicted"],
    "op8": ["doc_id", "n_shingles", "component_id", "kept"],
    "op9": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10": ["doc_id", "size", "source_size", "target", "taken"],
    "op11": ["page_id", "url", "text", "n_chars"],
    "op12": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def test_all_are_registered():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert df.columns == COLUMNS[name.split("_")[0]]
    number = name.split("_")[0]
    table = {"op6": "pages", "op11": "pages", "op12": "embeddings"}.get(number, "documents")
    each = 8 if number == "op12" else 1
    assert df.count() == each * spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, name, sf_dir)[0] == ""


def near_of_width(rows, width, hundredths=80):
    sets = {d: brute.shingles(t, width) for d, t in rows}
    kept = {}
    for d in sorted(sets):
        kept[d] = d

    def root(x):
        while kept[x] != x:
            x = kept[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= hundredths * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                kept[y] = x
    return [(d, t) for d, t in rows if root(d) == d]


def test_pipeline_stages(spark, sf_dir, documents):
    """Each stage, on what the stage before kept, gives what the plain version gives."""
    columns, docs = documents.columns, documents
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontamination", "mix", "shards"]

    def step(name):
        out = stored(stages[name](spark, docs, sf_dir), "stage")
        rows = [(r["doc_id"], r["text"]) for r in out.collect()] if "text" in out.columns else None
        return out, rows

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = nbsvm.quality(docs, labels).filter("predicted = 1")
    docs, rows = step("quality")
    assert docs.columns == columns and {r["doc_id"] for r in good.collect()} == {d for d, _ in rows}
    want = near_of_width(sorted(rows), 5)
    docs, rows = step("near_dedup")
    assert docs.columns == columns and sorted(rows) == want
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = brute.contamination(rows, items)
    docs, rows = step("decontamination")
    assert docs.columns == columns and sorted(d for d, _ in rows) == sorted(d for d, x in hit.items() if not x[4])
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken(docs).collect() if r["size"]}
    docs, rows = step("mix")
    assert docs.columns == columns
    assert {d: sum(x == d for x, _ in rows) for d in taken} == taken
    sizes, first = {}, {}
    for d, t in sorted(rows):
        first.setdefault(t, d)
        sizes[t] = sizes.get(t, 0) + len(t.encode()) + 1
    shards = step("shards")[0].collect()
    loads = {}
    for r in shards:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    ordered = [sizes[t] for t in sorted(sizes, key=lambda t: first[t])]
    assert len(shards) == len(rows) and max(loads.values()) <= brute.least_capacity(ordered, 16)


def test_pipeline_runs_as_a_whole(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == COLUMNS["op2"] and out.count() > 50
    assert sharding.BLOCKS > 0
