import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm.workers import reach  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return reach(spark)


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with columns of clashing names."""

    def build(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("shard", "size", "vertex", "a", "hash", "rate", "window", "label", "rid", "part"):
                df = df.withColumn(name, df.doc_id.cast("string"))
        return df

    return build


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]

