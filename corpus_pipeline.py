"""From raw documents to the shards of a training mix.

Each stage is one operator of ``tidemark.llm``, reads all that the stage before kept and returns the
columns of ``documents``; the last one returns the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, hyperminhash, mixing, nbsvm, sharding
from tidemark.llm.workers import reach
from tidemark.scratch import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return nbsvm.keep_good(_documents(docs), _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of every group of near-duplicates on five-word shingles."""
    reach(spark)
    return hyperminhash.keep_one(_documents(docs), threshold=0.8, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(_documents(docs), _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.mix(_documents(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every copy; copies of a text stay together."""
    return sharding.shard_documents(_documents(docs))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

# The classifier has no SQL; the whole is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
