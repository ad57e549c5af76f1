"""Registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    edit_embedding,
    hmm,
    hyperminhash,
    main_text,
    mixing,
    nbsvm,
    oracle,
    records,
    runs,
    sharding,
    substrings,
    warc,
    whitening,
)
from .workers import reach


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.compare_with_next(_table(spark, sf_dir, "documents"))


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return records.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_components(_table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    edited = docs.select("doc_id", runs.repeat_tail(docs.text, docs.doc_id).alias("text"))
    return runs.digests(runs.periodic_runs(edited))


QUERIES = {
    f.__name__: f
    for f in (
        op1_edit_embedding,
        op2_minimax_shards,
        op3_token_records,
        op4_decontaminate,
        op5_hidden_markov,
        op6_warc,
        op7_quality,
        op8_hyperminhash,
        op9_substrings,
        op10_mix_sources,
        op11_main_text,
        op12_whitening,
        op13_runs,
    )
}

ORACLE_SQL = {
    "op4_decontaminate": decontaminate.HITS_SQL.strip(),
    "op6_warc": oracle.WARC_SQL.strip(),
    "op8_hyperminhash": oracle.NEAR_SQL.strip(),
    "op9_substrings": oracle.REPEATS_SQL.strip(),
    "op10_mix_sources": mixing.MIX_SQL.strip(),
}
