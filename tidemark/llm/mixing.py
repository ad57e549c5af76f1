"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .workers import free_name

WORD = r"[^\x20\x09-\x0D]+"
# Rates are broadcast up to this many sources; more are joined by shuffle.
BROADCAST_SOURCES = 100_000


def n_words(text: Column | str) -> Column:
    """Number of words (runs without ASCII white space); 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """One row per source with ``source_size``, ``target`` and ``rate``.

    ``sizes`` has ``source`` and ``size``.  Sources are ordered by code point, NULL last, and take
    the weights in turn.  Together they get ``share`` times all sizes; a source stops at ``most``
    times its own size, and what it leaves goes to the others by weight.  The level at which the
    others end follows from the sources in order of size by weight: those before it are full.
    An empty table gives no sources; a source of size 0 gets target and rate 0.
    """
    # One row a source from here on, so that windows without partitions stay small.
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = (rank - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    total = total.withColumn("rank", rank).withColumn("weight", weight)
    full = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("source_size").over(full), F.lit(0)) * F.lit(float(most))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0)))
    total = total.withColumn("level", level)
    cap = F.col("source_size") * F.lit(float(most))
    total = total.withColumn("is_full", F.col("level") * F.col("weight") >= cap)
    final = F.max(F.when(~F.col("is_full"), F.col("level"))).over(everything)
    target = F.when(F.col("is_full"), cap).otherwise(final * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return total.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(doc_id: Column, rate: Column, seed: int = 0) -> Column:
    """floor(rate), plus one with the probability of the fraction, drawn by hashing the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def with_rates(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``rates``, matched by ``source`` (NULL matches NULL).

    The rates are few rows, and are broadcast after a check of their number: a source with a third
    of all rows then needs no shuffle.
    """
    other = free_name(docs, "__source")
    rates = stored(rates.withColumnRenamed("source", other), "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    return docs.join(rates, F.col("source").eqNullSafe(F.col(other)), "left").drop(other)


def taken(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` (words that the mix takes of it).

    Repeated ids draw alike; a NULL id draws as an empty one; NULL text has size 0.
    """
    sizes = stored(docs.select("doc_id", "source", n_words("text").alias("size")), "sizes")
    out = with_rates(sizes, source_rates(sizes))
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies(F.col("doc_id"), F.col("rate"), seed)).alias("taken"),
    )


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, with the same columns.

    Repeated ids draw alike, each row; a NULL id draws as an empty one, a NULL source is a source of its
    own, and texts without words are taken as often as their source's rate says.  An empty table
    gives no rows.  Columns may have any names.
    """
    columns, rate, copy = docs.columns, free_name(docs, "__rate"), free_name(docs, "__copy")
    rates = source_rates(docs.select("source", n_words("text").alias("size")))
    rated = with_rates(docs, rates.select("source", F.col("rate").alias(rate)))
    times = F.array_repeat(F.lit(0), copies(F.col("doc_id"), F.col(rate), seed).cast("int"))
    return rated.select(*[F.col(f"`{c}`") for c in columns], F.explode(times).alias(copy)).drop(copy)


# The same rows from another engine.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM per_source),
weighed AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM ranked),
levels AS (
  SELECT *,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0::DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
flagged AS (SELECT *, level * weight >= source_size * 2.0::DOUBLE AS is_full FROM levels),
targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN source_size * 2.0::DOUBLE
         ELSE max(CASE WHEN NOT is_full THEN level END) OVER () * weight END AS target
  FROM flagged),
drawn AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('0:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""
