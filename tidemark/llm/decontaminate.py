"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item; an item with fewer words, but not none,
is one window.  A document word inside any occurrence of a window is hit.

1. The shingles (three words in a row) of the documents are looked up among those of the benchmark.
   What matches is written once; it is all that later steps need from the corpus' shingles.
2. Shingles are ordered by rarity, that is by their number in the corpus.  A window can only occur
   where all its shingles do, so its rarest one is prefix enough, and a window with a shingle that
   the corpus lacks is out.
3. Where the prefix occurs, the window's start follows from its place in the window; starts before
   the document, or too near its end, are out.
4. What is left is compared word for word in the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .workers import free_name

# Everything in ASCII but digits and letters separates words.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 3
# Tables made from the benchmark are broadcast up to this many rows, 40 bytes each; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column | str) -> Column:
    """Words of a text with A-Z lower-cased; no words for NULL."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # lower() also changes letters beyond ASCII, so it only serves texts without any.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lower, _SEPARATORS), "")


def _shingles(wide: Column, width: int) -> Column:
    """Struct of the words of each shingle, by position; arrays of one length are zipped."""
    n = F.size(wide) - (width - 1)
    return F.arrays_zip(*[F.slice(wide, k + 1, F.greatest(n, F.lit(0))).alias(f"w{k}") for k in range(width)])


def _hash(zipped: str, width: int) -> Column:
    return F.xxhash64(*[F.col(f"{zipped}.w{k}") for k in range(width)], F.lit(width))


def _few(df: DataFrame) -> DataFrame:
    """For a broadcast if the (written) table is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows(benchmark: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``window, n, shingles`` with their place) and ``window, item_id`` of each item."""
    items = benchmark.select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(size))
    places = F.sequence(F.lit(1), F.size("w") - length + 1)
    rows = items.select("item_id", "w", length.alias("n"), F.explode(places).alias("at"))
    rows = rows.select("item_id", "n", F.slice("w", F.col("at"), F.col("n")).alias("words"))
    rows = stored(rows.withColumn("window", F.array_join("words", " ")), "windows")
    of_item = stored(rows.select("window", F.col("item_id").cast("string").alias("item_id")).distinct(), "items")
    return stored(rows.groupBy("window").agg(F.first("words").alias("words"), F.first("n").alias("n")), "windows"), of_item


def _window_shingles(distinct: DataFrame) -> DataFrame:
    """``window, n, width, offset, shingle``: every shingle of every window."""
    out = None
    for width in range(1, SHINGLE + 1):
        which = F.col("n") == width if width < SHINGLE else F.col("n") >= width
        part = distinct.filter(which).select("window", "n", F.posexplode(_shingles(F.col("words"), width)).alias("offset", "s"))
        part = part.select("window", "n", "offset", _hash("s", width).alias("shingle"), F.lit(width).alias("width"))
        out = part if out is None else out.unionByName(part)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Candidates ``doc_id, text_key, start, n, window`` (0-based start), and ``window, item_id``."""
    distinct, of_item = windows(benchmark, size)
    parts = stored(_window_shingles(distinct), "shingles")
    vocabulary = stored(parts.select("shingle").distinct(), "shingles")
    widths = [r[0] for r in parts.select("width").distinct().orderBy("width").collect()]  # 1, 2, 3 at most
    wanted, found = _few(vocabulary), None
    split = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words("text").alias("w"))
    for width in widths:
        rows = split.filter(F.size("w") >= width).select(
            "doc_id", "text_key", F.size("w").alias("n_words"), F.posexplode(_shingles(F.col("w"), width)).alias("pos", "s")
        )
        rows = rows.select("doc_id", "text_key", "n_words", "pos", _hash("s", width).alias("shingle"))
        rows = rows.join(wanted, "shingle", "left_semi")
        found = rows if found is None else found.unionByName(rows)
    if found is None:  # no item has a word
        found = split.select("doc_id", "text_key", F.size("w").alias("n_words"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("shingle")).limit(0)
    found = stored(found, "matches")
    rarity = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_corpus"))
    ranked = parts.join(rarity, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("n_corpus", F.lit(0)).alias("n_corpus"), "offset", "shingle")).alias("rarest")
    )
    prefix = ranked.filter("rarest.n_corpus > 0").select("window", "n", "rarest.offset", "rarest.shingle")
    prefix = stored(prefix, "prefixes")
    start = F.col("pos") - F.col("offset")
    candidates = found.join(_few(prefix), "shingle").select("doc_id", "text_key", "n_words", start.alias("start"), "n", "window")
    candidates = candidates.filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
    return candidates.select("doc_id", "text_key", "start", "n", "window").distinct(), of_item


def _checked(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_key, n_words, n_hit, windows`` (NULL without a hit) of every row, and ``window, item_id``."""
    docs = docs.select("doc_id", "text")
    candidates, of_item = matches(docs, benchmark, size)
    by_doc = candidates.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n", "window")).alias("found"))
    by_doc = by_doc.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "found")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    joined = keyed.join(by_doc, same, "left").select("doc_id", "text_key", words("text").alias("w"), "found")
    true = F.filter("found", lambda c: F.array_join(F.slice("w", c["start"] + 1, c["n"]), " ") == c["window"])
    checked = joined.select("doc_id", "text_key", F.size("w").alias("n_words"), F.when(F.col("found").isNotNull(), true).alias("true"))
    covered = F.flatten(F.transform("true", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    checked = checked.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.when(F.size("true") > 0, F.size(F.array_distinct(covered))).otherwise(0).cast("long").alias("n_hit"),
        F.when(F.size("true") > 0, F.array_distinct(F.transform("true", lambda c: c["window"]))).alias("windows"),
    )
    return stored(checked, "hits"), of_item


def hits(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts words inside occurrences of windows, ``n_items`` the items with occurring
    windows; ``items_sha256`` is of their ids, sorted as strings and joined by commas (of nothing if
    there are none).  NULL text has no words; an item without words has no window, and its id does
    not count; a NULL item id counts as none.  Repeated documents are judged alike, each row; an
    empty table of documents gives no rows, an empty benchmark no hits.
    """
    checked, of_item = _checked(docs, benchmark, size)
    seen = checked.filter("n_hit > 0").select("doc_id", "text_key", F.explode("windows").alias("window")).distinct()
    ids = seen.join(of_item.filter("item_id IS NOT NULL"), "window").groupBy("doc_id", "text_key")
    ids = ids.agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    ids = ids.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "ids")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    joined = checked.join(ids, same, "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents without a hit, with all their columns.

    Rows that share an id, or have none, are told by their text; repeated rows stay or go together.  NULL
    and empty texts stay.  An empty benchmark drops nothing, an empty table gives no rows.  Columns
    may have any names.
    """
    checked, _ = _checked(docs, benchmark, size)
    hit, key = free_name(docs, "__hit"), free_name(docs, "__key")
    found = checked.filter("n_hit > 0").select(F.col("doc_id").alias(hit), F.col("text_key").alias(key)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(hit)) & (F.xxhash64("text") == F.col(key))
    return docs.join(stored(found, "hits"), same, "left_anti")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The same rows from another engine: every window of every document is compared.
HITS_SQL = rf"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
iw AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT rid, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, sizes WHERE len(w) >= n)),
found AS (SELECT d.rid, d.s, d.n, i.item_id FROM doc_windows d JOIN windows i USING (n, win)),
words_hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM found) GROUP BY rid),
items_hit AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit USING (rid) LEFT JOIN items_hit USING (rid)
"""
