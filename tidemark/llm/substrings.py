"""Removal of passages that an earlier document holds too, by difference-cover anchors.

A difference cover of a period holds, for every distance, two members that far apart modulo the
period.  Hashes of short windows at the positions whose remainder is in the cover are the anchors.
Any two places where the same long window starts then share an anchor at the same distance from
their starts, whatever their remainders are, though only a fifth of all positions are hashed.

1. Anchors that occur once in the corpus are dropped; the others come back to their documents.
2. From each repeated anchor the text is extended to both sides: every long window around it is a
   candidate and hashed in full.  A shared window has an anchor in common, so none is missed.
3. Of each full window, told by two hashes of 64 bits, the least document is found; words covered by a window that a smaller
   document holds too are removed.

Documents whose whole text is a copy of a smaller one need no windows.  No step makes pairs.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .words import Words, as_long, chunks, mix, window_hashes, words_of

# Any constant gives the words other values, and their windows a second hash.
_SECOND = np.uint64(0x5851F42D4C957F2D)

#: A perfect difference set, every distance modulo 31 comes exactly once.
PERFECT_31 = (0, 1, 3, 8, 12, 18)


@lru_cache(maxsize=None)
def difference_cover(period: int) -> tuple[int, ...]:
    """Remainders such that every distance modulo ``period`` is one between two of them."""
    if period == 31:
        return PERFECT_31
    step = max(1, int(np.ceil(np.sqrt(period))))
    return tuple(sorted({r for r in range(min(step, period))} | {r for r in range(0, period, step)}))


def period_of(width: int) -> int:
    """The period for windows of ``width`` words; anchors have the other ``width - period + 1``."""
    return 31 if 40 <= width <= 70 else max(1, (width * 3) // 5)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


class _Anchors:
    def __init__(self, words: Words, width: int) -> None:
        self.words, self.width, self.period = words, width, period_of(width)
        self.length = width - self.period + 1
        counts = words.counts()
        owner = words.owner()
        local = np.arange(len(owner)) - words.offsets[owner]
        in_cover = np.zeros(self.period, bool)
        in_cover[list(difference_cover(self.period))] = True
        long_enough = (counts >= width)[owner]
        inside = local + self.length <= counts[owner]
        self.at = np.flatnonzero(in_cover[local % self.period] & inside & long_enough)
        rolled = window_hashes(words.hashes, self.length)
        self.hashes = rolled[self.at]
        self.owner = owner[self.at]

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of windows, among all words, that hold an anchor marked in ``repeated``."""
        n = len(self.words.hashes)
        marked = np.zeros(n + 1, np.int64)
        marked[self.at[repeated] + 1] = 1
        marked = np.cumsum(marked)
        owner = self.words.owner()
        start = np.arange(n)
        fits = start + self.width <= self.words.offsets[owner + 1]
        start = start[fits]
        return start[marked[start + self.period] > marked[start]]


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each owner's distinct hashes are, one place for each."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return order[keep]


def _anchor_counts(width: int):
    def run(batches):
        for batch in batches:
            texts = _texts(batch)
            for a, b in chunks(texts):
                found, n = np.unique(_Anchors(words_of(texts[a:b], False), width).hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(as_long(found)), pa.array(n)], names=["hash", "n"])

    return run


def _anchor_rows(width: int):
    def run(batches):
        for batch in batches:
            texts, ids = _texts(batch), np.asarray(batch.column("doc_id"))
            for a, b in chunks(texts):
                anchors = _Anchors(words_of(texts[a:b], False), width)
                one = _distinct(anchors.owner, anchors.hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(anchors.hashes[one])), pa.array(ids[a:b][anchors.owner[one]])],
                    names=["hash", "doc_id"],
                )

    return run


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _list(column: pa.Array, i: int) -> np.ndarray:
    return np.sort(np.asarray(column[i].values)) if column[i].is_valid else np.empty(0, np.int64)


def _first_pass(width: int):
    """Documents that are settled by now, and of the others the text and the runs of candidate windows."""

    def run(batches):
        for batch in batches:
            texts, anchors, is_copy = _texts(batch), batch.column("anchors"), batch.column("is_copy").to_pylist()
            for a, b in chunks(texts):
                words = words_of(texts[a:b], False)
                counts = words.counts()
                out = {"doc_id": batch.column("doc_id").slice(a, b - a), "n_words": pa.array(counts)}
                removed, sha, text, runs = [], [], [], []
                found = _Anchors(words, width)
                repeated = np.zeros(len(found.hashes), bool)
                bounds = np.searchsorted(found.owner, np.arange(b - a + 1))
                for i in range(a, b):
                    if anchors[i].is_valid and not is_copy[i]:
                        lo, hi = bounds[i - a], bounds[i - a + 1]
                        mine = _list(anchors, i).view(np.uint64)
                        repeated[lo:hi] = np.isin(found.hashes[lo:hi], mine)
                starts = found.candidates(repeated)
                at = np.searchsorted(starts, words.offsets)
                for i in range(a, b):
                    k = i - a
                    mine = starts[at[k] : at[k + 1]] - words.offsets[k]
                    if is_copy[i] and counts[k] >= width:
                        removed.append(int(counts[k]))
                        sha.append(_sha([]))
                    elif is_copy[i] or len(mine) == 0:
                        removed.append(0)
                        sha.append(_sha(texts[i].split()))
                    else:
                        removed.append(None)
                        sha.append(None)
                        edge = np.flatnonzero(np.diff(mine) != 1) + 1
                        first, last = mine[np.concatenate(([0], edge))], mine[np.concatenate((edge - 1, [len(mine) - 1]))]
                        text.append(texts[i])
                        runs.append(np.stack((first, last + 1), 1).ravel().astype(np.int32))
                        continue
                    text.append(None)
                    runs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *out.values(),
                        pa.array(removed, pa.int64()),
                        pa.array(sha, pa.string()),
                        pa.array(text, pa.binary()),
                        pa.array(runs, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "runs"],
                )

    return run


_FIRST = "doc_id long, n_words long, n_removed long, kept_sha256 string, text binary, runs array<int>"


def _windows(words: Words, runs: pa.Array, a: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and start (among all words) of every candidate window."""
    owner, start = [], []
    for k in range(len(words.offsets) - 1):
        pairs = np.asarray(runs[a + k].values).reshape(-1, 2)
        found = np.concatenate([np.arange(x, y) for x, y in pairs])
        owner.append(np.full(len(found), k))
        start.append(found + words.offsets[k])
    return np.concatenate(owner), np.concatenate(start)


def _window_rows(width: int):
    def run(batches):
        for batch in batches:
            texts, ids = _texts(batch), np.asarray(batch.column("doc_id"))
            for a, b in chunks(texts):
                words = words_of(texts[a:b], False)
                owner, start = _windows(words, batch.column("runs"), a, width)
                hashes = window_hashes(words.hashes, width)[start]
                second = window_hashes(mix(words.hashes ^ _SECOND), width)[start]
                one = _distinct(owner, hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(hashes[one])), pa.array(as_long(second[one])), pa.array(ids[a:b][owner[one]])],
                    names=["hash", "second", "doc_id"],
                )

    return run


def _last_pass(width: int):
    def run(batches):
        for batch in batches:
            texts, held = _texts(batch), batch.column("held")
            for a, b in chunks(texts):
                words = words_of(texts[a:b], False)
                owner, start = _windows(words, batch.column("runs"), a, width)
                hashes = window_hashes(words.hashes, width)[start]
                change = np.zeros(len(words.hashes) + 1, np.int64)
                bounds = np.searchsorted(owner, np.arange(b - a + 1))
                for k in range(b - a):
                    lo, hi = bounds[k], bounds[k + 1]
                    mine = _list(held, a + k).view(np.uint64)
                    hit = start[lo:hi][np.isin(hashes[lo:hi], mine)]
                    np.add.at(change, hit, 1)
                    np.add.at(change, hit + width, -1)
                gone = np.cumsum(change)[:-1] > 0
                removed, sha = [], []
                for k in range(b - a):
                    mine = gone[words.offsets[k] : words.offsets[k + 1]]
                    removed.append(int(mine.sum()))
                    sha.append(_sha([w for w, g in zip(texts[a + k].split(), mine.tolist()) if not g]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(words.counts()),
                        pa.array(removed, pa.int64()),
                        pa.array(sha),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256``.

    A word is removed if it lies in a window of ``width`` consecutive words whose word sequence also
    starts in a document with a smaller ``doc_id``, judged on the input.  ``kept_sha256`` is of the
    kept words joined by one space.  NULL and empty texts have no words, and texts shorter than a
    window lose none.  A repeat within one document, or between rows with equal ids, removes
    nothing; rows with a NULL id neither lose words nor make others lose any.  Order of equal rows
    does not matter, other columns are ignored, and an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.filter(F.col("doc_id").isNotNull())
    repeated = (
        known.mapInArrow(_anchor_counts(width), "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
        .select("hash")
    )
    rows = known.mapInArrow(_anchor_rows(width), "hash long, doc_id long").join(repeated, "hash", "left_semi")
    anchors = rows.groupBy("doc_id").agg(F.collect_set("hash").alias("anchors"))
    # Whole copies of a smaller document, found by the digest of the text.
    texts = stored(known.select("doc_id", F.sha2("text", 256).alias("sha")), "digests")
    least = texts.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    least = stored(least, "digests")  # written, so that adaptive execution can split a hot text's rows
    is_copy = F.min(F.col("doc_id") > F.col("least")).alias("is_copy")
    copies = texts.join(least, "sha").groupBy("doc_id").agg(is_copy, F.count(F.lit(1)).alias("n"))
    rows_of = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    # An id with several rows is settled by windows, unless each of them is a copy.
    copies = copies.join(rows_of, "doc_id").select("doc_id", (F.col("is_copy") & (F.col("n") == F.col("rows"))).alias("is_copy"))
    info = anchors.join(copies.filter("is_copy"), "doc_id", "left")
    joined = docs.join(info, "doc_id", "left").select(
        "doc_id", "text", "anchors", F.coalesce("is_copy", F.lit(False)).alias("is_copy")
    )
    first = stored(joined.mapInArrow(_first_pass(width), _FIRST), "passages")
    settled = first.filter(F.col("n_removed").isNotNull()).select("doc_id", "n_words", "n_removed", "kept_sha256")
    open_ = first.filter(F.col("n_removed").isNull()).select("doc_id", "text", "runs")
    windows = open_.mapInArrow(_window_rows(width), "hash long, second long, doc_id long")
    # Documents are compared by both hashes; within one, the first tells its windows apart.
    sources = windows.groupBy("hash", "second").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    sources = sources.filter("least < most").select("hash", "second", "least")
    held = windows.join(sources, ["hash", "second"]).filter("doc_id > least").groupBy("doc_id").agg(F.collect_set("hash").alias("held"))
    last = open_.join(held, "doc_id", "left").select("doc_id", "text", "runs", "held")
    return settled.unionByName(last.mapInArrow(_last_pass(width), _RESULT))
