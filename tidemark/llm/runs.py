"""Periodic runs of words: stretches that repeat a shorter stretch at least twice in a row.

A run is a stretch of consecutive words with smallest period ``q`` and length ``>= 2 q`` that no
neighbouring word extends.  They are found by a suffix automaton whose link tree is walked like a
link-cut tree: after each word, the path from the prefix's state to the root gets the colour of
this end.  The path falls into segments by the colour, that is the last end, they had before.  Where
a segment was last seen at end ``e``, and its longest word sequence is at least ``i - e`` long, the
words before ``i`` are a square of period ``i - e``.  Recolouring keeps the number of segments met at
``O(log n)`` a word.  Every primitive square is met where it ends first, and only those: a segment
that was last seen a multiple of its true period ago does not exist.  Squares are then extended to
both sides.

Before that, words that no run can hold are set aside.  In a run of 12 words or more every word is
in a six-word sequence that the same run holds twice (where it holds another number of words at
least, the sequence is half as long).  The automaton gets only stretches of such words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import chunks, window_hashes, words_of

MIN_LENGTH = 12


class Automaton:
    """Suffix automaton of a word sequence: the length and link of each state, and each prefix's state.

    State 1 is the root, 0 is none.  Most states have one transition, which is kept in two lists;
    only states with more have a table.
    """

    def __init__(self, sequence: list[int]) -> None:
        self.length, self.link = [0, 0], [0, 0]
        self.word, self.to = [-1, -1], [0, 0]
        self.more: dict[int, dict[int, int]] = {}
        self.prefix: list[int] = []
        last = 1
        for w in sequence:
            last = self._append(last, w)
            self.prefix.append(last)

    def _state(self, length: int, link: int, word: int, to: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(word)
        self.to.append(to)
        return len(self.length) - 1

    def _append(self, last: int, w: int) -> int:
        length, link, word, to, more = self.length, self.link, self.word, self.to, self.more
        new = self._state(length[last] + 1, 1, -1, 0)
        p = last
        while p:
            if word[p] == w:
                q = to[p]
                break
            if word[p] < 0:
                word[p], to[p] = w, new
            else:
                table = more.get(p)
                if table is None:
                    more[p] = {w: new}
                elif w in table:
                    q = table[w]
                    break
                else:
                    table[w] = new
            p = link[p]
        else:
            return new
        if length[q] == length[p] + 1:
            link[new] = q
            return new
        copy = self._state(length[p] + 1, link[q], word[q], to[q])
        if q in more:
            more[copy] = dict(more[q])
        link[q] = link[new] = copy
        while p:
            if word[p] == w:
                if to[p] != q:
                    break
                to[p] = copy
            else:
                table = more.get(p)
                if table is None or table.get(w) != q:
                    break
                table[w] = copy
            p = link[p]
        return new


class Paths:
    """The link tree as paths of one colour, each a splay tree by depth, as in a link-cut tree.

    A path's colour is kept at its splay root; ``up`` of a splay root is the state above the path.
    """

    def __init__(self, automaton: Automaton) -> None:
        n = len(automaton.length)
        self.length, self.up = automaton.length, list(automaton.link)
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                break
            g = up[p]
            top = p
            if g and (left[g] == p or right[g] == p):
                top = g
                if (left[g] == p) == (left[p] == x):
                    self._rotate(p)
                else:
                    self._rotate(x)
            self._rotate(x)
        self.colour[x] = self.colour[top]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[p], up[x] = x, g

    def access(self, state: int, end: int) -> list[int]:
        """Recolour the path to the root with ``end``; the periods of squares that end here."""
        up, right, colour, length = self.up, self.right, self.colour, self.length
        periods = []
        below, x = 0, state
        while x:
            self._splay(x)
            seen, cut = colour[x], right[x]
            if cut:
                colour[cut] = seen
            right[x] = below
            if seen >= 0 and end - seen <= length[x]:
                periods.append(end - seen)
            below, x = x, up[x]
        self._splay(state)
        colour[state] = end
        return periods


def runs_of(sequence: list[int], min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of at least ``min_length`` words, by start, then period."""
    automaton, n = Automaton(sequence), len(sequence)
    paths, reached, found = Paths(automaton), {}, []
    for i, state in enumerate(automaton.prefix):
        for q in paths.access(state, i):
            if reached.get(q, -1) >= i:  # the same run, met before
                continue
            start, end = i - 2 * q + 1, i + 1
            while start > 0 and sequence[start - 1] == sequence[start - 1 + q]:
                start -= 1
            while end < n and sequence[end] == sequence[end - q]:
                end += 1
            reached[q] = end - 1
            if end - start >= min_length:
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(inside: np.ndarray, part: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of marked words of one part, ``least`` words or longer."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    # Where the part changes within a stretch, it ends.
    cuts = np.flatnonzero((part[1:] != part[:-1]) & inside[1:] & inside[:-1]) + 1
    starts, ends = np.sort(np.concatenate((starts, cuts))), np.sort(np.concatenate((ends, cuts)))
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def candidates(hashes: np.ndarray, owner: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that may hold runs; every run lies within one of them."""
    width = max(1, min_length // 2)
    place, part = np.arange(len(hashes)), owner
    while len(hashes):
        windows = window_hashes(hashes, width)
        n = len(windows)
        whole = (part[: max(n, 0)] == part[width - 1 : width - 1 + n]) & (
            place[:n] + width - 1 == place[width - 1 : width - 1 + n]
        )
        at = np.flatnonzero(whole)
        order = np.lexsort((windows[at], part[at]))
        w, p = windows[at][order], part[at][order]
        same = (w[1:] == w[:-1]) & (p[1:] == p[:-1])
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        marks = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(marks, at[order][twice], 1)
        np.add.at(marks, at[order][twice] + width, -1)
        inside = np.cumsum(marks[:-1]) > 0
        starts, ends = _stretches(inside, part, min_length)
        sizes = ends - starts
        kept = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        if len(kept) == len(hashes):
            return place[starts], place[ends - 1] + 1
        # What is left is searched again, now with each stretch by itself.
        part = np.repeat(np.arange(len(starts)), sizes)
        hashes, place = hashes[kept], place[kept]
    return np.empty(0, np.int64), np.empty(0, np.int64)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _finder(min_length: int):
    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in chunks(texts):
                words = words_of(texts[a:b], lower=False)
                starts, ends = candidates(words.hashes, words.owner(), min_length)
                of = np.searchsorted(words.offsets, starts, "right") - 1
                by_text: dict[int, list[tuple[int, int]]] = {}
                for k, s, e in zip(of.tolist(), starts.tolist(), ends.tolist()):
                    first = int(words.offsets[k])
                    by_text.setdefault(k, []).append((s - first, e - first))
                spans, texts_out = [], []
                for k, text in enumerate(texts[a:b]):
                    split, found = text.split(), []  # bytes split at the same six bytes
                    for s, e in by_text.get(k, ()):
                        numbers: dict[bytes, int] = {}
                        sequence = [numbers.setdefault(w, len(numbers)) for w in split[s:e]]
                        found += [(s + start, length, q) for start, length, q in runs_of(sequence, min_length)]
                    texts_out.append(_collapsed(split, found) if found else b" ".join(split))
                    spans.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(spans, pa.list_(_SPAN)),
                        pa.array(texts_out, pa.binary()).cast(pa.string(), safe=False),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id``, ``runs`` (``start, length, period`` by start, then period) and ``collapsed`` of each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``collapsed`` is the text without the words
    that a run holds after its first period, the others joined by one space.  NULL and empty texts
    have no runs and an empty text; NULL ids stay; repeated rows give repeated rows; an empty table
    gives none; other columns are left out.  Texts are never cut: a text's automaton is the largest
    thing a task holds, about 300 bytes a word of the stretches that may hold runs.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(_finder(min_length), _FOUND)


def repeat_tail(text: Column, doc_id: Column) -> Column:
    """The text, for a tenth of the ids with its tail replaced by repetitions of the tail's beginning.

    With ``h`` the crc32 of the decimal id and ``g = h div 10``: where ``h % 10`` is 0 and the text has
    ``n > 0`` words, word ``i >= a`` becomes word ``a + (i - a) % p``; ``a = g % n``, ``p = 1 + (n - a) div (3 + g % 8)``.
    """
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(some: Column) -> Column:
        n = F.size(some).cast("long")
        g = F.floor(h / 10)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        changed = F.transform(at, lambda i: F.get(some, source(i).cast("int")))
        return F.when(n > 0, F.array_join(changed, " ")).otherwise(F.lit(""))

    # One-element arrays name an intermediate value, so that it is computed once a row.
    edited = F.element_at(F.transform(F.array(words), tail), 1)
    return F.when(doc_id.isNotNull() & text.isNotNull() & (h % 10 == 0), edited).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: the number of runs, the longest one, and digests of all runs and of the text left.

    Ties go to the smallest start, then to the smallest period.  Without a run the four columns of
    the longest one are NULL and the digests are those of no text and of the words joined.
    """
    order = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = F.array_min(order)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["l"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-best["l"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
