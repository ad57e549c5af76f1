"""Near-duplicates by HyperMinHash sketches, with every link confirmed on full shingle sets.

A document's set holds its distinct shingles of ``width`` words (A-Z lower-cased); with fewer words
the whole sequence is one shingle; without words the set is empty and links with nothing.

1. One hash per shingle goes to one of 256 buckets.  A bucket keeps its least hash, compressed to
   the count of leading zeros and 10 mantissa bits.  Empty buckets borrow from a filled one in an
   order fixed per bucket, so that small sets have full sketches too.
2. Documents with equal sets are one vertex from here on.
3. Sketches are cut into 42 bands of 6 registers.  Two sets of similarity 0.8 share no band with a
   probability of 3 in a million.
4. Within a band's bucket every vertex is held against one centre, another one in every band.  The
   estimate from the sketches, corrected for chance collisions, drops pairs that are far off; the
   others are confirmed on their whole sets.  Confirmed links give components.
5. Buckets that still hold several components are left open.  All vertices outside the main
   component of such a bucket are held against all vertices of buckets with the same main component,
   in blocks: a task gets two blocks of texts, counts every intersection, and puts out links only.
   So no pair that shares a bucket is left undecided, and no row is made for a pair that is none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .components import components
from .words import as_long, chunks, mix, words_of
from .workers import free_name

REGISTERS = 256
ROWS = 6
BANDS = REGISTERS // ROWS
MANTISSA_BITS = 10
#: Two buckets of unrelated sets agree if both have the same leading-zero count (one in three) and mantissa.
COLLISION = 2.0**-MANTISSA_BITS / 3
#: Pairs are confirmed from this estimate on: six standard errors of 256 registers below 0.8.
SLACK = 6 * (0.8 * 0.2 / REGISTERS) ** 0.5

_ORDER = np.argsort(
    mix(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64)).reshape(REGISTERS, REGISTERS), axis=1
).astype(np.int64)


def shingle_sets(texts: list[bytes], width: int = 2) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(texts, lower=True)
    out = []
    for a, b in zip(words.offsets[:-1], words.offsets[1:]):
        h = words.hashes[a:b]
        if len(h) == 0:
            out.append(h)
            continue
        n = max(1, len(h) - width + 1)
        rolled = np.full(n, min(width, len(h)), np.uint64)
        for k in range(min(width, len(h))):
            rolled = mix(rolled ^ h[k : k + n])
        rolled.sort()
        keep = np.ones(n, bool)
        np.not_equal(rolled[1:], rolled[:-1], out=keep[1:])
        out.append(rolled[keep])
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 256 registers per set; rows of empty sets are 0."""
    n = len(sets)
    low = np.zeros(n * REGISTERS, np.uint64)
    for i, s in enumerate(sets):
        # Ascending hashes written backwards: the least of a bucket is written last and stays.
        back = s[::-1]
        low[i * REGISTERS + (back & np.uint64(REGISTERS - 1)).astype(np.int64)] = back | np.uint64(REGISTERS)
    filled = (low != 0).reshape(n, REGISTERS)
    # A double holds the exponent (leading zeros) and, first in its fraction, the mantissa bits.
    bits = (low >> np.uint64(8)).astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA_BITS)
    registers = (bits & np.uint64(0xFFFF)).astype(np.uint16).reshape(n, REGISTERS)
    some = filled.any(axis=1)
    row, slot = np.nonzero(~filled & some[:, None])
    step = 0
    while len(row):
        source = _ORDER[slot, step]
        hit = filled[row, source]
        registers[row[hit], slot[hit]] = registers[row[hit], source[hit]]
        row, slot = row[~hit], slot[~hit]
        step += 1
    registers[~some] = 0
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash per band and row; the band's number is part of it."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(registers), BANDS))
    parts = registers[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    packed_low = parts[:, :, 0] | parts[:, :, 1] << np.uint64(16) | parts[:, :, 2] << np.uint64(32)
    packed_high = parts[:, :, 3] | parts[:, :, 4] << np.uint64(16) | parts[:, :, 5] << np.uint64(32)
    return mix(mix(keys + packed_low * np.uint64(0x9E3779B97F4A7C15)) + packed_high)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of the sets behind rows of registers, corrected for chance collisions."""
    same = (a == b).mean(axis=-1)
    return (same - COLLISION) / (1 - COLLISION)


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


_SKETCHED = "doc_id long, n_shingles long, key_a long, key_b long, sketch binary"


def _sketch_batches(width: int):
    def run(batches):
        for batch in batches:
            texts = _texts(batch, "text")
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], width)
                registers = sketches(sets)
                counts = np.array([len(s) for s in sets], np.int64)
                first = [as_long(np.atleast_1d(mix(s).sum(dtype=np.uint64)))[0] for s in sets]
                second = [as_long(np.atleast_1d(mix(~s).sum(dtype=np.uint64)))[0] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(counts),
                        pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()),
                        pa.array([r.tobytes() for r in registers], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "sketch"],
                )

    return run


def sketch(docs: DataFrame, width: int = 2) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, sketch``; equal sets have equal keys and counts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketch_batches(width), _SKETCHED
    )


def _band_batches(batches):
    for batch in batches:
        registers = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        vertex = np.asarray(batch.column("vertex"))
        for a in range(0, len(vertex), 4096):
            keys = band_keys(registers[a : a + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_long(keys.ravel())), pa.array(np.repeat(vertex[a : a + 4096], BANDS))],
                names=["bucket", "vertex"],
            )


def _estimated(threshold: float):
    def run(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("sketch_a", "sketch_b")
            )
            keep = pa.array(estimate(a, b) >= threshold - SLACK)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _confirmed(threshold: float, width: int):
    hundredths = round(threshold * 100)

    def run(batches):
        last, last_set = None, None  # rows come sorted by a
        for batch in batches:
            ids_a, texts_a = batch.column("a").to_pylist(), batch.column("text_a")
            texts_b, keep = _texts(batch, "text_b"), []
            for x, y in chunks(texts_b):
                for i, other in zip(range(x, y), shingle_sets(texts_b[x:y], width)):
                    mine = texts_a[i].as_buffer().to_pybytes() if texts_a[i].is_valid else b""
                    if last is None or last != mine:
                        last, last_set = mine, shingle_sets([mine], width)[0]
                    common = len(np.intersect1d(last_set, other, assume_unique=True))
                    union = len(last_set) + len(other) - common
                    keep.append(union > 0 and 100 * common >= hundredths * union)
            assert len(keep) == len(ids_a)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked_blocks(threshold: float, width: int):
    """Links of the outer texts of a block with texts of other components, one per outer text and component."""
    hundredths = round(threshold * 100)

    def run(table: pa.Table) -> pa.Table:
        vertex, root = np.asarray(table.column("vertex")), np.asarray(table.column("root"))
        outer = np.asarray(table.column("outer").to_pylist(), bool)
        sets = shingle_sets([t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()], width)
        inner = np.flatnonzero(~outer)
        sizes = np.array([len(sets[i]) for i in inner], np.int64)
        links: list[tuple[int, int]] = []
        if len(inner):
            names, flat = np.unique(np.concatenate([sets[i] for i in inner]), return_inverse=True)
            begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            for x in np.flatnonzero(outer):
                at = np.searchsorted(names, sets[x])
                at = at[at < len(names)]
                have = np.zeros(len(names), np.int64)
                have[at[np.isin(names[at], sets[x])]] = 1
                common = np.add.reduceat(have[flat], begin)
                near = 100 * common >= hundredths * (len(sets[x]) + sizes - common)
                near &= root[inner] != root[x]
                _, first = np.unique(root[inner][near], return_index=True)
                links += [(int(vertex[x]), int(v)) for v in vertex[inner][near][first]]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


# Texts of each of the two sides of a block, on average.
BLOCK = 96


class _Finder:
    def __init__(self, docs: DataFrame, threshold: float, width: int) -> None:
        self.threshold, self.width = threshold, width
        self.sketched = stored(sketch(docs, width), "sketches")
        keys = ["key_a", "key_b", "n_shingles"]
        full = self.sketched.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        # Equal sets: the least id stands for all.
        self.vertices = stored(full.groupBy(*keys).agg(F.min("doc_id").alias("vertex")), "vertices")
        first = full.join(
            self.vertices.select(*[F.col(k).alias(f"v_{k}") for k in keys], "vertex"),
            [F.col("doc_id") == F.col("vertex")] + [F.col(k) == F.col(f"v_{k}") for k in keys],
        )
        # A repeated row has the same sketch.
        self.sketch_of = stored(first.groupBy("vertex", *keys).agg(F.first("sketch").alias("sketch")), "sketches")
        rows = self.sketch_of.select("vertex", "sketch").mapInArrow(_band_batches, "bucket long, vertex long")
        shared = rows.groupBy("bucket").agg(F.min("vertex").alias("l"), F.max("vertex").alias("h"))
        shared = stored(shared.filter("l < h").select("bucket"), "buckets")
        self.rows = stored(rows.join(shared, "bucket", "left_semi"), "bands")
        involved = self.rows.select("vertex").distinct()
        texts = docs.select(F.col("doc_id").cast("long").alias("vertex"), "text")
        self.texts = stored(texts.join(involved, "vertex", "left_semi").distinct(), "texts")

    def centred(self) -> DataFrame:
        """Links of vertices with the centres of their buckets."""
        turn = F.xxhash64("bucket", "vertex")
        centre = self.rows.groupBy("bucket").agg(F.min(F.struct(turn.alias("t"), "vertex")).getField("vertex").alias("c"))
        pairs = self.rows.join(stored(centre, "centres"), "bucket").filter("vertex != c")
        pairs = pairs.select(F.least("vertex", "c").alias("a"), F.greatest("vertex", "c").alias("b")).distinct()
        sketch_of = self.sketch_of.select("vertex", "sketch")
        for side in "ab":
            other = sketch_of.select(F.col("vertex").alias(side), F.col("sketch").alias(f"sketch_{side}"))
            pairs = pairs.join(other, side)
        near = stored(pairs.mapInArrow(_estimated(self.threshold), "a long, b long").distinct(), "pairs")
        for side in "ba":
            other = self.texts.select(F.col("vertex").alias(side), F.col("text").alias(f"text_{side}"))
            near = near.join(other, side)
        near = near.select("a", "b", "text_a", "text_b")
        return near.mapInArrow(_confirmed(self.threshold, self.width), "a long, b long").distinct()

    def crossing(self, roots: DataFrame) -> DataFrame:
        """Links between components that share a bucket."""
        rows = self.rows.join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
        sizes = stored(rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")), "sizes")
        main = sizes.groupBy("bucket").agg(
            F.max(F.struct("n", "root")).getField("root").alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all")
        )
        # In a bucket of two, the one pair has been held against each other.
        main = stored(main.filter("parts > 1 and all > 2").select("bucket", "main"), "open")
        near = stored(rows.join(main, "bucket").select("main", "vertex", "root").distinct(), "open")
        outer = F.col("root") != F.col("main")
        blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
        count = near.groupBy("main").agg(
            blocks(F.sum(F.when(outer, 1).otherwise(0))).alias("n_outer"), blocks(F.count(F.lit(1))).alias("n_inner")
        )
        near = near.join(stored(count, "open"), "main")
        place = lambda n: F.pmod(F.xxhash64("vertex"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = ["main", "vertex", "root", "outer", "i", "j"]
        xs = near.filter(outer).select("*", F.lit(True).alias("outer"), place("n_outer").alias("i"), every("n_inner").alias("j"))
        ys = near.select("*", F.lit(False).alias("outer"), place("n_inner").alias("j"), every("n_outer").alias("i"))
        both = stored(xs.select(*columns).unionByName(ys.select(*columns)), "blocks")
        filled = both.join(self.texts, "vertex").select(*columns, "text")
        return filled.groupBy("main", "i", "j").applyInArrow(
            _linked_blocks(self.threshold, self.width), "a long, b long"
        )

    def run(self) -> DataFrame:
        links = stored(self.centred(), "links")
        more = stored(self.crossing(components(links)), "links")
        return components(links.unionByName(more))


def near_components(docs: DataFrame, threshold: float = 0.8, width: int = 2) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``.

    Documents are linked from a similarity (shared by all shingles) of ``threshold`` on, a whole
    number of hundredths.  ``component_id`` is the least ``doc_id`` that links lead to, itself
    included; ``kept`` says that it is the document's own.  NULL and empty texts link with nothing
    and are kept; rows with a NULL id are kept, with themselves as component.  Rows that share an id
    are one document: any of their texts links it.  An empty table gives no rows.
    """
    finder = _Finder(docs.select("doc_id", "text"), threshold, width)
    roots = finder.run()
    keys = ["key_a", "key_b", "n_shingles"]
    vertices = finder.vertices.join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    out = finder.sketched.join(vertices.select(*keys, "root"), keys, "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("root")), F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, width: int = 2) -> DataFrame:
    """The documents that ``near_components`` keeps, with all their columns.

    Rows with empty text or a NULL id stay.  Rows that share an id stay or go together; of those that
    stay, rows with the same id and the same text are one document and one of them stays, different
    texts all stay.  An empty table gives no rows.  Columns may have any names.
    """
    found = near_components(docs, threshold, width)
    gone_id, key = free_name(docs, "__gone"), free_name(docs, "__text")
    gone = stored(found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct(), "gone")
    left = docs.join(gone, F.col("doc_id").cast("long") == F.col(gone_id), "left_anti")
    again = left.filter(F.col("doc_id").isNull())
    # A digest stands for the text, so that no text takes part in the comparison.
    named = left.filter(F.col("doc_id").isNotNull()).withColumn(key, F.coalesce(F.sha2("text", 256), F.lit("")))
    return named.dropDuplicates(["doc_id", key]).drop(key).unionByName(again)
