"""Document fingerprints by randomised edit embedding.

A walk reads a text from its start.  At every step it sees the character at its position, and a
random bit that depends on the step and the character, the same for all texts, says whether it
moves on.  Texts that differ by few edits see the same characters at most steps, so their edit
distance becomes a Hamming distance between the sequences seen.

A fingerprint samples that sequence: every slot ranks all steps at random, the same way for all
texts, and takes the best-ranked step before its walk ends.  So a slot is a uniform sample of the
walk whatever the length is, and two texts of like length sample the same steps.  Of the eight
characters seen from there on it keeps four bits, one hexadecimal digit.  The likeness of two
fingerprints is the share of equal slots, corrected for equality by chance.

``near_pairs`` takes its bands from the same walks: two slots of one walk, with all bits of what they
saw, are a band.  Members of a band's bucket are verified by their true edit distance, each pair once.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .components import components
from .words import mix

WALKS, SLOTS = 4, 32
# Of near_pairs: slots a band, and bands.
BAND = 2
BANDS = WALKS * SLOTS // BAND
# Members of a bucket that one task holds against as many others, on average.
BLOCK = 96
SEEN = 8  # characters a slot samples
CHANCE = 1 / 16
_FAR = 1 << 40
# A bound on the characters walked at once.
CHUNK = 12 << 20
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _sampled_steps() -> dict[int, list[int]]:
    """Step -> slots that rank it above all earlier steps; drawn by the gaps between such steps."""
    steps: dict[int, list[int]] = defaultdict(list)
    for slot in range(WALKS * SLOTS):
        draw = np.random.default_rng(1000 + slot)
        step, best = 0, draw.random()
        while step < _FAR:
            steps[step].append(slot)
            step += int(min(_FAR, draw.geometric(max(best, 1e-15))))
            best *= draw.random()
    return dict(steps)


_SAMPLED = _sampled_steps()
_CLASSES = (mix(np.arange(1, 65537, dtype=np.uint64)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def _classes(text: str) -> np.ndarray:
    """Every character as one of 255 classes; 0 stands for the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASSES[(points ^ (points >> np.uint32(16)) * np.uint32(0x9E37)) & np.uint32(0xFFFF)]


def _moves(block: int) -> np.ndarray:
    """Whether walk ``w`` moves at step ``64 * block + s`` on class ``c``: ``[s, 256 * w + c]``."""
    cells = mix(np.arange(WALKS * 256, dtype=np.uint64) + np.uint64((block + 1) << 12))
    bits = (cells[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)
    bits = bits.astype(np.int64)
    bits[:, 0::256] = 0  # nothing moves past the end
    return bits


def samples(texts: list[str]) -> np.ndarray:
    """One row per text: what each of ``WALKS * SLOTS`` slots saw, as 64 bits; all 0 for an empty text."""
    out = np.zeros((len(texts), WALKS * SLOTS), np.uint64)
    if not texts:
        return out
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    pad = np.zeros(SEEN, np.uint8)
    flat = np.concatenate([x for i in order for x in (_classes(texts[i]), pad)])
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + SEEN)))[:-1]
    at = np.tile(begin, (WALKS, 1))
    end = begin + sizes
    shift = (256 * np.arange(WALKS, dtype=np.int64))[:, None]
    row = np.array(order)
    block = 0
    while True:
        alive = (at < end).any(axis=0)
        if not alive.all():
            at, end, row = at[:, alive], end[alive], row[alive]
        if not len(row):
            return out
        moves = _moves(block)
        for s in range(64):
            slots = _SAMPLED.get(64 * block + s)
            if slots:
                for slot in slots:
                    w = slot // SLOTS
                    still = at[w] < end
                    here = at[w][still]
                    seen = np.zeros(len(here), np.uint64)
                    for k in range(SEEN):
                        seen = seen << np.uint64(8) | flat[here + k]
                    out[row[still], slot] = mix(seen + np.uint64(slot))
            at += moves[s][flat[at] + shift]
        block += 1


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of ``WALKS * SLOTS`` values from 0 to 15 per text: four bits of each sample; all 0 for an empty text."""
    return (samples(texts) & np.uint64(15)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots of each row, corrected for chance; 1 for equal rows, 0 at least."""
    same = (a == b).mean(axis=-1)
    return np.maximum(0.0, (same - CHANCE) / (1 - CHANCE))


def as_text(rows: np.ndarray) -> list[str]:
    return [r.tobytes().decode() for r in _HEX[rows]]


def from_text(texts: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(texts).encode(), np.uint8).reshape(-1, WALKS * SLOTS).astype(np.int16)
    return (raw - np.where(raw >= 97, 87, 48)).astype(np.uint8)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _groups(sizes: list[int], limit: int):
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _compared(ids: list, texts: list[str]) -> list[list]:
    """Columns for every document but the last, which only is the next one of the one before."""
    columns: list[list] = [[] for _ in range(7)]
    for a, b in _groups([2 * len(t) for t in texts[:-1]], CHUNK):
        changed = [edited(texts[i], texts[i + 1]) for i in range(a, b)]
        prints = fingerprints(texts[a : b + 1] + changed)
        own, after, other = prints[: b - a], prints[1 : b - a + 1], prints[b - a + 1 :]
        for column, values in zip(columns, (
            ids[a:b],
            [len(t) for t in texts[a:b]],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            as_text(own),
            as_text(other),
            likeness(own, other).tolist(),
            likeness(own, after).tolist(),
        )):
            column.extend(values)
    return columns


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_WITH_ENDS = _RESULT + ", part int, is_first boolean, text string"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = pa.schema([(c.split()[0], t) for c, t in zip(_RESULT.split(", "), _TYPES)])
_SCHEMA_ENDS = pa.schema([*_SCHEMA, ("part", pa.int32()), ("is_first", pa.bool_()), ("text", pa.string())])


def _strings(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _in_order(batches):
    """Compare neighbours; the first and the last document of the partition also go out with their text."""
    part, held, started = TaskContext.get().partitionId(), None, False

    def end(doc_id, text, is_first):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip([doc_id, *[None] * 6, part, is_first, text], _SCHEMA_ENDS)],
            schema=_SCHEMA_ENDS,
        )

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), _strings(batch.column("text"))
        if not ids:
            continue
        if not started:
            started = True
            yield end(ids[0], texts[0], True)
        if held is not None:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = ids[-1], texts[-1]
        columns = _compared(ids, texts)
        n = len(columns[0])
        arrays = [pa.array(c, f.type) for c, f in zip([*columns, *[[None] * n] * 3], _SCHEMA_ENDS)]
        yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA_ENDS)
    if held is not None:
        yield end(*held, False)


def _at_borders(batches):
    for batch in batches:
        texts, nexts = _strings(batch.column("text")), _strings(batch.column("next_text"))
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            columns = _compared([doc_id, None], [texts[i], nexts[i]])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text edited with the next document's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The next document is that with the next ``doc_id`` (NULL first; rows with equal ids by the hash
    of their text), after the last the first; a single document follows itself.  NULL text counts as
    empty; an empty text has the fingerprint of zeros.  Other columns are ignored, and an empty
    table gives no rows.

    Texts move once, into ranges of ids.  Only the two ends of a range have a neighbour elsewhere;
    they are matched afterwards.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # By the text as well, so that rows of one id, or of none, need not meet in one task.
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(ranged.mapInArrow(_in_order, _WITH_ENDS), "fingerprints")
    ends = found.filter(F.col("part").isNotNull())
    firsts = ends.filter("is_first").select("part", F.col("text").alias("next_text"))
    # One row a partition from here on, without texts where a window needs one task.
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    follow = ends.filter("is_first").select("part").select("part", following.alias("next_part"))
    lasts = ends.filter("not is_first").select("doc_id", "text", "part").join(follow, "part")
    borders = lasts.join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    rest = borders.select("doc_id", "text", "next_text").mapInArrow(_at_borders, _RESULT)
    return found.filter(F.col("part").isNull()).select(*_SCHEMA.names).unionByName(rest)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every text; NULL counts as empty."""

    def run(batches):
        for batch in batches:
            texts = _strings(batch.column("text"))
            for a, b in _groups([len(t) for t in texts], CHUNK):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_chars": pa.array([len(t) for t in texts[a:b]], pa.int64()),
                    "fingerprint": as_text(fingerprints(texts[a:b])),
                })

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def edit_distance(a: str, b: str, most: int) -> int | None:
    """Insertions, deletions and replacements between the texts; None if there are more than ``most``.

    For each number of edits it keeps how far every diagonal reaches, so that equal stretches are
    passed at once.
    """
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    n, m = len(x), len(y)
    if abs(n - m) > most:
        return None
    goal = m - n
    x, y = np.append(x, 0xFFFFFFFF).astype(np.int64), np.append(y, 0xFFFFFFFE).astype(np.int64)

    def slide(reach: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
        reach = reach.copy()
        moving = np.arange(len(reach))
        while len(moving):
            i = reach[moving]
            ok = (i < n) & (i + diagonals[moving] < m) & (i + diagonals[moving] >= 0)
            moving = moving[ok]
            same = x[reach[moving]] == y[reach[moving] + diagonals[moving]]
            moving = moving[same]
            reach[moving] += 1
        return reach

    reach = slide(np.array([0]), np.array([0]))
    for edits in range(most + 1):
        if edits:
            low = np.full(len(reach) + 4, -1, np.int64)
            low[2:-2] = reach
            # To a diagonal from itself (replace), the one below (insert) and the one above (delete).
            reach = np.maximum(np.maximum(low[1:-1] + 1, low[:-2]), low[2:] + 1)
            reach = np.where((low[1:-1] < 0) & (low[:-2] < 0) & (low[2:] < 0), -1, reach)
            diagonals = np.arange(-edits, edits + 1)
            reach = np.minimum(reach, np.minimum(n, m - diagonals))
            valid = reach >= np.maximum(0, -diagonals)
            slid = slide(np.where(valid, reach, n), diagonals)
            reach = np.where(valid, slid, -1)
        if abs(goal) <= edits and reach[goal + edits] >= n:
            return edits
    return None


def _sample_batches(batches):
    for batch in batches:
        texts = _strings(batch.column("text"))
        for a, b in _groups([len(t) for t in texts], CHUNK):
            rows = [r.tobytes() for r in samples(texts[a:b])]
            ids = batch.column("doc_id").slice(a, b - a)
            yield pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.binary())], names=["doc_id", "samples"])


def _unpacked(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BANDS, BAND)


def _band_rows(batches):
    """A row per document and band; the low bits of a bucket are the number of its band."""
    numbers = np.arange(BANDS, dtype=np.uint64)
    for batch in batches:
        rows = _unpacked(batch.column("samples"))
        keys = mix(numbers)[None, :]
        for k in range(BAND):
            keys = mix(keys ^ rows[:, :, k])
        keys = (keys & ~np.uint64(BANDS - 1)) | numbers
        ids = np.repeat(np.asarray(batch.column("doc_id")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["bucket", "doc_id"])


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``bucket, doc_id, i, j, own``: every two members of a bucket meet in one block ``i, j`` with ``i <= j``."""
    count = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    count = stored(count.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("n")), "buckets")
    rows = rows.join(count, "bucket").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return rows.select("bucket", "doc_id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")


def _meetings(table: pa.Table):
    """For every member its place and the places of those after it that it meets in this block."""
    own, ids = np.asarray(table.column("own")), np.asarray(table.column("doc_id"))
    same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    for x in range(len(ids)):
        yield x, np.flatnonzero((ids > ids[x]) & (same | (own != own[x])))


def _candidates(table: pa.Table) -> pa.Table:
    """Pairs of a block that share no earlier band."""
    ids, band, pairs = np.asarray(table.column("doc_id")), table.column("bucket")[0].as_py() & (BANDS - 1), []
    rows = _unpacked(table.column("samples"))[:, :band]
    for x, others in _meetings(table):
        earlier = (rows[others] == rows[x]).all(axis=2).any(axis=1)
        pairs += [(int(ids[x]), int(ids[y])) for y in others[~earlier]]
    columns = zip(*pairs) if pairs else ([], [])
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", columns)})


def _verified(share: float):
    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                a, b = (batch.column(c)[i].as_py() or "" for c in ("text_a", "text_b"))
                distance = edit_distance(a, b, int(share * max(len(a), len(b))))
                if distance is not None:
                    yield pa.RecordBatch.from_pydict({
                        "a": pa.array([batch.column("a")[i].as_py()], pa.int64()),
                        "b": pa.array([batch.column("b")[i].as_py()], pa.int64()),
                        "edits": pa.array([distance], pa.int64()),
                    })

    return run


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, first``: for every document the least id with an equal text, which stands for it in ``near_pairs``; NULL counts as empty."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    return docs.join(docs.groupBy("sha").agg(F.min("doc_id").alias("first")), "sha").select("doc_id", "first")


def near_pairs(docs: DataFrame, share: float = 0.02) -> DataFrame:
    """``a, b, edits``: documents at most ``share`` edits a character apart.

    ``a < b``; ids must be unique and not NULL, ``share`` below 1.  Equal texts are represented by the
    least id, so copies and empty texts do not expand into pairs; ``copies`` gives whom each id stands
    for.  NULL text counts as empty, other columns are ignored, and an empty table gives no rows.
    ``edits`` is exact, and divided by the longer text's length it is at most ``share``.

    Only what shares a band is verified, and how likely that is falls with the number of edits, wherever
    they are.  Of pairs of random texts at two edits in a hundred characters, at random places or evenly
    spread, all of 60 to 600 characters shared one, and of 3,000 characters 97 in a hundred at least; of 20,000
    characters nine in ten at one edit in a hundred.  Beyond that more and more pairs are missed.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    first = docs.filter("text != ''").groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"))
    texts = stored(docs.join(first.select("doc_id"), "doc_id", "left_semi"), "texts")
    sampled = stored(texts.mapInArrow(_sample_batches, "doc_id long, samples binary"), "samples")
    blocks = _in_blocks(stored(sampled.mapInArrow(_band_rows, "bucket long, doc_id long"), "bands")).join(sampled, "doc_id")
    pairs = blocks.groupBy("bucket", "i", "j").applyInArrow(_candidates, "a long, b long")
    for side in "ab":
        sides = texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(sides.withColumn(f"n_{side}", F.char_length(f"text_{side}")), side)
    # A difference in length is that many edits at least.
    pairs = pairs.filter(F.abs(F.col("n_a") - F.col("n_b")) <= share * F.greatest("n_a", "n_b"))
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verified(share), "a long, b long, edits long")


def near_classes(docs: DataFrame, share: float = 0.02) -> DataFrame:
    """``doc_id, class_id, n_links`` for every document, by the pairs of ``near_pairs``.

    The class is the least id reached over near pairs and equal texts, and ``n_links`` counts the
    pairs of the text that stands for the document.  Empty texts are classes of their own.
    """
    pairs = stored(near_pairs(docs, share), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("first")).groupBy("first").agg(F.count(F.lit(1)).alias("n_links"))
    roots = components(pairs).select(F.col("vertex").alias("first"), "root")
    filled = docs.select("doc_id", (F.coalesce("text", F.lit("")) == "").alias("is_empty"))
    placed = copies(docs).join(filled.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    placed = placed.withColumn("first", F.when(F.col("is_empty"), F.col("doc_id")).otherwise(F.col("first")))
    placed = placed.join(ends, "first", "left").join(roots, "first", "left")
    links = F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    return placed.select("doc_id", F.coalesce("root", "first").alias("class_id"), links)
