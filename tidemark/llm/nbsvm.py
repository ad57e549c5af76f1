"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

Features are indicators of n-grams: of 2 to 4 bytes of the text, and of runs of equal neighbours in
the sequence of its words.  Each indicator is scaled by the log ratio of how often documents of the
two classes hold it, counted over all labelled training documents.  A linear hinge-loss model of the
scaled, length-normalised vectors is fitted by dual coordinate descent on a bounded sample, and a
logistic curve over margins of held-out folds turns margins into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .words import chunks, mix, words_of

BITS = 18
DIM = 1 << BITS
# Documents of each class that the linear model is fitted on, the first by the hash of their id.
SAMPLE = 3000
# Tasks that bring the sample to the driver, one after the other.
SLICES = 32
FOLDS = 3
SMOOTH = 1.0
COST = 1.0
PASSES = 12


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct feature numbers of each text, ascending; feature 0 is in every text."""
    out, held = [], np.zeros(DIM, bool)
    for a, b in chunks(texts):
        words = words_of(texts[a:b], lower=True)
        for i in range(a, b):
            raw = np.frombuffer(texts[i], np.uint8).astype(np.uint64)
            parts = [np.zeros(1, np.int64)]
            code = raw
            for n in (2, 3, 4):
                code = code[:-1] | raw[n - 1 :] << np.uint64(8 * (n - 1))
                parts.append((mix(code + np.uint64(n << 40)) >> np.uint64(64 - BITS)).astype(np.int64))
            h = words.hashes[words.offsets[i - a] : words.offsets[i - a + 1]]
            equal = np.concatenate(([False], h[1:] == h[:-1], [False])) if len(h) > 1 else np.zeros(2, bool)
            edge = np.flatnonzero(equal[1:] != equal[:-1])
            longest = int((edge[1::2] - edge[0::2]).max()) if len(edge) else 0
            runs = [k for k in (1, 2, 4, 8) if k <= longest]
            parts.append((mix(np.array(runs, np.uint64) + np.uint64(9 << 40)) >> np.uint64(64 - BITS)).astype(np.int64))
            index = np.concatenate(parts)
            held[index] = True
            found = np.flatnonzero(held)
            held[found] = False
            out.append(found)
    return out


class Rows:
    """Feature numbers of many texts, each as 32-bit integers or, where that is shorter, as one bit per feature."""

    def __init__(self, packed: list[bytes]) -> None:
        self.packed = packed

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, i: int) -> np.ndarray:
        raw = self.packed[i]
        if len(raw) == DIM // 8:
            return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8)))
        return np.frombuffer(raw, "<i4")  # the bytes as they came, not copied

    def __iter__(self):
        return (self[i] for i in range(len(self)))

    def pick(self, places: np.ndarray) -> Rows:
        return Rows([self.packed[i] for i in places])


def packed(found: np.ndarray) -> bytes:
    """``DIM / 8`` bytes at most."""
    if 4 * len(found) < DIM // 8:
        return found.astype("<i4").tobytes()
    bits = np.zeros(DIM, np.uint8)
    bits[found] = 1
    return np.packbits(bits).tobytes()


def log_ratios(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Log ratio of each feature's share in the two classes, from its document counts."""
    p, q = ones + SMOOTH, zeros + SMOOTH
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[0] = 1.0  # the constant
    return ratio


def scales(rows: Rows | list[np.ndarray], ratios: np.ndarray) -> np.ndarray:
    """What brings each row's ratios to length 1."""
    return np.array([1 / np.sqrt((ratios[r] ** 2).sum()) for r in rows])


def fit_hinge(
    rows: Rows | list[np.ndarray],
    ratios: np.ndarray,
    scale: np.ndarray,
    signs: np.ndarray,
    costs: np.ndarray,
    passes: int = PASSES,
) -> np.ndarray:
    """Weights of least hinge loss by dual coordinate descent; row ``i`` is ``ratios[rows[i]] * scale[i]``."""
    weights, alpha = np.zeros(DIM), np.zeros(len(rows))
    draw = np.random.default_rng(7)
    for _ in range(passes):
        for i in draw.permutation(len(rows)):
            row = rows[i]
            value = ratios[row] * scale[i]
            gradient = signs[i] * (weights[row] @ value) - 1
            new = min(max(alpha[i] - gradient, 0.0), costs[i])
            if new != alpha[i]:
                weights[row] += (new - alpha[i]) * signs[i] * value
                alpha[i] = new
    return weights


def fit_logistic(margins: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve that gives each margin its probability, by Newton's method."""
    slope, offset = 1.0, 0.0
    x = np.stack((margins, np.ones_like(margins)), 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        g = x.T @ (weights * (targets - p)) - 1e-2 * np.array([slope, 0])
        h = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.linalg.solve(h, g)
        slope, offset = slope + np.clip(move[0], -5, 5), offset + np.clip(move[1], -5, 5)
    return float(max(slope, 0.0)), float(offset)


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of class 1 of each text."""
        scaled = self.ratios * self.weights
        out = np.empty(len(texts))
        for i, found in enumerate(features(texts)):
            out[i] = scaled[found].sum() / np.sqrt((self.ratios[found] ** 2).sum())
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.offset, -500, 500)))


def fit(rows: Rows, labels: np.ndarray, ratios: np.ndarray, shares: tuple[float, float]) -> Model:
    """The model of sampled documents; ``shares``: documents of class 0 and 1 that each of the sample stands for."""
    zero = Model(ratios, np.zeros(DIM), 0.0, 0.0)
    if not len(rows) or labels.min() == labels.max():  # one class or none: its share is all there is to know
        zero.offset = 0.0 if not len(rows) else 30.0 * (1 if labels[0] else -1)
        return zero
    scale = scales(rows, ratios)
    signs = np.where(labels == 1, 1.0, -1.0)
    costs = COST * len(rows) / 2 / np.where(labels == 1, (labels == 1).sum(), (labels == 0).sum())
    margins, fold = np.zeros(len(rows)), np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        use = np.flatnonzero(fold != k)
        if labels[use].min() == labels[use].max():
            continue
        w = fit_hinge(rows.pick(use), ratios, scale[use], signs[use], costs[use]) * ratios
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]].sum() * scale[i]
    stands_for = np.where(labels == 1, shares[1], shares[0])
    slope, offset = fit_logistic(margins, (labels == 1).astype(float), stands_for / stands_for.mean())
    return Model(ratios, fit_hinge(rows, ratios, scale, signs, costs), slope, offset)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _count_batches(batches):
    """Documents of each class that hold a feature, summed over the partition."""
    counts = np.zeros((2, DIM), np.int64)
    for batch in batches:
        for label, found in zip(batch.column("label").to_pylist(), features(_texts(batch))):
            counts[label][found] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["feature", "zeros", "ones"]
    )


def _feature_batches(batches):
    for batch in batches:
        found = [packed(f) for f in features(_texts(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())],
            names=["doc_id", "label", "features"],
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (``doc_id, text``) with a ``label`` of 0 or 1 in ``labels`` (``doc_id, label``).

    Ids labelled both ways, NULL labels and NULL ids are left out.  The counts behind the log ratios
    are of all labelled documents; the linear model sees ``sample`` of each class at most.
    """
    clean = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id")
    clean = clean.agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
    clean = stored(clean.select("doc_id", F.col("label").cast("int").alias("label")), "labels")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # By shuffle at any size: labels grow with the corpus.
    counted = docs.join(clean.hint("merge"), "doc_id").select("label", "text")
    counted = counted.mapInArrow(_count_batches, "feature long, zeros long, ones long")
    counted = counted.groupBy("feature").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas()
    zeros, ones = np.zeros(DIM), np.zeros(DIM)  # at most DIM rows come back
    zeros[counted["feature"]], ones[counted["feature"]] = counted["zeros"], counted["ones"]
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit"))
    first = [clean.filter(F.col("label") == k).orderBy(turn, "doc_id").limit(sample) for k in (0, 1)]
    few = F.broadcast(first[0].unionByName(first[1]))  # 2 * sample ids at most
    rows = stored(docs.join(few, "doc_id").select("doc_id", "label", "text"), "sample")
    rows = rows.repartition(SLICES).mapInArrow(_feature_batches, "doc_id long, label int, features binary")
    # One slice at a time passes through the driver's session, and only its bytes stay.
    ids, target, found = [], [], []
    for r in rows.toLocalIterator():
        ids.append(r["doc_id"])
        target.append(r["label"])
        found.append(bytes(r["features"]))
    turn = mix(np.array(ids, np.int64).view(np.uint64))  # a fixed, mixed order
    order = sorted(range(len(ids)), key=lambda i: (turn[i], found[i]))
    target, found = np.array(target, np.int64)[order], Rows([found[i] for i in order])
    shares = tuple(max(1.0, n) / max(1, int((target == k).sum())) for k, n in ((0, zeros[0]), (1, ones[0])))
    return fit(found, target, log_ratios(ones, zeros), shares)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every text, NULL as empty; the model goes to each worker once."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the corpus is

    def run(batches):
        for batch in batches:
            scores = sent.value.scores(_texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column | str) -> Column:
    """The fold that nothing is learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def trained_on(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the ``quality`` labels outside the held-out fold."""
    known = labels.select("doc_id", F.col("quality").alias("label")).filter(~held_out("doc_id"))
    return train(docs, known, sample)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``.

    ``score`` is the probability of quality label 1, from the text alone; ``predicted`` is 1 from
    ``threshold`` on.  Without labels every score is 0.5.  NULL text scores as empty.
    """
    scored = score(docs, trained_on(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(trained_on(docs, labels))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(_texts(batch)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
