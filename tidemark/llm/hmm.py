"""Hidden Markov language model over the words of documents.

The most frequent words, 131,072 of them, are classes of their own; all others share classes by their
last three bytes.  A document is a path through hidden states; each state draws a class, and a shared class draws one of
its words by its smoothed count:

    P(text) = sum over paths of  start * transitions * P(class | state)  *  product of P(word | class)

Baum-Welch fits starts, transitions and P(class | state): every partition runs the scaled forward and
backward recursions over its documents, the expected counts are added up across partitions, and the
driver, which only ever holds these tables of fixed size, turns them into the next model.  The score
is the exact likelihood by the scaled forward recursion.

Counts of all words stay a distributed table.  Only words above a count that at most ``HEAD`` words
reach are sent to every task; the others' counts come to the documents by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .words import as_long, chunks, mix, words_of

STATES = 8
ROUNDS = 6
# Words whose counts and emissions every task holds, each a class of its own.
HEAD = 1 << 17
SHARED = 1 << 11
# Tokens whose recursions are held at once.
CHUNK_TOKENS = 1 << 20
# Expected tokens of the overall distribution that are added to every state.
PRIOR = 200.0
#: The hash that stands for a document's end.
END = np.uint64(0x5ECDF00D5ECDF00D)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _distinct(texts: list[bytes]):
    """Distinct word hashes, the shared class of each, each word's number among them, and words per text."""
    words = words_of(texts, lower=True)
    found, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw, ends, starts = np.frombuffer(words.data, np.uint8), words.ends[first], words.starts[first]
    code = np.zeros(len(found), np.uint64)
    for k in (1, 2, 3):
        code = code << np.uint64(8) | np.where(ends - k >= starts, raw[np.maximum(ends - k, 0)], 0).astype(np.uint64)
    shared = (mix(code + np.uint64(1)) % np.uint64(SHARED)).astype(np.int32)
    return found, shared, which, words.offsets


def _count_batches(batches):
    for batch in batches:
        texts = _texts(batch)
        for a, b in chunks(texts):
            found, shared, which, _ = _distinct(texts[a:b])
            n = np.bincount(which, minlength=len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(as_long(found), as_long(np.array([END])))),
                    pa.array(np.append(shared, -1).astype(np.int32)),
                    pa.array(np.append(n, b - a)),
                ],
                names=["word", "shared", "n"],
            )


@dataclass
class Vocabulary:
    """Counts of the head words, and totals.  Classes: own ones, then shared ones."""

    words: np.ndarray  # sorted hashes
    counts: np.ndarray
    classes: np.ndarray
    n_own: int
    tokens: int
    distinct: int
    shared_tokens: np.ndarray
    shared_words: np.ndarray

    @property
    def n_classes(self) -> int:
        return self.n_own + SHARED

    @property
    def share_without_own(self) -> float:
        """The share of training tokens whose word has no emissions of its own."""
        return float(self.shared_tokens.sum() / max(1, self.tokens))


def _threshold(histogram: list[tuple[int, int]], most: int) -> int:
    """The least count from which at most ``most`` words are, by the lower ends of count buckets."""
    total, least = 0, 1 << 62
    for low, n in sorted(histogram, reverse=True):
        total += n
        if total > most:
            break
        least = low
    return least


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From ``word, shared, n``; what comes to the driver has a fixed bound."""
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # Counts by their leading seven bits: some thousand buckets at most.
    shift = F.greatest(F.lit(0), F.floor(F.log2(F.col("n").cast("double"))).cast("int") - 6)
    low = F.expr("shiftleft(shiftright(n, s), s)")
    buckets = counts.select("n", shift.alias("s")).groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("words"))
    histogram = [(r["low"], r["words"]) for r in buckets.collect()]
    head_from = _threshold(histogram, HEAD)
    head = counts.filter((F.col("n") >= head_from) | (F.col("shared") < 0)).select("word", "n", "shared").toPandas()
    order = np.argsort(head["word"].to_numpy().astype(np.int64).view(np.uint64), kind="stable")
    words = head["word"].to_numpy().astype(np.int64).view(np.uint64)[order]
    n = head["n"].to_numpy().astype(np.int64)[order]
    classes = np.arange(len(words), dtype=np.int32)
    rest = counts.filter((F.col("n") < head_from) & (F.col("shared") >= 0)).groupBy("shared")
    rest = rest.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toPandas()
    shared_tokens, shared_words = np.zeros(SHARED), np.zeros(SHARED)
    shared_tokens[rest["shared"]], shared_words[rest["shared"]] = rest["n"], rest["words"]
    return Vocabulary(
        words, n, classes, len(words), int(totals[0] or 0), int(totals[1]), shared_tokens, shared_words
    )


_ENCODED = (
    "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, "
    "rare array<long>, rare_n array<int>, classes binary"
)


def _encode_batches(sent):
    def run(batches):
        v: Vocabulary = sent.value
        rid = TaskContext.get().partitionId() << 36
        log_count = np.log10(v.counts + 0.5)
        end_at = int(np.searchsorted(v.words, END))
        if end_at == len(v.words) or v.words[end_at] != END:  # nothing to learn from
            end_at = -1
        end_class = v.classes[end_at] if end_at >= 0 else v.n_own
        for batch in batches:
            texts = _texts(batch)
            for a, b in chunks(texts):
                found, shared, which, offsets = _distinct(texts[a:b])
                at = np.minimum(np.searchsorted(v.words, found), max(0, len(v.words) - 1))
                in_head = v.words[at] == found if len(v.words) else np.zeros(len(found), bool)
                own = np.where(in_head, v.classes[at], -1) if len(v.words) else np.full(len(found), -1)
                cls = np.where(own >= 0, own, v.n_own + shared).astype("<u4")
                logs = np.where(in_head, log_count[at], 0.0) if len(v.words) else np.zeros(len(found))
                columns: list[list] = [[] for _ in range(7)]
                for k in range(b - a):
                    mine = which[offsets[k] : offsets[k + 1]]
                    known = in_head[mine]
                    rare, n = np.unique(mine[~known], return_counts=True)
                    columns[0].append(rid)
                    columns[1].append(len(mine) + 1)
                    columns[2].append(int(known.sum()) + (end_at >= 0))
                    columns[3].append(float(logs[mine].sum()) + (float(log_count[end_at]) if end_at >= 0 else np.log10(0.5)))
                    columns[4].append(as_long(found[rare]))
                    columns[5].append(n.astype(np.int32))
                    columns[6].append(np.append(cls[mine], end_class).astype("<u4").tobytes())
                    rid += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("held_out").slice(a, b - a),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.float64()),
                        pa.array(columns[4], pa.list_(pa.int64())),
                        pa.array(columns[5], pa.list_(pa.int32())),
                        pa.array(columns[6], pa.binary()),
                    ],
                    names=[c.split()[0] for c in _ENCODED.split(", ")],
                )

    return run


@dataclass
class Model:
    start: np.ndarray  # STATES
    move: np.ndarray  # STATES x STATES
    emit: np.ndarray  # classes x STATES


@dataclass
class Ground:
    """Half a token for every class, as in the base score: what all states share, and the rest by counts.

    ``P(class | state) = half + seen * (the state's own distribution)``, so a class that training does not
    show, or shows elsewhere, has in every state what the base score gives a word never seen.
    """

    half: float
    seen: float
    overall: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Ground:
        whole, n = counts.sum() + 0.5 * len(counts), counts.sum()
        return Ground(0.5 / whole, n / whole, counts / n if n else np.full(len(counts), 1 / len(counts)))

    def emissions(self, own: np.ndarray) -> np.ndarray:
        """From unnormalised distributions of the states, as columns."""
        return self.half + self.seen * own / own.sum(axis=0)

    def own_share(self, emit: np.ndarray) -> np.ndarray:
        """The part of each emission that is the state's own; only that is counted for it."""
        return (emit - self.half) / emit


def first_model(ground: Ground) -> Model:
    """States that differ at random, and stay."""
    draw = np.random.default_rng(11)
    own = ground.overall[:, None] * (0.25 + 1.5 * draw.random((len(ground.overall), STATES)))
    move = np.full((STATES, STATES), 0.1 / (STATES - 1))
    np.fill_diagonal(move, 0.9)
    return Model(np.full(STATES, 1 / STATES), move, ground.emissions(own))


class _Batch:
    """Sequences laid out by time: the first tokens of all, then the second ones, the longest sequence first.

    Each step of a recursion then works on a slice, whose rows belong to the first rows of the slice before.
    """

    def __init__(self, sequences: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        sizes = np.array([len(sequences[i]) for i in self.order], np.int64)
        running = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        offset = np.concatenate(([0], np.cumsum(running)))
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = offset[np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] + owner
        self.flat, self.owner = np.empty(len(owner), np.int32), np.empty(len(owner), np.int32)
        self.flat[place] = np.concatenate([sequences[i] for i in self.order])
        self.owner[place] = owner
        self.offset, self.n = offset.tolist(), len(sizes)

    def forward(self, model: Model, before: np.ndarray | None = None):
        """Log10 likelihoods, and the scaled states and scales by token; ``before`` is the state that a text goes on from."""
        alpha, scale = np.take(model.emit, self.flat, axis=0), np.empty(len(self.flat))
        at, ones = self.offset, np.ones(STATES)
        for t in range(len(at) - 1):
            a, b = at[t], at[t + 1]
            now = alpha[a:b]
            if t:
                last = at[t - 1]
                now *= alpha[last : last + b - a] @ model.move
            else:
                now *= model.start if before is None else before @ model.move
            size = now @ ones
            scale[a:b] = size
            now /= size[:, None]
        out = np.empty(self.n)
        out[self.order] = np.bincount(self.owner, np.log10(scale), self.n)
        return out, alpha, scale

    def expected(self, model: Model, n_classes: int, before: np.ndarray | None = None, after: np.ndarray | None = None):
        """Expected starts, moves and emissions, the log10 likelihood, and what the text before has to know.

        ``after`` is that of the text that goes on after this one.
        """
        total, alpha, scale = self.forward(model, before)
        ahead = np.take(model.emit, self.flat, axis=0)
        ahead /= scale[:, None]
        moves, back = np.zeros((STATES, STATES)), np.ascontiguousarray(model.move.T)
        beta, at = np.ones((self.n, STATES)), self.offset
        for t in range(len(at) - 2, -1, -1):
            a, b = at[t], at[t + 1]
            if t + 2 < len(at):
                c = at[t + 2]
                follows = ahead[b:c]
                moves += alpha[a : a + c - b].T @ follows
                np.matmul(follows, back, out=beta[: c - b])
            elif after is not None:
                moves += alpha[a:b].T @ after
                beta = after @ back
            now = beta[: b - a]
            ahead[a:b] *= now
            alpha[a:b] *= now  # becomes the posterior
        moves *= model.move
        emits = np.stack([np.bincount(self.flat, alpha[:, k], n_classes) for k in range(STATES)], 1)
        starts = alpha[: at[1]].sum(axis=0) if before is None else np.zeros(STATES)
        return starts, moves, emits, total.sum(), ahead[:1].copy()


def _parts(sequence: np.ndarray) -> list[np.ndarray]:
    return [sequence[a : a + CHUNK_TOKENS] for a in range(0, len(sequence), CHUNK_TOKENS)]


def _long_likelihood(model: Model, sequence: np.ndarray) -> float:
    """Of a text longer than a chunk: the state is carried from part to part."""
    total, before = 0.0, None
    for part in _parts(sequence):
        one, alpha, _ = _Batch([part]).forward(model, before)
        total, before = total + one[0], alpha[-1:].copy()
    return total


def _long_expected(model: Model, sequence: np.ndarray, n_classes: int):
    """As ``_Batch.expected``, part by part from the end; only states between parts are kept."""
    parts, states = _parts(sequence), [None]
    for part in parts[:-1]:
        states.append(_Batch([part]).forward(model, states[-1])[1][-1:].copy())
    sums, after = [0.0, 0.0, 0.0, 0.0], None
    for part, before in zip(reversed(parts), reversed(states)):
        *found, after = _Batch([part]).expected(model, n_classes, before, after)
        sums = [a + b for a, b in zip(sums, found)]
    return sums


def _batches(sequences: list[np.ndarray]):
    """Batches of sequences and their places, those of like length together."""
    order, some, size = sorted(range(len(sequences)), key=lambda i: -len(sequences[i])), [], 0
    for i in order:
        if some and size + len(sequences[i]) > CHUNK_TOKENS:
            yield some, _Batch([sequences[j] for j in some])
            some, size = [], 0
        some.append(i)
        size += len(sequences[i])
    if some:
        yield some, _Batch([sequences[j] for j in some])


def _sum_names() -> list[str]:
    return [f"s{k}" for k in range(STATES)]


def _expected_batches(sent):
    """Expected counts of the partition, one row of sums over states a class; after the classes starts, moves, likelihood."""

    def run(batches):
        model, n_classes = sent.value
        starts, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        emits, total = np.zeros((n_classes, STATES)), 0.0
        for batch in batches:
            whole = [np.frombuffer(c, "<u4") for c in batch.column("classes").to_pylist()]
            for s in (s for s in whole if len(s) > CHUNK_TOKENS):
                a, m, e, x = _long_expected(model, s, n_classes)
                starts, moves, emits, total = starts + a, moves + m, emits + e, total + x
            for _, some in _batches([s for s in whole if len(s) <= CHUNK_TOKENS]):
                a, m, e, x, _ = some.expected(model, n_classes)
                starts, moves, emits, total = starts + a, moves + m, emits + e, total + x
        table = np.concatenate((emits, [starts], moves, [np.append(total, np.zeros(STATES - 1))]))
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(table[used, k]) for k in range(STATES)]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *columns], names=["class", *_sum_names()])

    return run


def fit(encoded: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over all rows of ``encoded.classes``; the model and the likelihood before each round."""
    context = encoded.sparkSession.sparkContext
    own = np.zeros(v.n_own)
    own[v.classes] = v.counts
    ground = Ground.of(np.concatenate((own, v.shared_tokens)))
    model, likelihoods = first_model(ground), []
    for _ in range(rounds if v.tokens else 0):
        sent = context.broadcast((model, v.n_classes))
        layout = ", ".join(["class int", *[f"{n} double" for n in _sum_names()]])
        rows = encoded.select("classes").mapInArrow(_expected_batches(sent), layout)
        found = rows.groupBy("class").agg(*[F.sum(n).alias(n) for n in _sum_names()]).toPandas()
        table = np.zeros((v.n_classes + 2 + STATES, STATES))
        table[found["class"]] = found[_sum_names()]
        starts, moves = table[v.n_classes] + 1.0, table[v.n_classes + 1 : -1] + 1.0
        likelihoods.append(float(table[-1, 0]))
        emits = table[: v.n_classes] * ground.own_share(model.emit) + PRIOR * ground.overall[:, None]
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), ground.emissions(emits))
        sent.destroy()
    return model, likelihoods


def _score_batches(sent):
    def run(batches):
        model, v = sent.value
        # What a shared class' word takes besides its own count.
        spread = np.concatenate((np.zeros(v.n_own), np.log10(v.shared_tokens + 0.5 * (v.shared_words + 1))))
        own_log = np.zeros(v.n_classes)
        own_log[v.classes] = np.log10(v.counts + 0.5)
        taken = spread + own_log
        for batch in batches:
            path = np.zeros(len(batch))
            whole = [np.frombuffer(c, "<u4") for c in batch.column("classes").to_pylist()]
            for k, s in enumerate(whole):
                if len(s) > CHUNK_TOKENS:
                    path[k] = _long_likelihood(model, s)
            short = [k for k, s in enumerate(whole) if len(s) <= CHUNK_TOKENS]
            for places, some in _batches([whole[k] for k in short]):
                path[[short[k] for k in places]] = some.forward(model)[0]
            owner = np.repeat(np.arange(len(whole)), [len(s) for s in whole])
            flat = np.concatenate(whole) if whole else np.empty(0, np.uint32)
            minus = np.bincount(owner, taken[flat], len(whole))
            # Words of own classes are certain, so their counts do not take part.
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("rid", "doc_id", "held_out", "n_tokens", "n_known", "known_log")], pa.array(path - minus)],
                names=["rid", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "part_score"],
            )

    return run


_SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, part_score double"


def held_out(doc_id: Column | str) -> Column:
    """The fold that nothing is learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words with A-Z lower-cased, then one end.  ``base_score`` is the sum over tokens
    of log10((c + 0.5) / (N + 0.5 (V + 1))) for the token's count c among the N tokens, V of them
    distinct, of the documents that are not held out; ``n_known`` counts tokens with c > 0.
    ``score`` is the model's log10 probability.  NULL text is empty: its one token is the end.
    NULL ids are not held out.  Without training documents every count is 0 and every state equal.
    Repeated rows count and come as often as they do; an empty table gives no rows; other columns are
    left out.  Texts are never cut: those longer than a chunk are read part by part, with the states
    carried over.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out("doc_id").alias("held_out"))
    counts = docs.filter(~F.col("held_out")).select("text").mapInArrow(_count_batches, "word long, shared int, n long")
    # Words with equal hashes are one word; its class is that of the word that comes first.
    counts = stored(counts.groupBy("word").agg(F.min("shared").alias("shared"), F.sum("n").alias("n")), "counts")
    v = vocabulary(counts)
    sent = spark.sparkContext.broadcast(v)  # HEAD words at most
    encoded = stored(docs.mapInArrow(_encode_batches(sent), _ENCODED), "encoded")
    model, _ = fit(encoded.filter(~F.col("held_out")), v, rounds)
    sent_model = spark.sparkContext.broadcast((model, v))
    scored = encoded.drop("rare", "rare_n").mapInArrow(_score_batches(sent_model), _SCORED)
    pairs = encoded.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("p"))
    pairs = pairs.select("rid", F.col("p.rare").alias("word"), F.col("p.rare_n").alias("times"))
    looked = pairs.join(counts.select("word", "n"), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = looked.groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(0.5))).alias("rare_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    logs = F.col("known_log") + F.coalesce("rare_log", F.lit(0.0))
    all_log = float(np.log10(v.tokens + 0.5 * (v.distinct + 1)))
    return scored.join(rare, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("part_score") + logs).alias("score"),
    )
