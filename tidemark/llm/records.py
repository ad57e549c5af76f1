"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record is framed as::

    uint64  length of the data
    uint32  masked CRC-32C of the 8 length bytes
    data    int64 doc_id, uint8 whether there is one, uint8 bytes per id (2 or 4), ids
    uint32  masked CRC-32C of the data

all little-endian.  Files hold records in ascending ``doc_id`` order and are named after the range
of ids they hold and a random part.  The index, a Parquet table of its own, has file, offset and
length of each record; it names only files of tasks that succeeded, so a lost executor leaves at
most an unused file.  Files are opened by URI in the shared folder, so any executor reaches them.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import new_folder, stored
from .tokens import Encoder
from .warc import file_system

#: The polynomial of CRC-32C, bits reversed, and what masks a checksum of checksums.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
ROW = 256  # bytes that one look-up row of the checksum takes
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
HEAD = "<qBB"


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """``t[p][b]``: checksum state of byte ``b`` and ``p`` zero bytes; the state -1 after 0 to 256 zero bytes."""
    t = np.zeros((ROW + 1, 256), np.uint32)
    code = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        code = np.where(code & 1, code >> 1 ^ np.uint32(POLYNOMIAL), code >> 1)
    t[0] = code
    ones = np.zeros(ROW + 1, np.uint32)
    ones[0] = 0xFFFFFFFF
    for p in range(ROW):
        t[p + 1] = t[p] >> 8 ^ t[0][t[p] & 255]
        ones[p + 1] = ones[p] >> 8 ^ t[0][ones[p] & 255]
    return t, ones


def _advance(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (
        table[0][state & 255] ^ table[1][state >> 8 & 255] ^ table[2][state >> 16 & 255] ^ table[3][state >> 24]
    )


_STEPS: list[np.ndarray] = []


def _step(power: int) -> np.ndarray:
    """Tables by state byte that advance a state over ``2**power`` rows of zero bytes."""
    while len(_STEPS) <= power:
        if not _STEPS:
            t, _ = _tables()
            state = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]
            for _ in range(ROW):
                state = state >> 8 ^ t[0][state & 255]
            _STEPS.append(state)
        else:
            _STEPS.append(_advance(_STEPS[-1], _STEPS[-1]))
    return _STEPS[power]


def _advance_rows(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Every state over its own number of rows of zero bytes."""
    state, power, rows = state.copy(), 0, rows.copy()
    while rows.any():
        odd = (rows & 1).astype(bool)
        state[odd] = _advance(_step(power), state[odd])
        rows >>= 1
        power += 1
    return state


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of every byte string.

    The checksum is linear: each row of 256 bytes gets its own state by look-ups, the states are
    advanced to the end of their string, and everything is added without carry.
    """
    if not parts:
        return np.empty(0, np.uint32)
    t, ones = _tables()
    sizes = np.array([len(p) for p in parts], np.int64)
    rows = -(-sizes // ROW)
    # Zero bytes in front change nothing.
    padded = b"".join(x for p, n in zip(parts, rows * ROW - sizes) for x in (bytes(n), p))
    state = np.zeros(int(rows.sum()), np.uint32)
    if len(padded):
        grid = np.frombuffer(padded, np.uint8).reshape(-1, ROW)
        flat, place = t.ravel(), np.arange(ROW - 1, -1, -1, dtype=np.int64) * 256
        for a in range(0, len(grid), 4096):
            state[a : a + 4096] = np.bitwise_xor.reduce(flat[grid[a : a + 4096] + place], axis=1)
    first = np.concatenate(([0], np.cumsum(rows)))
    left = np.repeat(first[1:], rows) - 1 - np.arange(len(state))
    state = _advance_rows(state, left)
    total = np.zeros(len(parts), np.uint32)
    some = rows > 0
    if some.any():
        total[some] = np.bitwise_xor.reduceat(state, first[:-1][some])
    start = _advance_rows(ones[sizes % ROW], sizes // ROW)
    return total ^ start ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(MASK)


def frames(data: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(d)) for d in data]
    a, b = masked(crc32c(lengths)).astype("<u4"), masked(crc32c(data)).astype("<u4")
    return [n + x.tobytes() + d + y.tobytes() for n, x, d, y in zip(lengths, a, data, b)]


class Corrupt(Exception):
    pass


def parse(frame: list[bytes]) -> list[tuple[int | None, np.ndarray]]:
    """``doc_id`` and ids of each framed record, after all checksums have been checked."""
    data = []
    for f in frame:
        if len(f) < 16 or struct.unpack_from("<Q", f)[0] != len(f) - 16:
            raise Corrupt("the frame's length differs from its header")
        data.append(f[12:-4])
    a, b = masked(crc32c([f[:8] for f in frame])), masked(crc32c(data))
    out = []
    for i, (f, d) in enumerate(zip(frame, data)):
        if struct.unpack_from("<I", f, 8)[0] != a[i] or struct.unpack_from("<I", f, len(f) - 4)[0] != b[i]:
            raise Corrupt("a checksum differs")
        doc_id, known, width = struct.unpack_from(HEAD, d)
        out.append((doc_id if known else None, np.frombuffer(d, f"<u{width}", offset=struct.calcsize(HEAD))))
    return out


_INDEX = "part int, seq int, row long, file string, doc_id long, offset long, length long, n_tokens long"
_INDEX_SCHEMA = pa.schema([
    (c.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]])
    for c in _INDEX.split(", ")
])


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        encoder, part = Encoder.at(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        out, name, seq, row, offset = None, "", -1, 0, 0
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            doc_ids = batch.column("doc_id").to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= READ_BYTES):
                    size += len(texts[to])
                    to += 1
                ids, counts = encoder.encode(texts[at:to])
                bounds = np.concatenate(([0], np.cumsum(counts)))
                packed = ids.astype(f"<u{width}")
                data = [
                    struct.pack(HEAD, 0 if d is None else d, d is not None, width) + packed[a:b].tobytes() + end
                    for d, a, b in zip(doc_ids[at:to], bounds[:-1], bounds[1:])
                ]
                lines = []
                for doc_id, n, frame in zip(doc_ids[at:to], counts.tolist(), frames(data)):
                    if out is None:
                        seq, row, offset = seq + 1, 0, 0
                        name = f"tokens-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.rec"
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(frame)
                    lines.append((part, seq, row, name, doc_id, offset, len(frame), n + 1))
                    row, offset = row + 1, offset + len(frame)
                    if offset >= FILE_BYTES:
                        out.close()
                        out = None
                at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*lines), _INDEX_SCHEMA)], schema=_INDEX_SCHEMA
                )
        if out is not None:
            out.close()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of every text, then ``end_id``, in ascending ``doc_id`` order; the offset index.

    NULL ids come first, rows with equal ids by the hash of their text; NULL text is empty.  The
    index has ``part, seq, row`` (place in the order), ``file, offset, length, doc_id, n_tokens``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # By the text as well, so that rows of one id, or of none, need not meet in one task.
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(_writer(folder, tokenizer, end_id), _INDEX), "index")


def _records(stream):
    """Frames of one file, a block of bytes at a time."""
    rest = b""
    while True:
        block = stream.read(READ_BYTES)
        if not block:
            break
        rest += block
        at, found = 0, []
        while len(rest) - at >= 12:
            size = struct.unpack_from("<Q", rest, at)[0] + 16
            if len(rest) - at < size:
                # A wrong length must not make the reader swallow the file.
                length = rest[at : at + 8]
                if masked(crc32c([length]))[0] != struct.unpack_from("<I", rest, at + 8)[0]:
                    raise Corrupt("a length's checksum differs")
                break
            found.append(rest[at : at + size])
            at += size
        rest = rest[at:]
        if found:
            yield found
    if rest:
        raise Corrupt("the file ends within a record")


_READ = "part int, seq int, row long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"


def _reader(folder: str):
    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for part, seq, name in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "file"))):
                row = start = 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for some in _records(stream):
                        lines = []
                        for doc_id, ids in parse(some):
                            crc = zlib.crc32(ids.astype("<u4").tobytes())
                            lines.append((part, seq, row, doc_id, start, len(ids), crc))
                            row, start = row + 1, start + len(ids)
                        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*lines), kinds)],
                            names=[c.split()[0] for c in _READ.split(", ")],
                        )

    return run


def read(index: DataFrame, folder: str) -> DataFrame:
    """Read the files in full: ``doc_id, start, n_tokens, ids_crc32`` per record.

    ``start`` counts the ids of all records before, over all files in order.  A damaged file fails.
    """
    files = stored(index.select("part", "seq", "file").distinct(), "files")
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(files.repartition(n).mapInArrow(_reader(folder), _READ), "records")
    # One row a file from here to the broadcast.
    total = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    total = stored(total.select("part", "seq", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "files")
    if total.count() <= 100_000:
        total = F.broadcast(total)
    return rows.join(total, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32"
    )


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """``doc_id, ids`` of the records at any rows of the index, in whatever order they come."""

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            files: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                files.setdefault(name, []).append((offset, length))
            for name, places in files.items():
                with system.open_input_file(f"{path}/{name}") as source:
                    for offset, length in places:
                        for doc_id, ids in parse([source.read_at(length, offset)]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                                names=["doc_id", "ids"],
                            )

    return wanted.select("file", "offset", "length").mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all texts, read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, end_id), folder)
