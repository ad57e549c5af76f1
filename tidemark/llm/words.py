"""Words and word hashes of many texts at once.

A word is a run of bytes other than the six ASCII white-space bytes (0x20, 0x09-0x0D), which is
what ``[^\\x20\\x09-\\x0D]+`` finds.  Texts are handled as one byte string, so that numpy does the
work of a whole Arrow batch in a few passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
# A bound on the bytes handled at once: the working arrays are 8 bytes a byte of text.
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        take = min(have, n - have)
        step = np.uint64(pow(base, have, 1 << 64))
        out[have : have + take] = out[:take] * step
        have += take
    return out


class _Tables:
    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return self.up, self.down


_TABLES = _Tables()


@dataclass
class Words:
    """Word ``i`` is ``data[starts[i]:ends[i]]``; text ``k`` has words ``offsets[k]`` to ``offsets[k + 1]``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def run_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each run; a polynomial, so that one running sum serves all runs."""
    up, down = _TABLES.get(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def words_of(texts: list[bytes], lower: bool, hashes: bool = True) -> Words:
    """The words of each text and their 64-bit hashes; equal words have equal hashes everywhere."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = _LOWER[raw]
    white = _WHITE[raw]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    offsets = np.concatenate(([0], np.searchsorted(starts, text_ends, "left")))
    hashed = np.empty(0, np.uint64)
    if hashes:
        hashed = run_hashes(raw, starts, ends)
    return Words(raw.tobytes() if lower else data, starts, ends, offsets, hashed)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES):
    """Slices ``(from, to)`` of the list with about ``limit`` bytes each, or one text if it is longer."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes, by its first position."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _TABLES.get(len(hashes) + 1)
    sums = np.empty(len(hashes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def as_long(hashes: np.ndarray) -> np.ndarray:
    """The same bits as signed longs, as Spark holds them."""
    return hashes.view(np.int64)
