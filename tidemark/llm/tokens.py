"""Token ids of texts by the tokenizers library, with each piece of text encoded once per worker.

A byte-level tokenizer first splits a text by a pattern (a space goes with the word after it) and
then encodes each part by itself.  So a text may be cut wherever that pattern splits in any case,
and equal pieces have equal ids.  Cuts are made only where the pattern certainly splits:

* before ASCII white space that follows something else,
* between an ASCII letter and ASCII punctuation, in either order, but not next to an apostrophe,
  which may start a contraction,
* after a single line feed before an ASCII letter.

A text with white space beyond ASCII, or with a special token's string, is not cut at all.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .words import CHUNK_BYTES, mix, run_hashes

# Pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 400_000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = True
_MARK[0x27] = False
_WIDE_WHITE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [s.encode() for s in added if s]
        # Bytes of each token: those of a byte-level vocabulary have one character a byte.
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self._forget()

    def _forget(self) -> None:
        """Known pieces: sorted hashes, and where the ids of each lie in one long row."""
        self.hashes = np.empty(0, np.uint64)
        self.begin = self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    @staticmethod
    def at(path: str) -> Encoder:
        """The worker's one encoder of this file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def _whole(self, texts: list[bytes]) -> list[int]:
        """Texts that must not be cut."""
        joined = b"\n".join(texts)
        if not _WIDE_WHITE.search(joined) and not any(s in joined for s in self.special):
            return []
        return [i for i, t in enumerate(texts) if _WIDE_WHITE.search(t) or any(s in t for s in self.special)]

    def _pieces(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, list[int]]:
        """All texts in a row, where pieces start, where texts start, and texts that are one piece."""
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        cut = np.zeros(len(raw) + 1, bool)
        white, letter, mark = _WHITE[raw], _LETTER[raw], _MARK[raw]
        cut[1:-1] = white[1:] & ~white[:-1]
        cut[1:-1] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        cut[2:-1] |= (raw[1:-1] == 0x0A) & ~white[:-2] & letter[2:]
        uncut = self._whole(texts)
        for i in uncut:
            cut[bounds[i] + 1 : bounds[i + 1]] = False
        cut[bounds] = True
        return data, np.flatnonzero(cut[:-1]), bounds, uncut

    def _encode_each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row, and how many each piece has."""
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        ids = []
        for at in range(0, len(pieces), 2000):
            ids += [e.ids for e in encode([p.decode() for p in pieces[at : at + 2000]], add_special_tokens=False)]
        sizes = np.array([len(i) for i in ids], np.int64)
        return np.array([i for some in ids for i in some], np.uint32), sizes

    def _encode_joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encode_each``, for pieces that begin with white space and end with something else.

        The pattern splits between any two of them, so they are encoded as one text, and the lengths
        of the tokens tell where each ends.  If they do not, each is encoded by itself.
        """
        joined = b"".join(pieces)
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        ids = np.array(encode([joined.decode()], add_special_tokens=False)[0].ids, np.uint32)
        reached = np.cumsum(self.bytes_of[ids])
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        last = np.searchsorted(reached, ends)
        if not len(reached) or reached[-1] != len(joined) or (reached[last] != ends).any():
            return self._encode_each(pieces)
        return ids, np.diff(last + 1, prepend=0)

    def _learn(self, raw: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, alone: np.ndarray) -> None:
        """Encode pieces that are not known yet; ``alone`` marks those that must not be joined with others."""
        joins = ~alone & (raw[starts] == 0x20) & ~_WHITE[raw[ends - 1]]
        order = np.concatenate((np.flatnonzero(joins), np.flatnonzero(~joins)))
        n_joined = int(joins.sum())
        pieces = [data[a:b] for a, b in zip(starts[order].tolist(), ends[order].tolist())]
        found = [self._encode_joined(pieces[at : min(at + 4000, n_joined)]) for at in range(0, n_joined, 4000)]
        if n_joined < len(pieces):
            found.append(self._encode_each(pieces[n_joined:]))
        sizes = np.concatenate([n for _, n in found])
        begin = np.cumsum(sizes) - sizes + len(self.flat)
        self.flat = np.concatenate([self.flat, *[ids for ids, _ in found]])
        new = hashes[order]
        by_hash = np.argsort(new)
        place = np.searchsorted(self.hashes, new[by_hash])
        self.hashes = np.insert(self.hashes, place, new[by_hash])
        self.begin = np.insert(self.begin, place, begin[by_hash])
        self.sizes = np.insert(self.sizes, place, sizes[by_hash])

    def _encode_chunk(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data, starts, bounds, uncut = self._pieces(texts)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        raw = np.frombuffer(data, np.uint8)
        ends = np.append(starts[1:], len(data))
        found, first, which = np.unique(run_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, found)
        new = np.ones(len(found), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != found[inside]
        if new.any():
            if len(self.hashes) + int(new.sum()) > REMEMBERED:
                self._forget()
                new[:] = True
            pick = first[new]
            alone = np.isin(np.searchsorted(bounds, starts[pick], "right") - 1, uncut)
            self._learn(raw, data, starts[pick], ends[pick], found[new], alone)
            at = np.searchsorted(self.hashes, found)
        begin, size = self.begin[at][which], self.sizes[at][which]
        after = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (after - size), size) + np.arange(after[-1])]
        total = np.concatenate(([0], after))
        per_text = np.diff(total[np.searchsorted(starts, bounds)])
        return ids, per_text

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        ids, counts, start, size = [], [], 0, 0
        for i in range(len(texts) + 1):
            if i == len(texts) or (i > start and size + len(texts[i]) > CHUNK_BYTES):
                if i > start:
                    found, n = self._encode_chunk(texts[start:i])
                    ids.append(found)
                    counts.append(n)
                start, size = i, 0
            if i < len(texts):
                size += len(texts[i])
        if not ids:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts)

