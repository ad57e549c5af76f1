"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), text)


def words(text: str | None, low: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return WORD.findall(lower(raw) if low else raw)


def shingles(text: str | None, width: int = 2) -> set:
    w = words(text, True)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def near(docs: list[tuple[int, str | None]], hundredths: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (shingles, least id reached), from all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets, key=lambda d: len(sets[d]))
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 100 * len(sets[a]) < hundredths * len(sets[b]):
                break
            if not sets[a]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= hundredths * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeats(docs: list[tuple[int, str | None]], width: int = 50) -> dict[int, tuple[int, int, str]]:
    split = {d: words(t) for d, t in docs}
    least: dict[tuple, int] = {}
    for d, w in split.items():
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(d, least.get(key, d))
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def bench_words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return BENCH_WORD.findall(low)


def contamination(docs, items, size: int = 10) -> dict[int, tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = bench_words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = {}
    for d, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                who = windows.get(tuple(w[i : i + n]))
                if who:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in who if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


def warc(pages, limit: int = 1000) -> dict[int, tuple]:
    last: dict[bytes, int] = {}
    for page, html in pages:
        raw = (html or "").encode()
        last[raw] = max(page, last.get(raw, page))
    out = {}
    for page, html in pages:
        raw = (html or "").encode()
        other = last[raw] if len(raw) >= limit and last[raw] != page else None
        out[page] = (len(raw), hashlib.sha1(raw).hexdigest(), "response" if other is None else "revisit", other)
    return out


def least_capacity(sizes: list[int], shards: int) -> int:
    """By dynamic programming over all contiguous partitions."""
    best = [0] + [10**18] * len(sizes)
    for _ in range(shards):
        new = list(best)
        for end in range(1, len(sizes) + 1):
            load = 0
            for start in range(end - 1, -1, -1):
                load += sizes[start]
                new[end] = min(new[end], max(best[start], load))
                if load >= new[end]:
                    break
        best = new
    return best[-1]


def crc(values: bytes) -> int:
    return zlib.crc32(values)
