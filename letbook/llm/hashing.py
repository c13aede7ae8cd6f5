"""Vectorised words and hashes over batches of texts, for code that runs inside tasks."""

from __future__ import annotations

import numpy as np

#: One less than this many bytes of text at most are hashed in one go, unless a single text is longer.
CHUNK_BYTES = 1 << 21
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): every bit of the input moves every bit of the result."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> dict:
    """Byte values, white space and powers of an odd base; made once per worker process."""
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return {"value": mix(np.arange(256, dtype=np.uint64) * np.uint64(7919)), "space": space, "n": 0}


_KEPT: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _KEPT.get("n", 0) < n:
        base = 0xD6E8FEB86659FD93
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("up", base), ("down", inverse)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _KEPT[name] = np.multiply.accumulate(p)
        _KEPT["n"] = n
    return _KEPT["up"], _KEPT["down"]


def encode_lower(text: str | None) -> bytes:
    """UTF-8 with A-Z lowered and every other character as it is; null is empty."""
    return text.encode().lower() if text else b""


def chunks(sizes: list[int], limit: int = CHUNK_BYTES):
    """(from, to) ranges of consecutive texts of about `limit` bytes together."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n + 1
    if begin < len(sizes):
        yield begin, len(sizes)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space of all texts: hashes, the number of the text, the last byte.

    The hash is a polynomial over the word's bytes modulo 2**64, mixed: equal for equal words.
    """
    hashes, owner, last = [], [], []
    if "value" not in _KEPT:
        _KEPT.update(_tables())
    for a, b in chunks([len(r) for r in raw]):
        buf = np.frombuffer(b"\n".join(raw[a:b]) + b"\n", np.uint8)
        up, down = _powers(max(len(buf) + 1, CHUNK_BYTES + 2))
        gap = _KEPT["space"][buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[0::2], edge[1::2]
        sums = np.empty(len(buf) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_KEPT["value"][buf] * up[: len(buf)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        limits = np.cumsum([len(r) + 1 for r in raw[a:b]])
        owner.append(a + np.searchsorted(limits, starts, side="right"))
        last.append(buf[ends - 1])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8)
    return np.concatenate(hashes), np.concatenate(owner).astype(np.int64), np.concatenate(last)


def shingle_sets(raw: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `size` words of every text, sorted within it, and their bounds per text.

    A text of fewer words, but not none, has its whole word sequence as its one shingle.
    """
    words, owner, _ = word_hashes(raw)
    count = np.bincount(owner, minlength=len(raw)).astype(np.int64)
    first = np.cumsum(count) - count
    full = np.maximum(count - size + 1, 0)
    where = np.repeat(first - (np.cumsum(full) - full), full) + np.arange(full.sum())
    value = np.full(len(where), size, np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(0x2545F4914F6CDD1D) + words[where + k])
    doc = np.repeat(np.arange(len(raw)), full)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for n, i in enumerate(short):
            v = np.full(1, count[i], np.uint64)
            for w in words[first[i] : first[i] + count[i]]:
                v = mix(v * np.uint64(0x2545F4914F6CDD1D) + w)
            extra[n] = v[0]
        value, doc = np.concatenate([value, extra]), np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    if len(value):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
        value, doc = value[new], doc[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(raw)))]).astype(np.int64)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)
