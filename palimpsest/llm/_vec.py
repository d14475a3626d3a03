"""Vectorised text primitives on numpy: word spans, rolling hashes, winnowing.

All functions take one buffer that holds several texts, each followed by one separator, so that a few numpy
calls serve many rows.  Texts are never cut: a chunk ends at a row boundary, and one very long text simply
makes one larger chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_PINV = _U(pow(int(_P), -1, 1 << 64))
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_pow = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

WHITE = np.ones(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse."""
    if len(_pow["up"]) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        for k, b in (("up", _P), ("down", _PINV)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            np.multiply.accumulate(a, out=a)
            _pow[k] = a
    return _pow["up"][:n], _pow["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all bits depend on all bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = sum of values[t] * P**t over i <= t < j."""
    up, _ = powers(len(values))
    c = np.empty(len(values) + 1, np.uint64)
    c[0] = 0
    np.cumsum(values * up, out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], whatever its place."""
    _, down = powers(len(c))
    return mix((c[end] - c[start]) * down[start])


def gram_hash(c: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values."""
    n = len(c) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, down = powers(len(c))
    return mix((c[k:] - c[:n]) * down[:n])


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTE[buf]


class Words:
    """Words of the texts in one chunk: hashes, byte spans in the buffer, and the first word of each text."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray, lower: bool = False):
        joined = b" ".join(texts) + b" "
        self.data = joined.translate(LOWER) if lower else joined
        buf = np.frombuffer(self.data, np.uint8)
        w = np.zeros(len(buf) + 1, np.int8)
        w[1:] = is_word[buf]
        edge = np.diff(w)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(self.end) < len(self.start):
            self.end = np.append(self.end, len(buf))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)
        self.hash = span_hash(prefix_hash(byte_values(buf)), self.start, self.end)
        self.prefix = prefix_hash(self.hash)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each k words from each word on, and which of them lie in one text."""
        h = np.zeros(len(self.hash), np.uint64)
        g = gram_hash(self.prefix, k)
        h[: len(g)] = g
        return h, self.inside(k)

    def inside(self, k: int) -> np.ndarray:
        left = np.repeat(self.first[1:], self.count) - np.arange(len(self.hash))
        return left >= k


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values; fewer than w values give none."""
    if len(a) < w:
        return a[:0]
    m, have = a, 1
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < w:
        m = np.minimum(m[: len(m) - (w - have)], m[w - have :])
    return m


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w consecutive hashes the place of its smallest one, the rightmost of equals.

    The choice looks at content only (the upper 40 bits, then the place in the window), so equal windows
    choose equal places.
    """
    n = len(h)
    bits = _U(max(24, int(n).bit_length()))
    low = (_U(1) << bits) - _U(1)
    key = (h & ~low) | (low - np.arange(n, dtype=np.uint64))
    return (low - (sliding_min(key, w) & low)).astype(np.int64)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of an Arrow string column as bytes, some rows at a time, with the first row's number; null: b""."""
    values = column.cast(pa.large_binary())
    ends = np.cumsum(np.nan_to_num(pa.compute.binary_length(values).to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < len(values):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield at, [x or b"" for x in values[at:to].to_pylist()]
        at = to


def union_length(start: np.ndarray, end: np.ndarray) -> int:
    """Length of the union of the intervals, given in order of start."""
    if not len(start):
        return 0
    top = np.concatenate([[start[0]], np.maximum.accumulate(end)[:-1]])
    return int(np.maximum(0, end - np.maximum(start, top)).sum())


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of the union of the intervals; touching ones join."""
    if not len(start):
        return start, end
    o = np.argsort(start, kind="stable")
    start, top = start[o], np.maximum.accumulate(end[o])
    new = np.concatenate([[True], start[1:] > top[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return start[new], top[last]
