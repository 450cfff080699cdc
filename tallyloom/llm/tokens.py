"""Vectorised word hashing over Arrow text columns (numpy, no Python strings).

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. Every word gets
a 64-bit hash: up to ``TABLED`` bytes the sum of a random number for each byte and
its place (tabulation hashing), beyond that BLAKE2. n-grams are random linear
combinations of word hashes; spans of any length a polynomial modulo the prime
2^61 - 1, whose values, unlike those modulo 2^64, no pattern of words makes
collide. Inside a task work goes in slices of a few megabytes of text, so memory
does not depend on the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240611)
TABLED = 64
_TABLE = _rng.integers(0, 2**64, TABLED * 256, dtype=U64)
_COEF = _rng.integers(1, 2**63, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_PRIME = 2**61 - 1
_POINT = int(_rng.integers(2**60, 2**61 - 1))
_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_pow: dict = {"n": 0}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words (splitmix64's)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """x below 2^64 modulo the prime."""
    p = U64(_PRIME)
    x = (x & p) + (x >> U64(61))
    return np.where(x >= p, x - p, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for a and b below it."""
    low = U64(2**31 - 1)
    ah, al, bh, bl = a >> U64(31), a & low, b >> U64(31), b & low
    mid = ah * bl + al * bh
    return _reduced(_reduced(U64(2) * ah * bh + (mid >> U64(30)) + ((mid & U64(2**30 - 1)) << U64(31))) + _reduced(al * bl))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the point and of its inverse, at least n of each."""
    if _pow["n"] < n:
        m = max(n, SLICE_BYTES // 2 + 1)
        for name, base in (("p", _POINT), ("i", pow(_POINT, -1, _PRIME))):
            a, step = np.ones(1, U64), base
            while len(a) < m:
                a = np.concatenate([a, _times(a, np.full(len(a), step, U64))])
                step = step * step % _PRIME
            _pow[name] = a
        _pow["n"] = len(_pow["p"])
    return _pow["p"], _pow["i"]


def text_slices(col, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) over a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j - i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


class Words:
    """The words of one slice: hashes, byte spans and word offsets per row."""

    __slots__ = ("data", "ends", "hash", "offs", "starts")

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool):
        n = len(data)
        self.data = data
        if not n:
            self.starts = self.ends = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U64)
            self.offs = np.zeros(len(offs), np.int64)
            return
        ws = _WS[data]
        before = np.empty(n, bool)
        before[0] = True
        before[1:] = ws[:-1]
        before[offs[:-1][offs[:-1] < n]] = True
        after = np.empty(n, bool)
        after[-1] = True
        after[:-1] = ws[1:]
        last = offs[1:] - 1
        after[last[last >= 0]] = True
        word = ~ws
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        self.offs = np.searchsorted(self.starts, offs)
        size = self.ends - self.starts
        own = _LOW[data] if lower else data
        place = np.zeros(n, np.int32)
        place[self.starts] = self.starts
        place = np.arange(n, dtype=np.int32) - np.maximum.accumulate(place)
        sums = np.zeros(n + 1, U64)
        np.cumsum(_TABLE[(np.minimum(place, TABLED - 1) << 8) | own], out=sums[1:])
        h = sums[self.ends] - sums[self.starts]
        for k in np.flatnonzero(size > TABLED):
            whole = own[self.starts[k]:self.ends[k]].tobytes()
            h[k] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
        self.hash = mix(h + size.astype(U64) * _BASE)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive entries (len(h) - n + 1 of them, or none)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = h[:m] * _COEF[0]
    for k in range(1, n):
        out = out + h[k:k + m] * _COEF[k]
    return mix(out + U64(n))


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Order-dependent hash of h[start:end] for many spans."""
    p, inv = _powers(len(h) + 1)
    terms = _times(_reduced(mix(h ^ _COEF[5])), p[:len(h)])
    halves = []
    for part in (terms & U64(2**31 - 1), terms >> U64(31)):  # sums of halves do not overflow
        sums = np.zeros(len(h) + 1, U64)
        np.cumsum(part, out=sums[1:])
        halves.append(_reduced(sums[end] - sums[start]))
    low, high = halves
    value = _times(_reduced(low + _times(high, np.full(len(high), 2**31, U64))), inv[start])
    return mix(value + (end - start).astype(U64) * _COEF[6])


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64, copy=False))


class Shingles:
    """Distinct n-word shingles of each row of a slice, sorted by (row, hash).

    A row with 1 to n-1 words has its whole sequence as its only shingle.
    """

    __slots__ = ("hash", "offs", "row")

    def __init__(self, w: Words, n: int):
        rows = len(w.offs) - 1
        count = np.diff(w.offs)
        g = grams(w.hash, n)
        row = w.row_of_word()
        ok = np.arange(len(g)) + n <= w.offs[1:][row[:len(g)]]
        g, r = g[ok], row[:len(ok)][ok]
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            s = span_hash(w.hash, w.offs[short], w.offs[short] + count[short])
            g, r = np.concatenate([g, s]), np.concatenate([r, short])
        order = np.lexsort((g, r))
        g, r = g[order], r[order]
        keep = np.ones(len(g), bool)
        keep[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
        self.hash, self.row = g[keep], r[keep]
        self.offs = np.searchsorted(self.row, np.arange(rows + 1))

    def fingerprint(self) -> np.ndarray:
        """64-bit hash of each row's set (0 for empty sets)."""
        sums = np.zeros(len(self.hash) + 1, U64)
        np.cumsum(mix(self.hash ^ _COEF[7]), out=sums[1:])
        n = np.diff(self.offs)
        fp = mix(sums[self.offs[1:]] - sums[self.offs[:-1]] + n.astype(U64) * _COEF[8])
        return np.where(n > 0, fp, U64(0))
