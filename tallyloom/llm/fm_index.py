"""A compressed full-text index over sequences of word hashes (numpy).

The Burrows-Wheeler transform of the concatenated sequences is kept in a wavelet
matrix of packed bit rows with rank counts. ``matching_statistics`` walks many
patterns at once from right to left: a backward-search step where the match can
grow, a step to the parent interval (over the LCP array) where it cannot.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    """A packed bit row with constant-time rank."""

    __slots__ = ("count", "words")

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.count = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.count[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.count[w] + np.bitwise_count(self.words[w] & low)


class WaveletMatrix:
    __slots__ = ("levels", "start", "zeros")

    def __init__(self, symbols: np.ndarray, sigma: int):
        depth = max(1, int(sigma - 1).bit_length())
        self.levels, self.zeros = [], []
        s = symbols
        for k in range(depth - 1, -1, -1):
            bit = (s >> k) & 1
            one = bit.astype(bool)
            self.levels.append(_Bits(bit))
            self.zeros.append(int(len(s) - one.sum()))
            s = np.concatenate([s[~one], s[one]])
        every = np.arange(sigma)
        self.start = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        depth = len(self.levels)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = level.rank(i)
            i = np.where((symbol >> (depth - 1 - k)) & 1, zeros + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, i) - self.start[symbol]


def _suffix_order(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling, and the rank arrays of each doubling.

    symbols ends every sequence with a symbol of its own, so suffixes differ
    within ``longest`` places and no comparison runs past an end.
    """
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    ranks, h = [rank], 1
    while True:
        key = rank * (n + 1)
        key[:n - h] += rank[h:] + 1
        order = np.argsort(key)  # the order of equal keys does not matter
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        h *= 2
        rank = new
        if h > longest or rank[order[-1]] == n - 1:
            return order, ranks
        ranks.append(rank)


def _nearest_smaller(a: np.ndarray, step: int) -> np.ndarray:
    """For each i, the nearest j before (step -1) or after (+1) with a[j] < a[i]; ends hold the least value."""
    n = len(a)
    to = np.clip(np.arange(n) + step, 0, n - 1)
    todo = np.arange(1, n - 1)
    while len(todo):
        todo = todo[a[to[todo]] >= a[todo]]
        to[todo] = to[to[todo]]
    return to


class FMIndex:
    """Index over sequences given as one hash array with offsets; weight: how often each sequence stands for."""

    def __init__(self, hashes: np.ndarray, offs: np.ndarray, weight: np.ndarray):
        n_seq = len(offs) - 1
        lens = np.diff(offs)
        self.alphabet, ids = np.unique(hashes, return_inverse=True)
        n = len(hashes) + n_seq
        at = np.arange(len(hashes)) + np.repeat(np.arange(n_seq), lens)
        stops = offs[1:] + np.arange(n_seq)
        symbols = np.empty(n, np.int64)
        symbols[at] = ids + n_seq
        symbols[stops] = np.arange(n_seq)  # each end is a symbol of its own
        sa, ranks = _suffix_order(symbols, int(lens.max(initial=0)) + 1)
        plain = np.zeros(n, np.int64)  # in the transform all ends are symbol 0
        plain[at] = ids + 1
        bwt = plain[sa - 1]
        self.sigma = len(self.alphabet) + 1
        self.wavelet = WaveletMatrix(bwt, self.sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(plain, minlength=self.sigma))])
        owner = np.repeat(np.arange(n_seq), lens + 1)
        self.mass = np.concatenate([[0], np.cumsum(weight[owner[sa]])])
        lcp = np.zeros(n + 1, np.int32)
        lcp[0] = lcp[n] = -1
        a, b = sa[:-1].copy(), sa[1:].copy()
        for k in range(len(ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
            lcp[1:n][same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        self.lcp, self.n = lcp, n
        self.left, self.right = _nearest_smaller(lcp, -1), _nearest_smaller(lcp, 1)

    def matching_statistics(self, hashes: np.ndarray, offs: np.ndarray, least: int) -> np.ndarray:
        """For each position of each pattern, the length of the longest prefix of the rest of the
        pattern whose occurrences in the index weigh at least ``least`` together."""
        out = np.zeros(len(hashes), np.int32)
        spot = np.searchsorted(self.alphabet, hashes)
        spot[spot == len(self.alphabet)] = 0
        symbol = np.where(self.alphabet[spot] == hashes, spot + 1, 0) if len(self.alphabet) else np.zeros(len(hashes), np.int64)
        lens = np.diff(offs)
        rows = np.argsort(-lens, kind="stable")
        lo, hi, depth = (np.zeros(len(rows), np.int64) for _ in range(3))
        hi[:] = self.n
        done = 0
        while True:
            live = rows[:np.searchsorted(-lens[rows], -done, "left")]  # longer than done
            if not len(live):
                return out
            at = offs[live + 1] - 1 - done
            c = symbol[at]
            todo = np.arange(len(live))
            while len(todo):
                r, s = live[todo], c[todo]
                a = self.first[s] + self.wavelet.rank(s, lo[r])
                b = self.first[s] + self.wavelet.rank(s, hi[r])
                good = (s > 0) & (self.mass[b] - self.mass[a] >= least)
                g = r[good]
                lo[g], hi[g] = a[good], b[good]
                depth[g] += 1
                stuck = ~good
                todo, r = todo[stuck], r[stuck]
                root = depth[r] == 0
                todo, r = todo[~root], r[~root]
                left, right = self.lcp[lo[r]], self.lcp[hi[r]]
                deep = np.maximum(left, right)
                new_lo = np.where(left == deep, self.left[lo[r]], lo[r])
                new_hi = np.where(right == deep, self.right[hi[r]], hi[r])
                top = deep <= 0
                lo[r], hi[r] = np.where(top, 0, new_lo), np.where(top, self.n, new_hi)
                depth[r] = np.maximum(deep, 0)
            out[at] = depth[live]
            done += 1
