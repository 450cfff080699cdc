"""Eigenpairs of a symmetric matrix by FEAST contour integration (numpy).

The spectrum is cut into intervals by inertia counts. On each interval a Gauss-Legendre
quadrature of the resolvent along a circle, a complex shifted solve a node, filters a
random block onto the wanted eigenvectors; Rayleigh-Ritz extracts them, and the block is
filtered again until the residuals are at rounding level. The number of pairs found in
an interval must equal the number that the inertia counts promise; otherwise the block
grows and the interval is done again.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the half circle.
NODES = 8
#: Most eigenvalues of one interval, unless they lie too close to be parted.
PER_INTERVAL = 8
ROUNDS = 40


def count_below(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of a under shift: the negative part of the inertia of a - shift I.

    LDL' with Bunch-Parlett pivoting: complete pivoting with blocks of one or two rows.
    """
    m = a - shift * np.eye(len(a))
    alpha, negative = (1 + np.sqrt(17)) / 8, 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        i = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diagonal(m)))
        j, k = divmod(int(off.argmax()), len(m))
        pivots = [i] if diagonal[i] >= alpha * off[j, k] else [j, k]
        block = m[np.ix_(pivots, pivots)]
        if not block.any():
            return negative  # what is left is zero
        negative += int((np.linalg.eigvalsh(block) < 0).sum())
        rest = np.delete(np.arange(len(m)), pivots)
        side = m[np.ix_(rest, pivots)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        m = (m + m.T) / 2
    return negative


def intervals(a: np.ndarray, wanted: int, floor: float = -np.inf) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), rising, that hold at least the ``wanted`` largest ones, or all from floor on."""
    radius = np.abs(a).sum(axis=1) - np.abs(np.diagonal(a))
    low = float((np.diagonal(a) - radius).min())
    high = float((np.diagonal(a) + radius).max())
    margin = 1e-3 * max(high - low, abs(high), abs(low), 1e-300)
    low, high = max(low - margin, floor), high + margin
    narrow = 64 * np.finfo(float).eps * max(abs(low), abs(high))
    todo, done, found = [(low, high, count_below(a, low), len(a))], [], 0
    while todo and found < wanted:
        lo, hi, below_lo, below_hi = todo.pop()  # the highest is done first
        inside = below_hi - below_lo
        if not inside:
            continue
        if inside > PER_INTERVAL and hi - lo > narrow:
            mid = (lo + hi) / 2
            below = count_below(a, mid)
            todo += [(lo, mid, below_lo, below), (mid, hi, below, below_hi)]
        else:
            done.append((lo, hi, inside))
            found += inside
    return done[::-1]


def solve_interval(a: np.ndarray, low: float, high: float, inside: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs with low <= value < high: (values, columns of vectors)."""
    n, norm = len(a), np.abs(a).sum(axis=1).max()
    size = min(n, inside + max(4, inside // 2))
    x, w = np.polynomial.legendre.leggauss(NODES)
    center, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (1 - x) / 2)  # upper half of the circle; the lower one is its mirror image
    shifted = [center + radius * t for t in turns]
    tolerance = 4 * n * np.finfo(float).eps * norm
    while True:
        block = rng.standard_normal((n, size))
        before = np.inf
        for _ in range(ROUNDS):
            filtered = np.zeros((n, size))
            for z, t, weight in zip(shifted, turns, w, strict=True):
                solved = np.linalg.solve(z * np.eye(n) - a, block)
                filtered += weight / 2 * np.real(radius * t * solved)
            basis, _ = np.linalg.qr(filtered)
            values, rotated = np.linalg.eigh(basis.T @ a @ basis)
            block = basis @ rotated
            keep = (values >= low) & (values < high)
            residual = np.abs(a @ block[:, keep] - block[:, keep] * values[keep]).max(initial=0)
            if keep.sum() == inside and (residual <= tolerance and residual >= before / 2):
                return values[keep], block[:, keep]
            before = residual if keep.sum() == inside else np.inf
        if keep.sum() == inside and residual <= tolerance:
            return values[keep], block[:, keep]
        if size == n:  # the whole space: Rayleigh-Ritz is exact, an eigenvalue lies on the border
            order = np.argsort(np.abs(values - center))[:inside]
            return values[order], block[:, order]
        size = min(n, 2 * size)


def largest(a: np.ndarray, wanted: int, floor: float = -np.inf, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of at least floor, falling, and unit eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    pairs = [solve_interval(a, *part, rng) for part in intervals(a, min(wanted, len(a)), floor)]
    if not pairs:
        return np.zeros(0), np.zeros((len(a), 0))
    # pairs of different intervals are orthogonal to rounding only: one more Rayleigh-Ritz over all of them
    basis, _ = np.linalg.qr(np.concatenate([x for _, x in pairs], axis=1))
    values, rotated = np.linalg.eigh(basis.T @ a @ basis)
    return values[::-1][:wanted], (basis @ rotated)[:, ::-1][:, :wanted]
