"""Largest eigenvalues of a symmetric matrix by contour integration (FEAST).

The upper end of the spectrum is cut into intervals that hold few eigenvalues each, by
counting the negative pivots of shifted factorisations (Sylvester's law of inertia).
For each interval, a circle through its ends is a contour: the trapezoid rule over
solves with the complex shifted matrix damps all that lies outside, Rayleigh-Ritz
takes eigenvectors from what is left, and both repeat until the residuals are small.
An interval must give as many eigenvalues as its ends' inertia counts say. Its empty ends are cut
off first, and where many eigenvalues crowd just outside of it the basis is made wider.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Nodes of the whole circle, eigenvalues of an interval, rounds with a basis of one width, and the residual aimed at.
NODES, MOST, ROUNDS, RESIDUAL = 16, 8, 12, 1e-13
#: Relative to the matrix: an interval of this width is not cut further, and ends keep so far off eigenvalues.
NARROW, CLEAR = 1e-7, 1e-10


def negatives(a: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, by Bunch and Parlett's factorisation."""
    a, found = a.copy(), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        off = np.abs(a - np.diag(np.diag(a)))
        k = int(diagonal.argmax())
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[k] == 0 and off[i, j] == 0:
            break  # zeros are neither
        if diagonal[k] >= 0.6404 * off[i, j]:
            pivots = [k]
            found += bool(a[k, k] < 0)
        else:
            pivots = [int(i), int(j)]  # an indefinite block: one of each sign
            found += 1
        rest = np.delete(np.arange(len(a)), pivots)
        side = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivots, pivots)], side.T)
        a = (a + a.T) / 2
    return found


def above(v: np.ndarray, bound: float) -> int:
    """Eigenvalues above a bound."""
    return negatives(bound * np.eye(len(v)) - v)


def intervals(v: np.ndarray, wanted: int) -> Iterator[tuple[float, float, int]]:
    """(low, high, count) from the top down, until ``wanted`` eigenvalues are in them."""
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    scale = np.abs(v).max()
    low = float((np.diag(v) - radius).min() - 1e-3 * scale)
    high = float((np.diag(v) + radius).max() + 1e-3 * scale)
    waiting, found = [(low, high, len(v), 0)], 0
    while waiting and found < wanted:
        low, high, below, over = waiting.pop()  # eigenvalues above low and above high
        if below == over:
            continue
        if below - over == 1 or high - low <= NARROW * scale:
            found += below - over
            yield low, high, below - over
            continue
        for share in (0.5, 0.45, 0.55, 0.4, 0.6):
            middle = low + share * (high - low)
            between = above(v, middle - CLEAR * scale)
            if between == above(v, middle + CLEAR * scale):
                break
        if below - over <= MOST and below > between > over:  # no half is empty: the circle fits
            found += below - over
            yield low, high, below - over
            continue
        waiting += [(low, middle, below, between), (middle, high, between, over)]


def within(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between two bounds, and their vectors as columns."""
    size = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    angles = np.pi * (2 * np.arange(NODES // 2) + 1) / NODES  # the upper half; the lower is its conjugate
    shifts = radius * np.exp(1j * angles)
    identity = np.eye(size)
    solvers = [s * np.linalg.inv((centre + s) * identity - v) for s in shifts]
    scale = np.abs(v).sum(axis=1).max()
    width = min(size, 2 * count + 4)
    while True:
        basis, last = np.random.default_rng(17).standard_normal((size, width)), np.inf
        for _ in range(ROUNDS):
            filtered = (2 / NODES) * sum((s @ basis).real for s in solvers)
            basis, _ = np.linalg.qr(filtered)
            values, turn = np.linalg.eigh(basis.T @ v @ basis)
            basis = basis @ turn
            inside = np.flatnonzero((values > low) & (values <= high))
            if len(inside) == count:
                residual = np.linalg.norm(v @ basis[:, inside] - basis[:, inside] * values[inside], axis=0).max()
                if residual <= RESIDUAL * scale and residual >= last / 4:  # and it falls no further
                    return values[inside], basis[:, inside]
                last = residual
        if width == size:
            raise ArithmeticError(f"{len(inside)} of {count} eigenvalues found between {low} and {high}")
        width = min(size, 2 * width)  # those just outside of the circle fall too slowly: take them along


def largest(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns.

    Of each vector the entry that is largest in size is positive.
    """
    scale = float(np.abs(v).max()) if v.size else 0.0
    if not wanted or not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / scale
    parts = [within(unit, *interval)[1] for interval in intervals(unit, wanted)]
    # One more Rayleigh-Ritz step over all intervals makes their vectors orthogonal.
    basis, _ = np.linalg.qr(np.hstack(parts))
    values, turn = np.linalg.eigh(basis.T @ unit @ basis)
    order = np.argsort(values)[::-1][:wanted]
    vectors = basis @ turn[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order] * scale, vectors * signs
