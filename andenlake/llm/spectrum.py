"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``A - s I`` tells how many eigenvalues lie above ``s``. It is read off
the pivots of an LDLᵀ factorisation with symmetric pivoting. Bisection on that count
isolates one eigenvalue after another from the top; within its interval Rayleigh quotient
iteration converges cubically, and counts on both sides of the result certify which
eigenvalue it is. Eigenvalues that no shift can separate are one cluster, for which
inverse iteration gives an orthonormal basis. The matrix is as large as a vector is
long, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

_GROWTH = (1 + 17 ** 0.5) / 8
_EPS = float(np.finfo("f8").eps)
STEPS = 30


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """Numbers of eigenvalues above and below the shift: signs of the pivots of LDLᵀ.

    A pivot is one diagonal entry, or two rows at once where the diagonal is too small
    against what stands beside it."""
    a = matrix - shift * np.eye(len(matrix))
    above, below, k = 0, 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < len(a):
        column = np.abs(a[k + 1:, k])
        beside = float(column.max()) if len(column) else 0.0
        own, wide = abs(a[k, k]), 1
        if own == 0 == beside:
            k += 1
            continue
        if own < _GROWTH * beside:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            far = float(row.max())
            if own * far < _GROWTH * beside ** 2:
                if abs(a[r, r]) >= _GROWTH * far:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    wide = 2
        pivot, rest = a[k:k + wide, k:k + wide], a[k + wide:, k:k + wide]
        if wide == 1:
            above, below = above + (pivot[0, 0] > 0), below + (pivot[0, 0] < 0)
            a[k + 1:, k + 1:] -= np.outer(rest[:, 0] / pivot[0, 0], rest[:, 0])
        else:  # such a pair has one sign each
            above, below = above + 1, below + 1
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(pivot, rest.T)
        k += wide
    return int(above), int(below)


class Slicer:
    """Counts of eigenvalues above shifts, each worked out once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(1)  # Gershgorin: no eigenvalue is outside
        self.size = float(radius.max())
        self.least = 8 * _EPS * self.size * len(matrix)
        self.known = {-self.size - self.least: len(matrix), self.size + self.least: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.matrix, shift)[0]
        return self.known[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The closest known shifts around eigenvalue ``k`` (from 1, falling)."""
        return (max(s for s, n in self.known.items() if n >= k),
                min(s for s, n in self.known.items() if n < k))

    def halve(self, k: int) -> None:
        low, high = self.interval(k)
        self.above((low + high) / 2)

    def alone(self, k: int) -> bool:
        low, high = self.interval(k)
        return self.known[low] == k and self.known[high] == k - 1

    def narrow(self, k: int) -> bool:
        low, high = self.interval(k)
        return high - low <= 4 * self.least


def _without(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):  # twice is enough
        for other in found:
            vector = vector - other * (other @ vector)
    return vector / np.linalg.norm(vector)


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, nudge: float) -> np.ndarray:
    eye = np.eye(len(matrix))
    for k in range(4):
        try:
            found = np.linalg.solve(matrix - (shift + k * nudge) * eye, vector)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
    return vector


def rayleigh(slicer: Slicer, k: int, found: list[np.ndarray], seed: int
             ) -> tuple[float, np.ndarray, bool]:
    """From the interval's middle: quotient, vector, and whether it is eigenvalue ``k``."""
    matrix = slicer.matrix
    low, high = slicer.interval(k)
    vector = _without(np.random.default_rng(seed).standard_normal(len(matrix)), found)
    shift, value = (low + high) / 2, 0.0
    for step in range(STEPS):
        vector = _without(_solve(matrix, shift, vector, slicer.least), found)
        value = float(vector @ matrix @ vector)
        left = float(np.linalg.norm(matrix @ vector - value * vector))
        if left <= slicer.least:
            break
        # Two steps of inverse iteration, then the quotient is the shift.
        if step and low < value < high:
            shift = value
    near = left + slicer.least
    certain = slicer.above(value - near) >= k and slicer.above(value + near) <= k - 1
    return value, vector, left <= 64 * slicer.least and certain


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    size = len(matrix)
    count = min(count, size)
    slicer = Slicer(matrix)
    values: list[float] = []
    found: list[np.ndarray] = []
    if slicer.size == 0:
        return np.zeros(count), np.eye(size)[:, :count]
    for k in range(1, count + 1):
        while True:
            while not slicer.alone(k) and not slicer.narrow(k):
                slicer.halve(k)
            value, vector, certain = rayleigh(slicer, k, found, k)
            if certain or slicer.narrow(k):
                break
            slicer.halve(k)
        values.append(value)
        found.append(vector)
    return np.array(values), np.stack(found, 1)
