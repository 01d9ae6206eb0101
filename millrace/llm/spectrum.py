"""Eigenvalues and eigenvectors of a scatter matrix that grows by rank-one updates.

Used inside tasks. A spectrum is (rows, mean, values ascending, vectors as columns) of
the scatter matrix around the mean. An update by a vector turns the values into the roots
of a secular equation 1 + sum z_i^2 / (d_i - x) = 0, where z is the vector in the basis of
the eigenvectors; values that occur more than once, and directions that z doesn't meet,
are deflated and stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps
#: Steps after which a root counts as found in any case; halving alone would need them.
MOST_STEPS = 80


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots for poles ``d`` (ascending, apart) and weights ``z`` (none zero).

    Returns, for each root, the nearest pole and ``d[j] - root[i]`` in row i, column j,
    which keep their relative precision where a root lies close to a pole. All roots are
    sought at once, with two-pole interpolation inside shrinking brackets.
    """
    n, square = len(d), z * z
    total = square.sum()
    width = np.append(np.diff(d), total)
    middle = d + width / 2
    at_middle = 1 + (square / (d[None, :] - middle[:, None])).sum(axis=1)
    left = at_middle >= 0  # the root lies in the left half of its gap
    left[-1] = True
    origin = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    delta = d[None, :] - d[origin][:, None]
    low = np.where(left, 0.0, -width / 2)
    high = np.where(left, np.where(np.arange(n) < n - 1, width / 2, width * (1 + 8 * EPS)), 0.0)
    root = (low + high) / 2
    here = np.arange(n)
    behind = here[None, :] <= here[:, None]
    pole_a = delta[here, here]
    pole_b = np.append(delta[here[:-1], here[1:]], np.inf)
    active = np.arange(n)
    for _ in range(MOST_STEPS):
        gap = delta[active] - root[active, None]
        part = square / gap
        slope = part / gap
        psi = np.where(behind[active], part, 0.0).sum(axis=1)
        phi = part.sum(axis=1) - psi
        dpsi = np.where(behind[active], slope, 0.0).sum(axis=1)
        dphi = slope.sum(axis=1) - dpsi
        f = 1 + psi + phi
        low[active] = np.where(f < 0, root[active], low[active])
        high[active] = np.where(f < 0, high[active], root[active])
        done = np.abs(f) <= 4 * EPS * n * (1 + np.abs(psi) + phi)
        # Replace the two sums by one pole each, with their values and slopes here.
        a, b = pole_a[active] - root[active], pole_b[active] - root[active]
        s = dpsi * a * a
        last = ~np.isfinite(b)
        b = np.where(last, 1.0, b)
        t = np.where(last, 0.0, dphi * b * b)
        c = 1 + (psi - s / a) + (phi - np.where(last, 0.0, t / b))
        # c + s / (a - h) + t / (b - h) = 0 for the step h
        q2, q1, q0 = c, -(c * (a + b) + s + t), c * a * b + s * b + t * a
        q1 = np.where(last, -c, q1)
        q2 = np.where(last, 0.0, q2)
        q0 = np.where(last, c * a + s, q0)
        with np.errstate(all="ignore"):
            disc = np.sqrt(np.maximum(q1 * q1 - 4 * q2 * q0, 0))
            h = np.where(last, a + s / c, 2 * q0 / (-q1 + np.where(q1 > 0, -disc, disc)))
        new = root[active] + h
        bad = ~np.isfinite(new) | (new <= low[active]) | (new >= high[active])
        new = np.where(bad, (low[active] + high[active]) / 2, new)
        done |= (new == root[active]) | (high[active] - low[active] <= 2 * EPS * np.maximum(np.abs(low[active]), np.abs(high[active])))
        root[active] = np.where(done, root[active], new)
        active = active[~done]
        if not len(active):
            break
    return d[origin] + root, delta - root[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum after ``v v'`` is added."""
    z = v @ vectors
    size = float(z @ z)
    if size == 0.0:
        return values, vectors
    tolerance = 8 * EPS * max(abs(values[-1]), size)
    close = np.flatnonzero(np.diff(values) <= tolerance)
    if len(close):
        vectors = vectors.copy()
        for run in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
            a, b = run[0], run[-1] + 2
            length = np.sqrt(z[a:b] @ z[a:b])
            if length > 0:
                # A reflection lets the last of these directions meet z alone.
                w = z[a:b].copy()
                sign = 1.0 if w[-1] >= 0 else -1.0
                w[-1] += sign * length
                part = vectors[:, a:b]
                vectors[:, a:b] = part - np.outer(part @ w, w) * (2 / (w @ w))
                z[a:b] = 0
                z[b - 1] = -sign * length
    meets = np.abs(z) * np.sqrt(size) > tolerance
    which = np.flatnonzero(meets)
    if not len(which):
        return values, vectors
    d, zs = values[which], z[which]
    roots, apart = secular_roots(d, zs)
    # Weights for which the computed roots are exact, so that the vectors are orthogonal.
    n = len(d)
    below = np.tri(n, n, -1, dtype=bool)
    ratio = -apart
    span = d[:, None] - d[None, :]
    shifted = np.vstack([span[1:], np.ones((1, n))])
    with np.errstate(all="ignore"):
        # Column i: (root_j - d_i) / (d_j - d_i) for j < i, / (d_{j+1} - d_i) for i <= j < n - 1.
        factors = np.where(below.T, ratio / span, np.where(np.arange(n)[:, None] < n - 1, ratio / shifted, ratio))
    exact = np.sqrt(np.abs(np.prod(factors, axis=0))) * np.where(zs < 0, -1.0, 1.0)
    turn = exact[:, None] / apart.T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values, vectors = values.copy(), vectors.copy()
    vectors[:, which] = vectors[:, which] @ turn
    values[which] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    rows: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def _shift(self, rows: int, mean: np.ndarray) -> None:
        """Update by the distance of the means, which become one."""
        total = self.rows + rows
        away = mean - self.mean
        if self.rows and rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.rows * rows / total))
        self.mean = self.mean + away * (rows / total)
        self.rows = total

    def add(self, rows: np.ndarray) -> None:
        """Takes in some rows. More rows than columns are first condensed by a triangular
        factor to as many rows as columns of the same centred scatter."""
        if not len(rows):
            return
        mean = rows.mean(axis=0)
        if len(rows) > 1:
            centred = rows - mean
            if len(centred) > centred.shape[1]:
                centred = np.linalg.qr(centred, mode="r")
            for row in centred:
                self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self._shift(len(rows), mean)

    def merge(self, other: Spectrum) -> None:
        """Takes in another spectrum, one eigenvector after another."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        self._shift(other.rows, other.mean)
