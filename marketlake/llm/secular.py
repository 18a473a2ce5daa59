"""Eigendecompositions that grow by rank-one updates.

Q diag(d) Q' + rho v v' has the eigenvalues that solve the secular equation
1 + rho * sum(z_j^2 / (d_j - x)) = 0 with z = Q'v: one between each two neighbouring d, one
above the largest.  Directions that the update doesn't touch (z_j as good as 0), and all but
one of directions with the same d (after a rotation), keep their eigenvalue: deflation.  The
others are solved all at once by rational interpolation at the two poles around each root,
kept inside a bracket.  Roots are held as distances to the nearer pole, and z is computed anew
from them, so that the new vectors are orthogonal to machine precision however close the
eigenvalues lie."""

from __future__ import annotations

import io

import numpy as np

_EPS = np.finfo(np.float64).eps
_STEPS = 100


def solve(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots x of 1 + sum(z2 / (d - x)), for ascending distinct d and positive z2, and the
    matrix of the differences d_j - x_i, row i of root i."""
    k = len(d)
    right = np.append(d[1:], d[-1] + z2.sum())
    half = (right - d) / 2
    upto = np.tri(k)
    value = 1 + (z2 / (d - d[:, None] - half[:, None])).sum(axis=1)
    # the nearer pole is the origin; above the last pole there is no other
    from_left = (value > 0) | (np.arange(k) == k - 1)
    origin = np.where(from_left, d, right)
    delta = d - origin[:, None]
    left, ahead = d - origin, right - origin
    x = np.where(from_left, half, -half)
    low = np.where(value > 0, left, x)
    high = np.where(value > 0, x, ahead)
    x = np.where(from_left & (value <= 0), (x + high) / 2, x)
    rows, found = np.arange(k), x.copy()
    below, above = upto, 1 - upto
    shifted = delta
    with np.errstate(all="ignore"):
        for _ in range(_STEPS):
            t = z2 / (w := shifted - x[:, None])
            tt = t / w
            psi, phi = np.einsum("ij,ij->i", t, below), np.einsum("ij,ij->i", t, above)
            f = 1 + psi + phi
            up = f > 0
            high, low = np.where(up, x, high), np.where(up, low, x)
            to_left, to_right = left - x, ahead - x
            slope_psi = np.einsum("ij,ij->i", tt, below)
            slope_phi = np.einsum("ij,ij->i", tt, above)
            c = f - to_left * slope_psi - to_right * slope_phi
            product = to_left * to_right
            a = (to_left + to_right) * f - product * (slope_psi + slope_phi)
            b = product * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = x + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            still = np.abs(f) > 4 * k * _EPS * (1 + phi - psi)
            still &= high - low > _EPS * np.minimum(np.abs(low), np.abs(high))
            found[rows] = np.where(still, new, x)
            if not still.any():
                break
            if still.all():
                x = new
                continue
            x, rows, low, high = new[still], rows[still], low[still], high[still]
            left, ahead, shifted = left[still], ahead[still], shifted[still]
            below, above = below[still], above[still]
    return origin + found, delta - found[:, None]


def _vectors(d: np.ndarray, z: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Eigenvectors as columns, for the z that has exactly the computed roots."""
    poles = d[:, None] - d
    np.fill_diagonal(poles, 1.0)
    z2 = np.prod(-apart / poles, axis=0)
    vectors = (np.copysign(np.sqrt(np.abs(z2)), z) / apart).T
    return vectors / np.sqrt((vectors * vectors).sum(axis=0))


class Spectrum:
    """Eigenvalues (ascending) and eigenvectors (columns) of the scatter about the mean of the
    rows seen so far, with their number and exact integer sums."""

    def __init__(self, width: int):
        self.n = 0
        self.sums = np.zeros(width, np.int64)
        self.mean = np.zeros(width)
        self.values = np.zeros(width)
        self.vectors = np.eye(width)

    def add(self, row: np.ndarray) -> None:
        """A centred rank-one update."""
        off = row - self.mean
        self.n += 1
        self.sums += row
        self.mean += off / self.n
        if self.n > 1:
            self.update((self.n - 1) / self.n, off)

    def merge(self, other: Spectrum) -> None:
        """Scatter of both: the other's spectrum, one vector after the other, and the
        distance of the means."""
        if other.n == 0:
            return
        n, off = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(value, vector)
        if self.n:
            self.update(self.n * other.n / n, off)
        self.mean += off * (other.n / n)
        self.n, self.sums = n, self.sums + other.sums

    def update(self, rho: float, vector: np.ndarray) -> None:
        """Add rho * vector vector', rho > 0."""
        d, q = self.values, self.vectors
        z = (vector @ q) * np.sqrt(rho)
        norm = np.sqrt(z @ z)
        if norm == 0:
            return
        tolerance = 8 * _EPS * max(np.abs(d).max(), norm * norm)
        live = np.flatnonzero(np.abs(z) * norm > tolerance)
        live = self._rotate_equal(live, z, tolerance)
        if not len(live):
            return
        poles = d[live]
        d[live], apart = solve(poles, z[live] ** 2)
        q[:, live] = q[:, live] @ _vectors(poles, z[live], apart)
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], q[:, order]

    def _rotate_equal(self, live: np.ndarray, z: np.ndarray, tolerance: float) -> np.ndarray:
        """Turn directions with (nearly) the same eigenvalue so that the update touches only
        the last of them."""
        d, q = self.values, self.vectors
        a, b = z[live[:-1]], z[live[1:]]
        if not (np.diff(d[live]) * np.abs(a * b) <= tolerance * (a * a + b * b)).any():
            return live
        left, last = [], live[0]
        for j in live[1:]:
            r = np.hypot(z[last], z[j])
            c, s = z[j] / r, z[last] / r
            if (d[j] - d[last]) * abs(c * s) <= tolerance:
                z[last], z[j] = 0.0, r
                q[:, last], q[:, j] = c * q[:, last] - s * q[:, j], s * q[:, last] + c * q[:, j]
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
            else:
                left.append(last)
            last = j
        return np.array([*left, last])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for part in (np.array(self.n), self.sums, self.mean, self.values, self.vectors):
            np.save(out, part)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Spectrum:
        source, new = io.BytesIO(data), cls(0)
        n, new.sums, new.mean, new.values, new.vectors = (np.load(source) for _ in range(5))
        new.n = int(n)
        return new
