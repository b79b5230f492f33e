"""Leading eigenpairs of a symmetric matrix: tridiagonal form, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
#: Eigenvalues of a run closer than this share of the norm are a cluster: their vectors are kept orthogonal.
CLUSTER = 1e-3
ITERATIONS = 8


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """`diagonal, off, reflectors`: each unit reflector v turns its rest of the matrix by I - 2 v v'."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    off = np.zeros(max(0, n - 1))
    reflectors = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        scale = np.abs(column).max()
        v = np.zeros(n - k - 1)
        if scale > 0 and np.any(column[1:]):
            v = column / scale
            norm = np.sqrt(v @ v)
            head = -norm if v[0] > 0 else norm
            off[k] = head * scale
            v[0] -= head
            v /= np.sqrt(v @ v)
            rest = a[k + 1 :, k + 1 :]
            w = 2 * (rest @ v)
            w -= (v @ w) * v
            rest -= np.outer(v, w)
            rest -= np.outer(w, v)
        else:
            off[k] = column[0]
        reflectors.append(v)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray, floor: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of `at`."""
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        small = np.abs(pivot) < floor
        pivot = d - at - e * e / np.where(small, np.where(pivot < 0, -floor, floor), pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The `k` largest, falling, by bisection down to neighbouring doubles or the rounding of the norm."""
    n = len(diagonal)
    beside = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    norm = max(float((np.abs(diagonal) + beside).max()), np.finfo(np.float64).tiny)
    floor = _EPS * _EPS * norm + np.finfo(np.float64).tiny
    low = np.full(k, (diagonal - beside).min() - 2 * n * _EPS * norm)
    high = np.full(k, (diagonal + beside).max() + 2 * n * _EPS * norm)
    # The j-th largest is the point where the count of those below passes n - 1 - j.
    below = n - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high) & (high - low > _EPS * _EPS * norm)
        if not open_.any():
            return low + (high - low) / 2
        over = sturm_count(diagonal, off, middle, floor) > below
        high = np.where(open_ & over, middle, high)
        low = np.where(open_ & ~over, middle, low)


def _factor(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float):
    """LU of T - shift with row exchanges: (u0, u1, u2, multipliers, exchanged)."""
    n = len(diagonal)
    d = diagonal - shift
    u0, u1, u2 = d.copy(), np.append(off, 0.0), np.zeros(n)
    multiplier, swapped = np.zeros(n), np.zeros(n, dtype=bool)
    for i in range(n - 1):
        below, next_d, next_u = off[i], d[i + 1], off[i + 1] if i + 1 < n - 1 else 0.0
        if abs(below) > abs(u0[i]):
            swapped[i] = True
            m = u0[i] / below
            above = u1[i]
            u0[i], u1[i], u2[i] = below, next_d, next_u
            u0[i + 1], u1[i + 1] = above - m * next_d, -m * next_u
        else:
            if abs(u0[i]) < floor:
                u0[i] = floor
            m = below / u0[i]
            u0[i + 1], u1[i + 1] = next_d - m * u1[i], next_u
        multiplier[i] = m
    u0[np.abs(u0) < floor] = floor
    return u0, u1, u2, multiplier, swapped


def _solve(factors, b: np.ndarray) -> np.ndarray:
    u0, u1, u2, multiplier, swapped = factors
    n = len(b)
    x = b.copy()
    for i in range(n - 1):
        if swapped[i]:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= multiplier[i] * x[i]
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= u1[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= u2[i] * x[i + 2]
        x[i] /= u0[i]
        # A huge pivot ratio must not overflow; the direction alone counts.
        if abs(x[i]) > 1e100:
            x /= 1e100
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, of falling `values` by inverse iteration.

    Vectors of a cluster are made orthogonal to those found before in it, after every step.
    """
    n = len(diagonal)
    rng = np.random.default_rng(11)
    beside = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    norm = max(float((np.abs(diagonal) + beside).max()), np.finfo(np.float64).tiny)
    floor = _EPS * norm
    found = np.zeros((n, len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # Equal values would repeat the same system; a shift by roundings sets them apart.
        factors = _factor(diagonal, off, value - 4 * (j - first) * floor, floor)
        cluster = found[:, first:j]
        best, x = np.inf, rng.standard_normal(n)
        for _ in range(ITERATIONS):
            x = _solve(factors, x / np.abs(x).max())
            for _ in range(2):
                x -= cluster @ (cluster.T @ x)
            length = np.sqrt(x @ x)
            if not np.isfinite(length) or length == 0:
                x = rng.standard_normal(n)
                continue
            x /= length
            image = diagonal * x
            image[:-1] += off * x[1:]
            image[1:] += off * x[:-1]
            left = float(np.abs(image - value * x).max())
            if left < best:
                best, found[:, j] = left, x
            elif left < 64 * floor:
                break
    return found


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` largest eigenvalues, falling, and their unit vectors as columns.

    The entry of greatest size of a vector (the first such) is positive, so equal matrices give
    equal results.
    """
    n = len(matrix)
    k = min(k, n)
    size = float(np.abs(matrix).max(initial=0))
    if not size:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        part = vectors[at + 1 :]
        part -= 2 * np.outer(v, v @ part)
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    most = np.abs(vectors).argmax(axis=0)
    return values * size, vectors * np.where(vectors[most, np.arange(k)] < 0, -1.0, 1.0)
