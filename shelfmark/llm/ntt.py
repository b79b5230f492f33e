"""Exact integer convolutions modulo two primes, for many rows at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Primes c * 2**k + 1 under 2**31 and a generator of each, k at least 26.
PRIMES = ((2013265921, 31), (469762049, 3))
#: Longest transform that both primes allow.
LONGEST = 1 << 26
#: Numbers in one transform of several rows.
ROOM = 1 << 18


@lru_cache(maxsize=64)
def _roots(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order `size`, the first half, by doubling."""
    root = pow(generator, (prime - 1) // size, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    powers = np.ones(1, dtype=np.uint64)
    while len(powers) < size // 2:
        step = np.uint64(pow(root, len(powers), prime))
        powers = np.concatenate([powers, powers * step % np.uint64(prime)])
    return powers


def _forward(a: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each row, places in bit-reversed order."""
    p, (m, size) = np.uint64(prime), a.shape
    half = size // 2
    while half:
        a = a.reshape(m, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1]
        roots = _roots(2 * half, prime, generator, False)
        total = u + v
        total -= p * (total >= p)
        a = np.stack([total, (u + (p - v)) * roots % p], axis=2)
        half //= 2
    return a.reshape(m, size)


def _backward(a: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of `_forward`."""
    p, (m, size) = np.uint64(prime), a.shape
    half = 1
    while half < size:
        a = a.reshape(m, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1] * _roots(2 * half, prime, generator, True) % p
        total, off = u + v, u + (p - v)
        total -= p * (total >= p)
        off -= p * (off >= p)
        a = np.stack([total, off], axis=2)
        half *= 2
    return a.reshape(m, size) * np.uint64(pow(size, prime - 2, prime)) % p


def _differences(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Modulo `prime`: the sum of squared differences of each block to its window, at each shift."""
    p = np.uint64(prime)
    x, t = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
    b, w = x.shape[1], t.shape[1]
    size = 1 << (w - 1).bit_length()
    pad = lambda a: np.pad(a, ((0, 0), (0, size - a.shape[1])))
    # Of a cyclic convolution of this size only places below b - 1 mix what wraps around.
    product = _forward(pad(x[:, ::-1]), prime, generator) * _forward(pad(t), prime, generator) % p
    cross = _backward(product, prime, generator)[:, b - 1 : w]
    # Sums of under 2**32 residues stay within 64 bits.
    squares = np.cumsum(t * t % p, axis=1)
    squares = squares[:, b - 1 :] - np.pad(squares[:, : w - b], ((0, 0), (1, 0)))
    own = (x * x % p).sum(axis=1) % p
    return (squares % p + own[:, None] + np.uint64(2) * (p - cross)) % p


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`row, shift` of each place where a row's block stands in its window word by word.

    A sum of squared differences is zero just there; it is below the product of the primes, and so
    zero if zero modulo both, for ids below a million in blocks of half a million. Beyond that
    other places could be found too, never fewer.
    """
    (one, g), (two, h) = PRIMES
    step = max(1, ROOM // windows.shape[1])
    rows, shifts = [], []
    for at in range(0, len(blocks), step):
        x, t = blocks[at : at + step], windows[at : at + step]
        r, s = np.nonzero(_differences(x, t, one, g) == 0)
        if len(r):
            some = np.unique(r)
            second = _differences(x[some], t[some], two, h) == 0
            true = second[np.searchsorted(some, r), s]
            rows.append(r[true] + at)
            shifts.append(s[true])
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(rows), np.concatenate(shifts)) if rows else (none, none)
