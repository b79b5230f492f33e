"""Words of many texts at once: hashes from arrays of bytes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes handled at once; a longer text is handled alone.
GROUP_BYTES = 1 << 18

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of consecutive texts of about GROUP_BYTES."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


class Words:
    """Words of a group of texts: `hashes` and `lengths` of all, and `first[i]:first[i + 1]` of text i."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.data = data
        self.text_ends = np.cumsum([len(t) + 1 for t in texts])
        solid = ~_WHITE[data]
        edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.lengths = self.ends - self.starts
        self.first = np.concatenate([[0], np.searchsorted(self.starts, self.text_ends)])
        if not len(self.starts):
            self.hashes = np.empty(0, dtype=np.uint64)
            return
        at = np.flatnonzero(solid)
        offsets = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(at)) - np.repeat(offsets, self.lengths)
        power = np.full(int(self.lengths.max()), _BASE)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.hashes = mix64(np.add.reduceat(_BYTE[data[at]] * power[place], offsets))


def shingles(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the `k`-word shingles of each text.

    A text of fewer words has one shingle, the whole sequence; one without words has none.
    """
    words = Words(texts)
    h = words.hashes
    factors = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - k + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        rolled += h[i : i + n] * factors[i]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            part = (h[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(np.array([part], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
