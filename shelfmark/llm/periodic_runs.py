"""Periodic runs of words: block convolutions at dyadic scales seed runs that are then extended."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches
from shelfmark.llm.ntt import LONGEST, zero_mismatches

#: A run has at least LEAST words and TIMES its period.
LEAST = 24
TIMES = 3
#: Words of the shortest block; it serves all periods under twice its length.
BLOCK = 8
#: Words handled at once; a longer text is handled alone.
GROUP_WORDS = 1 << 17

_HASH = 2147483647

SCHEMA = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
)


class _Prefixes:
    """Hashes of prefixes modulo a prime, to compare stretches of any length in one step."""

    def __init__(self, ids: np.ndarray) -> None:
        p = np.uint64(_HASH)
        n = len(ids)
        rng = np.random.default_rng(17)
        base = int(rng.integers(1 << 20, _HASH))
        power = np.ones(1, dtype=np.uint64)
        while len(power) <= n:
            power = np.concatenate([power, power * np.uint64(pow(base, len(power), _HASH)) % p])
        self.power = power[: n + 1]
        value = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) + np.uint64(1)
        # Residues are below 2**31, so sums of 2**33 of them fit.
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * self.power[:n] % p)]) % p

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether `length` words from `a` and from `b`, at or after a, look equal."""
        p = np.uint64(_HASH)
        x = (self.sums[a + length] + p - self.sums[a]) % p
        y = (self.sums[b + length] + p - self.sums[b]) % p
        return x * self.power[b - a] % p == y

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Longest equal stretch, up to `most`, from a and b on, or just before them."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            off = middle if back else 0
            fits = self.same(a - off, b - off, middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def _later(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of id and place, as sorted keys, and the key of id 0 and place 0 onwards."""
    keys = ids * (len(ids) + 1) + np.arange(len(ids))
    return np.sort(keys), keys


def _seeds(ids: np.ndarray, later, block: int, first: int, last: int, reach: np.ndarray):
    """`place, distance`: aligned blocks of `block` words that stand again `first` to `last` words on.

    Blocks are left out that a run of a shorter period holds with their whole window (no other
    run's smallest period can show there), and those of which a leading word has no later place in
    its window.
    """
    n = len(ids)
    at = np.arange(0, max(0, n - block - first + 1), block)
    at = at[reach[at] < np.minimum(n, at + block + last)]
    ordered, keys = later
    for k in range(block):
        if not len(at):
            break
        word = at + k
        found = np.searchsorted(ordered, keys[word] + first)
        stands = np.zeros(len(at), dtype=bool)
        inside = found < len(ordered)
        stands[inside] = ordered[found[inside]] <= keys[word[inside]] + last
        at = at[stands]
    if not len(at):
        return at, at
    width = block + last - first
    padded = np.append(ids, np.full(block + last + 1, ids.max() + 1))
    row, shift = zero_mismatches(
        padded[at[:, None] + np.arange(block)], padded[at[:, None] + first + np.arange(width)]
    )
    return at[row], shift + first


def find_runs(ids: np.ndarray, longest: int) -> np.ndarray:
    """`start, length, period` of every run in `ids`, sorted; none is of a period over `longest`.

    A run of smallest period q and length at least max(24, 3 q) holds, for the scale B with
    B <= q < 2 B (B = 8 for all q below 16), an aligned block of B words together with its copy q
    words on. So the zero-mismatch distances of aligned blocks of all scales seed every run. A seed
    is extended both ways by its distance; the stretch that results is a run if long enough, of
    the least distance that gives this stretch.
    """
    n = len(ids)
    none = np.empty((0, 3), dtype=np.int64)
    if n < LEAST:
        return none
    later, prefixes = _later(ids), None
    reach = np.zeros(n, dtype=np.int64)
    stretches = []
    block = BLOCK
    while block <= max(longest, 1) and 2 * block <= LONGEST:
        first, last = (1, 2 * BLOCK - 1) if block == BLOCK else (block, 2 * block - 1)
        place, distance = _seeds(ids, later, block, first, min(last, max(longest, 1)), reach)
        keep = reach[place] < place + block + distance
        place, distance = place[keep], distance[keep]
        if len(place):
            prefixes = prefixes or _Prefixes(ids)
            other = place + distance
            start = place - prefixes.common(place, other, place, True)
            stop = other + prefixes.common(place, other, n - other, False)
            found = np.unique(np.stack([start, stop, distance], axis=1), axis=0)
            found = _exact(ids, found[found[:, 1] - found[:, 0] >= np.maximum(LEAST, TIMES * found[:, 2])])
            stretches.append(found)
            # Runs of periods up to this block serve the next scales; of stretches with one start the longest.
            for s, e, _ in found[found[:, 2] <= 2 * block]:
                reach[s:e] = np.maximum(reach[s:e], e)
        block *= 2
    if not stretches:
        return none
    every = np.concatenate(stretches)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    least = np.ones(len(every), dtype=bool)
    least[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[least]
    runs = np.stack([every[:, 0], every[:, 1] - every[:, 0], every[:, 2]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _exact(ids: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Stretches compared word by word; one that hashes made too long is cut where words differ."""
    out = []
    for s, e, d in found:
        off = np.flatnonzero(ids[s : e - d] != ids[s + d : e])
        if not len(off):
            out.append((s, e, d))
            continue
        edges = np.concatenate([[-1], off, [e - d - s]])
        for a, b in zip(edges[:-1] + 1, edges[1:]):
            if b - a + d >= max(LEAST, TIMES * d):
                out.append((s + a, s + b + d, d))
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def _most(runs: np.ndarray) -> tuple[int, int, int]:
    """The run of greatest length / period; ties to the smallest start, then period."""
    best = tuple(int(v) for v in runs[0])
    for s, length, q in runs[1:].tolist():
        if length * best[2] > best[1] * q:
            best = (s, length, q)
    return best


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words outside what follows the first period of a run, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def runs_of_texts(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    """`find_runs` of each list of words, several lists at once.

    Ids of one text are not those of another, so no run goes from one text into the next.
    """
    group: list[list[bytes]] = []
    size = 0

    def done() -> Iterator[np.ndarray]:
        ids = np.empty(size, dtype=np.int64)
        first, ends, at = 0, [], 0
        for words in group:
            known: dict[bytes, int] = {}
            ids[at : at + len(words)] = [known.setdefault(w, first + len(known)) for w in words]
            first += len(known)
            at += len(words)
            ends.append(at)
        runs = find_runs(ids, max(len(words) for words in group) // TIMES)
        cuts = np.searchsorted(runs[:, 0], [0, *ends])
        for a, b, start in zip(cuts[:-1], cuts[1:], [0, *ends[:-1]]):
            yield runs[a:b] - np.array([start, 0, 0])

    for words in texts:
        if group and size + len(words) > GROUP_WORDS:
            yield from done()
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield from done()


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with the tail of one document in ten, chosen by its id, made to repeat itself.

    A null id is never chosen.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def detect_runs(docs: DataFrame, loop: bool = False) -> DataFrame:
    """`doc_id` and the columns of SCHEMA for each row of `docs (doc_id, text)`.

    A run is a stretch of consecutive words with smallest period q and at least 24 words and three
    periods, as long as it can be. `start, length, period, exponent_milli` are those of the run of
    greatest length / period, null without runs; `runs` lists all by start, then period;
    `collapsed` is the text, its words joined by single spaces, without what follows the first
    period of a run. With `loop`, `looped` changes the words first.

    A text null, empty or without words has no words and runs and an empty `collapsed`. Null and
    repeated doc_ids are rows like others; extra columns are not read; an empty table gives an
    empty one. Each row is handled by itself, whole, in memory of its words; the work is words
    times the square of the log of their number at worst, also where all words are equal.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [(t.as_py() or "").encode().split() for t in batch.column(1)]
            if loop:
                texts = [looped(words, i) for words, i in zip(texts, ids)]
            columns: list[list] = [[] for _ in range(8)]
            for words, runs in zip(texts, runs_of_texts(texts)):
                best = _most(runs) if len(runs) else (None, None, None)
                milli = 1000 * best[1] // best[2] if len(runs) else None
                listed = [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()]
                text = _collapsed(words, runs).decode()
                for column, value in zip(columns, (len(words), len(runs), *best, milli, listed, text)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, _TYPES)]], names=["doc_id", *_NAMES]
            )

    return rows.mapInArrow(detect, f"doc_id {kind}, {SCHEMA}")


_NAMES = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed")
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_TYPES = (*[pa.int64()] * 6, pa.list_(_RUN), pa.string())
