"""Secrets in texts: known shapes, and windows of high entropy within strings of one character class."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches
from shelfmark.llm.words import groups

SPANS = "array<struct<kind:string,start:bigint,stop:bigint,bits:double>>"

# The shapes to be found whatever their entropy.
_ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
ASSIGN_LEAST, HEX_LEAST = 8, 32
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of `letters`; a span joins windows of `width` with `bits` a letter or more."""

    kind: str
    letters: bytes
    width: int
    bits: float

    def table(self) -> np.ndarray:
        out = np.zeros(256, dtype=bool)
        out[list(self.letters)] = True
        return out


_DIGITS = b"0123456789"
_ALNUM = _DIGITS + bytes(range(65, 91)) + bytes(range(97, 123))

#: Random strings of a class stay above its bits: 32 hexadecimal digits have 3.6 on average, 24
#: letters of the others 4.2, or 3.9 where all are lower case or digits.
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + b"abcdefABCDEF", 32, 3.0),
    CharacterClass("entropy_base64", _ALNUM + b"+/", 24, 3.5),
    CharacterClass("entropy_urlsafe", _ALNUM + b"_-", 24, 3.5),
)

#: Parts of a candidate that are read as one piece: a word, capitals, a number.
_PIECE = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Candidates whose pieces are this long on average are words, names, paths or numbers.
WORDLIKE = 4.0
#: A candidate most of whose neighbours differ by one at most is an alphabet or a filler.
STEPPED = 0.6

#: Candidates that match one of these wholly are no secrets.
ALLOWED = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(?i).*(example|placeholder|changeme|dummy|sample|redacted|xxxx).*",
    r"sha(256|384|512)-.*",
    r"(?i)d41d8cd98f00b204e9800998ecf8427e",
    r"(?i)da39a3ee5e6b4b0d3255bfef95601890afd80709",
    r"(?i)e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)
#: What stands before a checksum or an embedded file, not before a secret.
ALLOWED_BEFORE = (b"sha256-", b"sha384-", b"sha512-", b";base64,")


def allowed(candidate: bytes, patterns: list[re.Pattern]) -> bool:
    pieces = _PIECE.findall(candidate)
    if sum(map(len, pieces)) >= WORDLIKE * len(pieces):
        return True
    codes = np.frombuffer(candidate, dtype=np.uint8).astype(np.int16)
    if (np.abs(np.diff(codes)) <= 1).mean() >= STEPPED:
        return True
    text = candidate.decode()
    return any(p.fullmatch(text) for p in patterns)


class Entropy:
    """Shannon entropy of every window of a string, from counts that each step changes by two.

    With c of a letter in a window of w, its bits are log2(w) - sum(c log2 c) / w. The sum is kept
    as an integer of 2**-32 bits, so that it does not drift along a long string.
    """

    ONE = 1 << 32

    def __init__(self, width: int, bits: float) -> None:
        weight = [0, *(round(c * log2(c) * self.ONE) for c in range(1, width + 1))]
        self.width = width
        self.gain = [b - a for a, b in zip(weight, weight[1:])]
        self.limit = floor(width * (log2(width) - bits) * self.ONE)

    def spans(self, candidate: bytes) -> Iterator[tuple[int, int, float]]:
        """`start, stop, bits`: joined windows within the limit, and the most bits of one of them."""
        width, gain, limit = self.width, self.gain, self.limit
        counts = [0] * 256
        total, start, stop, least = 0, -1, -1, 0
        for i, letter in enumerate(candidate):
            if i >= width:
                gone = candidate[i - width]
                counts[gone] -= 1
                total -= gain[counts[gone]]
            total += gain[counts[letter]]
            counts[letter] += 1
            if i + 1 < width or total > limit:
                continue
            first = i + 1 - width
            if start < 0 or first > stop:
                if start >= 0:
                    yield start, stop, self._bits(least)
                start, least = first, total
            stop, least = i + 1, min(least, total)
        if start >= 0:
            yield start, stop, self._bits(least)

    def _bits(self, total: int) -> float:
        return log2(self.width) - total / self.ONE / self.width


def _runs(mask: np.ndarray, least: int) -> np.ndarray:
    """`start, stop` of runs of at least `least` true entries."""
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False)).reshape(-1, 2)
    return edge[edge[:, 1] - edge[:, 0] >= least]


class Scanner:
    def __init__(self, classes: tuple[CharacterClass, ...], allow: tuple[str, ...]) -> None:
        self.hex = np.zeros(256, dtype=bool)
        self.hex[list(b"0123456789abcdef")] = True
        self.classes = [(c, c.table(), Entropy(c.width, c.bits)) for c in classes]
        self.patterns = [re.compile(p) for p in allow]
        self.order = {k: i for i, k in enumerate((*BASE_KINDS, *(c.kind for c in classes)))}

    def __call__(self, texts: list[bytes]) -> list[list[tuple]]:
        """`kind, start, stop, bits` in code points, sorted, for each of some texts.

        The texts are searched at once: neither a shape nor a candidate holds the line feed
        between them.
        """
        whole = b"\n".join(texts) + b"\n"
        data = np.frombuffer(whole, dtype=np.uint8)
        found = [("assign", *m.span(), None) for m in _ASSIGN.finditer(whole.lower()) if len(m[1]) >= ASSIGN_LEAST]
        found += [("access", *m.span(), None) for m in _ACCESS.finditer(whole)]
        found += [("hex", a, b, None) for a, b in _runs(self.hex[data], HEX_LEAST).tolist()]
        for kind, table, entropy in self.classes:
            found += self._entropic(whole, _runs(table[data], kind.width), kind.kind, entropy, found)
        out: list[list[tuple]] = [[] for _ in texts]
        if found:
            ends = np.cumsum([len(t) + 1 for t in texts])
            points = np.cumsum((data & 0xC0) != 0x80)
            points = np.concatenate([[0], points])
            for kind, a, b, bits in sorted(found, key=lambda s: (s[1], self.order[s[0]], s[2])):
                i = int(np.searchsorted(ends, a, side="right"))
                base = points[ends[i - 1]] if i else 0
                out[i].append((kind, int(points[a] - base), int(points[b] - base), bits))
        return out

    def _entropic(self, whole: bytes, runs: np.ndarray, kind: str, entropy: Entropy, before: list) -> list[tuple]:
        """Spans of one class, but for those that lie within a span found before."""
        if not len(runs):
            return []
        # Of spans sorted by start, the furthest stop so far tells whether one of them holds another.
        known = np.array(sorted((a, b) for _, a, b, _ in before), dtype=np.int64).reshape(-1, 2)
        furthest = np.maximum.accumulate(known[:, 1])
        found = []
        for a, b in runs.tolist():
            candidate = whole[a:b]
            if whole.endswith(ALLOWED_BEFORE, max(0, a - 8), a):
                continue
            spans = [(a + s, a + e, bits) for s, e, bits in entropy.spans(candidate)]
            if not spans or allowed(candidate, self.patterns):
                continue
            for s, e, bits in spans:
                at = int(np.searchsorted(known[:, 0], s, side="right"))
                if not at or furthest[at - 1] < e:
                    found.append((kind, s, e, bits))
        return found


_STRUCT = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("bits", pa.float64())])
)


def scan_secrets(
    docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """`doc_id, spans` of each row of `docs (doc_id, text)`: SPANS by start, then kind as listed.

    Kinds assign, access and hex are shapes, leftmost and not overlapping within a kind. Each class
    of `classes` adds the windows of its candidates whose entropy reaches its bits, joined where
    they overlap or touch, with the most bits of such a window. Suppressed are candidates that
    `allow` matches wholly, that read as words, paths or numbers, that run through an alphabet, or
    that follow the mark of a checksum or an embedded file; and spans within one found before, by a
    shape or an earlier class. Shapes are never suppressed. Places are code points, stop exclusive.

    A text null or empty has no spans; long ones are searched whole, alone. Null and repeated
    doc_ids are rows like others; extra columns are not read; an empty table gives an empty one.
    Each row is handled by itself: nothing is shuffled, and a hot source is as any other.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allow)
        for batch in batches:
            texts = ((t.as_py() or "").encode() for t in batch.column(1))
            spans = [s for group in groups(texts) for s in scanner(group)]
            listed = [[dict(zip(("kind", "start", "stop", "bits"), s)) for s in own] for own in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, _STRUCT)], names=["doc_id", "spans"])

    return rows.mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")
