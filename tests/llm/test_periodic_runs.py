"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm.ntt import PRIMES, zero_mismatches
from shelfmark.llm.periodic_runs import _Prefixes, detect_runs, find_runs, looped
from shelfmark.llm.queries import QUERIES


def runs_by_hand(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                s = i
                while i + q < n and words[i] == words[i + q]:
                    i += 1
                if i + q - s >= max(24, 3 * q):
                    found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def repetitive(rng, most=300):
    n, k, words = rng.randint(0, most), rng.choice([1, 2, 3, 5, 50]), []
    while len(words) < n:
        if rng.random() < 0.5:
            unit = [rng.randrange(k) for _ in range(rng.randint(1, rng.choice([2, 8, 40, 70])))]
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 300)]
        else:
            words += [rng.randrange(k) for _ in range(rng.randint(1, 30))]
    return words[:n]


def test_runs_by_hand():
    rng = random.Random(1)
    for _ in range(400):
        x = repetitive(rng)
        assert [tuple(r) for r in find_runs(np.array(x, dtype=np.int64), len(x) // 3).tolist()] == runs_by_hand(x)


def test_runs_at_the_edges_of_scales():
    """Each period about a power of two, just long enough and one word too short, at any place."""
    rng = random.Random(2)
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 127, 128):
        for before in (0, 1, rng.randrange(300)):
            unit = [1000 + i for i in range(q)]
            for length in (max(24, 3 * q), max(24, 3 * q) - 1):
                x = list(range(5000, 5000 + before)) + (unit * (length // q + 1))[:length] + [1, 2, 3]
                expected = [(before, length, q)] if length >= max(24, 3 * q) else []
                assert [tuple(r) for r in find_runs(np.array(x), len(x) // 3).tolist()] == expected


def test_hashes_that_collide_change_nothing(monkeypatch):
    """All prefixes look equal: stretches come out too long and are cut where words differ."""
    rng = random.Random(3)
    xs = [repetitive(rng, 120) for _ in range(60)]
    monkeypatch.setattr(_Prefixes, "same", lambda self, a, b, length: np.ones(np.shape(a), dtype=bool))
    for x in xs:
        got = {tuple(r) for r in find_runs(np.array(x, dtype=np.int64), len(x) // 3).tolist()}
        assert set(runs_by_hand(x)) <= got


def test_zero_mismatches_are_exact():
    rng = np.random.default_rng(4)
    for b, w in ((8, 22), (16, 31), (64, 127)):
        for top in (2, 50, 10**6):
            x, t = rng.integers(0, top, (40, b)), rng.integers(0, top, (40, w))
            for i in range(0, 40, 2):
                at = int(rng.integers(0, w - b + 1))
                t[i, at : at + b] = x[i]
            row, shift = zero_mismatches(x, t)
            expected = {(i, k) for i in range(40) for k in range(w - b + 1) if (x[i] == t[i, k : k + b]).all()}
            assert set(zip(row.tolist(), shift.tolist())) == expected
    one, two = PRIMES[0][0], PRIMES[1][0]
    x, t = np.zeros((1, 1), dtype=np.int64), np.array([[0, one, two, 5]])
    assert zero_mismatches(x, t)[1].tolist() == [0]


@pytest.mark.parametrize(
    "x",
    [[0] * 60_000, list(range(500)) * 120, [bin(i).count("1") % 2 for i in range(60_000)],
     (([0] * 3000 + [1]) * 30)[:60_000]],
)
def test_long_repetitive_texts(x):
    runs = find_runs(np.array(x), len(x) // 3)
    for s, length, q in runs.tolist():
        assert x[s : s + length - q] == x[s + q : s + length]
        assert s == 0 or x[s - 1] != x[s - 1 + q]
        assert s + length == len(x) or x[s + length] != x[s + length - q]
    assert len(runs) == (0 if x[:4] == [0, 1, 1, 0] else 1 if len(set(x)) != 2 else 21)


def expected_rows(rows):
    out = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        n = len(words)
        if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
            g = zlib.crc32(str(doc_id).encode()) // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_hand(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        out[doc_id, len(runs), *best, milli, hashlib.sha256(listing).hexdigest(), hashlib.sha256(kept).hexdigest()] += 1
    return out


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_by_hand(spark, sf_dir, documents):
    df = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert tuple(df.columns) == COLUMNS
    short = documents.where(F.length("text") < 30_000).select("doc_id", "text").collect()
    ids = {r["doc_id"] for r in short}
    got = Counter(tuple(r) for r in df.collect() if r["doc_id"] in ids)
    assert got == expected_rows([tuple(r) for r in short])
    assert sum(1 for r in got if r[1]) > 5


def test_odd_rows(spark, odd, nothing):
    found = detect_runs(odd, loop=True)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 30_000]
    listing = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period)))
    digests = found.withColumns({"runs_sha256": F.sha2(listing, 256), "collapsed_sha256": F.sha2("collapsed", 256)})
    got = Counter(tuple(r) for r in digests.select(*COLUMNS).collect() if r["doc_id"] != 7)
    assert got == expected_rows(rows)
    long = found.where("doc_id = 7").first()
    assert (long["n_words"], long["n_runs"], long["start"], long["length"], long["period"]) == (30_000, 1, 0, 30_000, 1)
    assert long["collapsed"] == "one" and long["exponent_milli"] == 30_000_000
    assert detect_runs(nothing).count() == 0
    assert looped([], 0) == [] and looped([b"a"], None) == [b"a"]
    plain = spark.createDataFrame([("x", "a b " * 20)], "doc_id string, text string")
    assert detect_runs(plain).first()["collapsed"] == "a b"
