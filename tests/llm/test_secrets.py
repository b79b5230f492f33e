"""Secret scans against plain expressions on strings and entropies counted window by window."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest

from shelfmark.llm.queries import QUERIES
from shelfmark.llm.secrets import ALLOWED, CLASSES, Entropy, Scanner, allowed, scan_secrets

BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 16),
    ("hex", re.compile("[0-9a-f]+"), 32),
)


def base_by_hand(text):
    out = []
    for i, (kind, pattern, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), i, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def windows_by_hand(text):
    """Spans of the method in a text, entropy of each window counted anew."""
    found = base_by_hand(text)
    patterns = [re.compile(p) for p in ALLOWED]
    for c in CLASSES:
        letters = re.escape(c.letters.decode())
        known = list(found)
        for m in re.finditer(f"[{letters}]{{{c.width},}}", text):
            run = m[0]
            if re.search("(sha256-|sha384-|sha512-|;base64,)$", text[: m.start()]) or allowed(run.encode(), patterns):
                continue
            spans = []
            for i in range(len(run) - c.width + 1):
                counts = Counter(run[i : i + c.width]).values()
                if -sum(n / c.width * math.log2(n / c.width) for n in counts) >= c.bits - 1e-12:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + c.width
                    else:
                        spans.append([i, i + c.width])
            for a, b in spans:
                a, b = a + m.start(), b + m.start()
                if not any(x <= a and b <= y for _, x, y in known):
                    found.append((c.kind, a, b))
    kinds = ["assign", "access", "hex", *(c.kind for c in CLASSES)]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def random_text(rng):
    letters = [string.ascii_letters + string.digits, "0123456789abcdef", "0123456789ABCDEF", "AKIA01",
               string.ascii_letters + string.digits + "+/", string.ascii_lowercase + "-_", "ab"]
    keys = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "APIKEY", "tokentoken", "paſſword", "toKen"]
    parts = []
    for _ in range(rng.randint(0, 12)):
        value = "".join(rng.choices(rng.choice(letters), k=rng.randint(1, 70)))
        glue = rng.choice(["=", ":", " = ", '": "', "' =\t", ": '", "  :  ", "==", " "])
        parts.append(rng.choice([value, f"{rng.choice(keys)}{glue}{value}", "é" * rng.randint(1, 3), "AKIA" + value.upper(),
                                 "sha256-" + value, "data:x;base64," + value]))
        parts.append(rng.choice([" ", "\n", "", ".", "/"]))
    return "".join(parts)


def test_spans_by_hand():
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(1500)]
    got = Scanner(CLASSES, ALLOWED)([t.encode() for t in texts])
    kinds = Counter()
    for text, spans in zip(texts, got):
        assert [s[:3] for s in spans] == windows_by_hand(text), text
        kinds.update(s[0] for s in spans)
    assert min(kinds[k] for k in ("assign", "access", "hex", *(c.kind for c in CLASSES))) > 20


def test_a_failing_match_uses_up_its_text():
    assert base_by_hand("token=token:abcdefgh") == []
    assert Scanner(CLASSES, ALLOWED)([b"token=token:abcdefgh"]) == [[]]
    assert Scanner(CLASSES, ALLOWED)([b"password", b"= abcdefgh1", b""]) == [[], [], []]


def test_entropy_is_exact_along_a_long_string():
    rng = random.Random(6)
    text = "".join(rng.choices("0123456789abcdef", k=20_000)).encode()
    entropy = Entropy(32, 0.0)
    assert [s[:2] for s in entropy.spans(text)] == [(0, 20_000)]
    # Four of each of eight letters: exactly three bits, which counts.
    even = b"01234567" * 4
    assert [s for s in Entropy(32, 3.0).spans(even + b"0" * 40)][0][0] == 0
    assert list(Entropy(32, 3.0 + 1e-6).spans(even)) == []
    least = min(
        sum(n * math.log2(n) for n in Counter(text[i : i + 32]).values()) for i in range(len(text) - 31)
    )
    assert next(entropy.spans(text))[2] == pytest.approx(5 - least / 32, abs=1e-8)


@pytest.mark.parametrize(
    "clean",
    ["internationalisation_of_the_telecommunications", "/articles/politics/2021/12/07/elections-results-summary",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "123e4567-e89b-12d3-a456-426614174000",
     "1234567890123456789012345678901234567890", "integrity sha384-oqVuAfXRKap7fdgcCY5uykM6R9GqQ8Kux5nZ0Xa7Wl1c",
     "E3B0C44298FC1C149AFBF4C8996FB92427AE41E4649B934CA495991B7852B855", "getElementByIdentifierAndReturnValue2Times",
     "-" * 200, "x" * 5000, "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"],
)
def test_clean_strings_stay_clean(clean):
    assert [s for s in Scanner(CLASSES, ALLOWED)([clean.encode()])[0] if s[0].startswith("entropy")] == []


def test_random_strings_are_found():
    rng = random.Random(7)
    for letters, least in ((string.ascii_letters + string.digits, 0.99), (string.ascii_lowercase + string.digits, 0.95),
                           ("0123456789ABCDEF", 0.95), (string.ascii_letters + string.digits + "-_", 0.97)):
        texts = [("key " + "".join(rng.choices(letters, k=40)) + " end").encode() for _ in range(500)]
        assert sum(bool(s) for s in Scanner(CLASSES, ALLOWED)(texts)) >= least * 500


COLUMNS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def expected_row(doc_id, text):
    text = text or ""
    base = base_by_hand(text)
    counts = Counter(k for k, _, _ in base)
    listed = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    digest = hashlib.sha256(listed(base).encode()).hexdigest()
    return (doc_id, counts["assign"], counts["access"], counts["hex"], digest, listed(windows_by_hand(text)))


def test_query_by_hand(spark, sf_dir, documents):
    df = QUERIES["op12_secret_scan"](spark, sf_dir.replace("sf0.001", "sf0.01"))
    assert tuple(df.columns) == COLUMNS and dict(df.dtypes)["n_hex"] == "bigint"
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text")
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected_row(*r) for r in docs.collect())


def test_odd_rows(spark, odd, nothing):
    long = "é " + "word " * 100_000 + "A1b2C3d4E5f6G7h8I9j0K1l2M3n4 " + "9f" * 40_000
    more = odd.select("doc_id", "text").union(spark.createDataFrame([(20, long), (20, long)], "doc_id long, text string"))
    found = scan_secrets(more.selectExpr("*", "text AS spans", "1 AS bits")).collect()
    got = Counter((r["doc_id"], tuple((s["kind"], s["start"], s["stop"]) for s in r["spans"])) for r in found)
    assert got == Counter((r["doc_id"], tuple(windows_by_hand(r["text"] or ""))) for r in more.collect())
    assert scan_secrets(nothing).count() == 0
