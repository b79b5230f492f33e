"""Whitening against numpy's eigenvectors and exact integers."""

import math
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm.queries import QUERIES
from shelfmark.llm.symmetric import leading_eigenpairs, leading_eigenvalues, tridiagonal
from shelfmark.llm.whitening import _products, whiten


def matrices():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 5, 64):
        x = rng.normal(size=(n + 5, n))
        yield x.T @ x
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    yield np.eye(10) * 3
    yield np.zeros((5, 5))
    yield np.ones((20, 20)) * 1e200
    yield np.diag([5, 5, 5, 4, 4, 1, 1, 1, 1, 0.0])
    yield q @ np.diag([10.0] * 5 + [9.99999] * 5 + [1e-6] * 30) @ q.T
    yield q @ np.diag(np.logspace(0, -15, 40)) @ q.T
    yield np.kron(np.eye(3), np.ones((4, 4)))
    yield np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)


@pytest.mark.parametrize("matrix", list(matrices()))
def test_leading_eigenpairs(matrix):
    values, vectors = leading_eigenpairs(matrix, 8)
    k = min(8, len(matrix))
    size = max(np.abs(matrix).max() * len(matrix), 1e-300)
    assert vectors.shape == (len(matrix), k)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() < 1e-14 * size
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_all_eigenvalues_of_the_tridiagonal_form():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    diagonal, off, _ = tridiagonal(a)
    assert np.allclose(leading_eigenvalues(diagonal, off, 30), np.linalg.eigvalsh(a)[::-1], atol=1e-12)


def test_products_of_any_size_are_exact():
    rng = np.random.default_rng(2)
    for top in (10, 10**6, 10**9, 1 << 60):
        y = rng.integers(-top, top, size=(50, 4))
        part, bound = _products(y)
        exact = y.astype(object).T @ y.astype(object)
        assert (part == exact).all() and abs(exact).max() <= bound


def by_hand(rows, components=8):
    """`{(vec_id, component): (n, deviation, |whitened|, explained)}` with numpy, by vector length."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = Counter()
    for d in {len(v) for _, v in good} - {0}:
        own = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in good if len(v) == d]
        n = len(own)
        s = [sum(x[j] for _, x in own) for j in range(d)]
        z = np.array([[(n * x[j] - s[j]) / n for j in range(d)] for _, x in own])
        values, vectors = np.linalg.eigh(z.T @ z / n)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        trace = (z * z).sum() / n
        for (i, x), row in zip(own, z):
            deviation = sum((n * x[j] - s[j]) ** 2 for j in range(d))
            for k, e in enumerate(values):
                w = abs(row @ vectors[:, k]) / math.sqrt(e) if e > 1e-11 * trace else None
                share = round(e / trace, 9) if trace else None
                out[i, k + 1, n, deviation, None if w is None else round(w, 7), share] += 1
    return out


def found(table):
    rows = whiten(table).collect()
    return rows, Counter(
        (r["vec_id"], r["component"], r["n"], int(r["deviation"]),
         None if r["whitened"] is None else round(abs(r["whitened"]), 7),
         None if r["explained"] is None else round(r["explained"], 9))
        for r in rows
    )


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=11) * np.arange(1, 12)]) for i in range(300)]
    rows += [rows[7], (None, rows[8][1]), (400, None), (401, [None] * 11), (402, [float("nan")] * 11),
             (403, [float("inf")] * 11), (404, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, counted = found(table)
    assert counted == by_hand(rows)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    again, _ = found(table)
    assert Counter(again) == Counter(got)


def test_lengths_apart_and_flat_components(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)] + [(50 + i, [1e6 * (i % 3), 3e6 * (i // 3)]) for i in range(9)]
    rows += [(90, [1.0])]
    schema = "vec_id long, embedding array<float>, n string, component string, whitened string, d int"
    table = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], schema)
    got, counted = found(table)
    expected = by_hand(rows)
    pairs = {k[:2] for k in expected}
    assert pairs == {k[:2] for k in counted}
    by_key = {(r["vec_id"], r["component"]): r for r in got}
    assert by_key[90, 1]["whitened"] is None and by_key[90, 1]["explained"] is None and by_key[90, 1]["deviation"] == 0
    assert by_key[90, 1]["identity_error"] is None
    assert by_key[3, 2]["whitened"] is None and by_key[3, 1]["whitened"] is not None
    assert {k for k in counted if k[0] >= 50} == {k for k in expected if k[0] >= 50 and k[4] is not None} | {
        k for k in counted if k[0] == 90
    }
    assert whiten(table.where("false")).count() == 0


def test_huge_entries(spark):
    rows = [(i, [1e15 * i, -3e14 * i * i, float(i)]) for i in range(6)] + [(9, [1e30, 0.0, 0.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 21 and max(r["identity_error"] for r in got) < 1e-4
    x = [[min(max(math.floor(1024 * c), -(1 << 60)), 1 << 60) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    exact = {i: sum((7 * a - b) ** 2 for a, b in zip(v, s)) for (i, _), v in zip(rows, x)}
    assert {r["vec_id"]: r["deviation"] and int(r["deviation"]) for r in got} == {i: e if e < 10**38 else None for i, e in exact.items()}


def test_query_over_embeddings(spark, sf_dir):
    df = QUERIES["op11_embedding_whitening"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = by_hand([(r["vec_id"], r["embedding"]) for r in table.collect()])
    rows = df.collect()
    mine = Counter(
        (r["vec_id"], r["component"], r["n"], r["deviation"], round(abs(r["whitened"]), 7), round(r["explained"], 9))
        for r in rows
    )
    assert sum((mine - expected).values()) <= 2 and len(rows) == sum(expected.values())
    assert rows[0]["identity_error"] < 1e-9
