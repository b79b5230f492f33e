"""Whitening of embeddings: exact centred covariance, leading eigenvectors, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, kept
from shelfmark.llm.symmetric import leading_eigenpairs

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries of greater size than this in x count as this.
LARGEST = float(1 << 60)
#: A component of at most this share of the trace is rounding: it has no scale to divide by.
FLAT = 1e-11

#: An exact integer total travels as three limbs of 48 bits, the highest with the sign.
LIMB = 48
TOTALS = "d int, place long, n long, high long, middle long, low long"


def integer_entries(table: DataFrame) -> DataFrame:
    """`vec_id, x`: floor(1024 c) + 100000 of each entry; null or not wholly finite vectors go."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    scaled = lambda c: F.greatest(F.least(F.floor(SCALE * c.cast("double")), F.lit(int(LARGEST))), F.lit(-int(LARGEST)))
    x = F.transform("embedding", lambda c: scaled(c) + F.lit(SHIFT).cast("long"))
    whole = table.where(F.col("embedding").isNotNull() & finite)
    return whole.select("vec_id", x.cast("array<bigint>").alias("x"))


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """`d, rows, x`: the vectors of each length in a batch, as a matrix, and their row numbers."""
    sizes = pc.list_value_length(column).to_numpy()
    values = column.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, values[starts[rows][:, None] + np.arange(d)]


class _Total:
    """A sum of integer arrays, of 64 bits while that is certain to hold it, else of any size."""

    def __init__(self) -> None:
        self.n, self.bound, self.sum = 0, 0, 0

    def add(self, part: np.ndarray, bound: int) -> None:
        """`bound` is no less than the size of any entry of `part`."""
        self.bound += bound
        if self.bound >= 1 << 62 and getattr(self.sum, "dtype", None) != object:
            self.sum = np.asarray(self.sum).astype(object)
        self.sum = self.sum + part

    def limbs(self) -> list[np.ndarray]:
        mask = (1 << LIMB) - 1
        middle = self.sum >> LIMB
        return [np.asarray(v).astype(np.int64) for v in (middle >> LIMB, middle & mask, self.sum & mask)]


def _totals(entries: DataFrame, per_task) -> dict[int, tuple[int, dict[int, int]]]:
    """By vector length: the number of vectors and the exact total at each place, summed by Spark."""
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "middle", "low")]
    rows = entries.mapInArrow(per_task, TOTALS).groupBy("d", "place").agg(*wide).toArrow()
    out: dict[int, tuple[int, dict[int, int]]] = {}
    for d, place, n, high, middle, low in zip(*[rows[c].to_pylist() for c in ("d", "place", "n", "high", "middle", "low")]):
        total = (int(high) << 2 * LIMB) + (int(middle) << LIMB) + int(low)
        out.setdefault(d, (int(n), {}))[1][place] = total
    return out


def _rows(d: int, places: np.ndarray, n: int, limbs: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.full(len(places), d, np.int32), places.astype(np.int64), np.full(len(places), n, np.int64), *limbs]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "place", "n", "high", "middle", "low"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, _Total] = {}
    for batch in batches:
        for d, _, x in _matrices(batch.column("x")):
            total = totals.setdefault(d, _Total())
            total.n += len(x)
            # Entries lie within 2**60 and batches hold far fewer rows than 2**62 over that, but for
            # the largest entries: those are added as integers of any size.
            top = int(np.abs(x).max())
            part = x.sum(axis=0) if top * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
            total.add(part, top * len(x))
    for d, total in totals.items():
        yield _rows(d, np.arange(d), total.n, total.limbs())


def _products(y: np.ndarray) -> tuple[np.ndarray, int]:
    """Exact Y'Y and a bound of its entries; through doubles where these hold every partial sum."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 1 << 53:
        real = y.astype(np.float64)
        return (real.T @ real).astype(np.int64), top * top * len(y)
    if top * top < 1 << 52:
        half = len(y) // 2
        (a, m), (b, n) = _products(y[:half]), _products(y[half:])
        return (a + b if m + n < 1 << 62 else a.astype(object) + b), m + n
    whole = y.astype(object)
    return whole.T @ whole, top * top * len(y)


def _centred_products(centers: dict[int, np.ndarray]):
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, _Total] = {}
        for batch in batches:
            for d, _, x in _matrices(batch.column("x")):
                total = totals.setdefault(d, _Total())
                total.n += len(x)
                total.add(*_products(x - centers[d]))
        for d, total in totals.items():
            limbs = total.limbs()
            for i in range(d):
                yield _rows(d, i * d + np.arange(i, d), total.n, [v[i, i:] for v in limbs])

    return per_task


@dataclass
class Fit:
    """Of the vectors of one length: x - S / n is y - rest / n, with y = x - center."""

    n: int
    center: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [max(0.0, float(e)) / self.trace if self.trace else None for e in self.values]

    @property
    def solid(self) -> np.ndarray:
        return self.values > FLAT * self.trace

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Null components hold NaN."""
        scale = np.where(self.solid, np.sqrt(np.where(self.solid, self.values, 1.0)), np.nan)
        return (y - self.rest.astype(np.float64) / self.n) @ (self.vectors / scale)

    def deviations(self, y: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)**2, exact; null beyond 38 digits."""
        top = self.n * int(np.abs(y).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if top * top * y.shape[1] < 1 << 62:
            off = self.n * y - self.rest.astype(np.int64)
            return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
        off = self.n * y.astype(object) - self.rest
        sums = (off * off).sum(axis=1)
        return pa.array([Decimal(s) if s < 10**38 else None for s in sums], pa.decimal128(38, 0))


def fit(entries: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of the vectors of each length.

    Two passes: exact sums, then exact products of entries centred at the nearest integer to their
    mean; what the rounding of that mean leaves is taken off as a fraction, so a covariance has one
    rounding. Integer totals do not depend on the order of tasks, so reruns agree. The driver holds
    a matrix for each length: the square of the length, whatever the number of vectors.
    """
    sums = _totals(entries, _sums)
    center, rest = {}, {}
    for d, (n, s) in sums.items():
        whole = [(2 * s[i] + n) // (2 * n) for i in range(d)]
        center[d] = np.array(whole, dtype=np.int64)
        rest[d] = np.array([s[i] - n * m for i, m in enumerate(whole)], dtype=object)
    products = _totals(entries, _centred_products(center)) if sums else {}
    fits = {}
    for d, (n, p) in products.items():
        r = rest[d]
        v = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                v[i, j] = v[j, i] = (n * p[i * d + j] - int(r[i]) * int(r[j])) / (n * n)
        values, vectors = leading_eigenpairs(v, components)
        fits[d] = Fit(n, center[d], r, values, vectors, float(np.trace(v)))
    return fits


def _projected(entries: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """`vec_id, d, deviation, whitened` of each vector; the fits go to the executors as one broadcast."""
    context = entries.sparkSession.sparkContext
    sent = context.broadcast(fits)
    kind = entries.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _matrices(batch.column("x")):
                own = sent.value[d]
                y = x - own.center
                w = own.whitened(y)
                offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)),
                        pa.array(np.full(len(rows), d, np.int32)),
                        own.deviations(y),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.reshape(-1), from_pandas=True)),
                    ],
                    names=["vec_id", "d", "deviation", "whitened"],
                )

    return entries.mapInArrow(
        project, f"vec_id {kind}, d int, deviation decimal(38,0), whitened array<double>"
    )


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the whitened entries of a task and of their products, by length and place."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        d = batch.column("d").to_numpy()
        k = pc.list_value_length(batch.column("whitened")).to_numpy()
        for one in np.unique(d):
            rows = np.flatnonzero(d == one)
            own = batch.column("whitened").take(pa.array(rows)).flatten()
            w = np.nan_to_num(own.to_numpy(zero_copy_only=False).reshape(len(rows), k[rows[0]]))
            part = np.vstack([w.sum(axis=0)[None], w.T @ w]).reshape(-1)
            sums[one] = sums.get(one, 0) + part
    for d, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(total), d, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
            names=["d", "place", "total"],
        )


def _identity_errors(projected: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """Largest entry of the covariance of what was written, less the identity, by length."""
    totals = projected.select("d", "whitened").mapInArrow(_moments, "d int, place int, total double")
    found: dict[int, dict[int, float]] = {}
    for r in totals.groupBy("d", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(r["d"], {})[r["place"]] = r["total"]
    errors: dict[int, float | None] = {}
    for d, own in fits.items():
        k = len(own.values)
        table = np.array([found[d][i] for i in range(k + k * k)]).reshape(k + 1, k) / own.n
        off = table[1:] - np.outer(table[0], table[0]) - np.eye(k)
        solid = np.flatnonzero(own.solid)
        errors[d] = float(np.abs(off[np.ix_(solid, solid)]).max()) if len(solid) else None
    return errors


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error` of `table (vec_id, embedding)`.

    One row per remaining vector and component, up to `components` or the vectors' length. Vectors
    null or with null or non-finite entries go; empty ones have no component and so no row. Entries
    x saturate at 2**60. Vectors of another length are a fit list of their own: `n`, components and
    `identity_error` are those of the length. A component whose variance is at most FLAT of the
    trace (equal vectors, fewer vectors than components, constant dimensions) has null `whitened`
    and does not count in `identity_error`, which is null if all are so; `explained` is null where
    the trace is zero. `deviation` is decimal(38,0), null where it needs more digits. Null and
    repeated vec_ids are rows like others; extra columns are not read; an empty table gives an empty
    one. Tasks hold a batch and a matrix per length; the projected table is written once, and the
    identity error is taken from it.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    entries = kept(integer_entries(table), "entries")
    fits = fit(entries, components)
    projected = kept(_projected(entries, fits), "whitened")
    errors = _identity_errors(projected, fits) if fits else {}
    facts = [(d, own.n, own.explained, errors[d]) for d, own in fits.items()]
    # One row per vector length.
    small = spark.createDataFrame(facts, "d int, n long, parts array<double>, identity_error double")
    long = projected.select("vec_id", "d", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.join(F.broadcast(small), "d").select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at("parts", F.col("at") + 1).alias("explained"),
        "identity_error",
    )
