"""Exact top-k search by inner product with MaxScore bounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import kept, shared_folder

#: Queries that travel to the tasks at once.
QUERY_BLOCK = 4096
#: Vectors scored at once; small at first, as a threshold is still missing.
CHUNKS = (64, 256, 1024, 2048)
#: Non-essential terms probed between two checks of a candidate's bound.
PROBE = 8

#: Share of all pairs of a chunk above which non-essential terms are not probed pair by pair.
DENSE = 0.01
#: Vectors whose scores give a query its first threshold, so that no task starts without one.
PROBES = 2048

HITS = "query_row long, query_id long, vec_id long, row long, score long"


def integer_vectors(table: DataFrame) -> DataFrame:
    """`row, vec_id, v`: floor(256 x) of each component, as far as 64 bits go, and a number for the row.

    Vectors null, or holding null or non-finite components, go; all others stay, also those that
    share a vec_id or have none.
    """
    x = F.transform("embedding", lambda c: F.floor(256 * c.cast("double")))
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    good = table.where(F.col("embedding").isNotNull() & finite)
    return good.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        x.cast("array<bigint>").alias("v"),
    )


class Shard:
    """Best hits of a block of queries over the vectors a task sees.

    A term is a component; a query's score is the sum over terms of its weight times the vector's
    value. Over a chunk the value of a term lies between a least and a greatest one, so the term
    adds between `low` and `low + gain`. Terms of least gain are non-essential while their gains
    together cannot lift a vector from the lows to the query's threshold.
    """

    def __init__(self, rows, vectors, k: int, floor) -> None:
        """`floor`: a score that each query's k-th best is known to reach."""
        import numpy as np

        self.rows, self.q, self.k = rows, vectors, k
        self.scores = np.empty((0, 4), dtype=np.int64)
        self.floor = floor.copy()

    def add(self, rows, ties, x) -> None:
        """Score the vectors `x` of some `rows`, of which equal ones go by `ties`."""
        import numpy as np

        ends = np.stack([x.min(axis=0), x.max(axis=0)])
        # Queries that no vector between the ends can help are done with this chunk.
        reach = np.maximum(self.q * ends[0], self.q * ends[1]).sum(axis=1)
        active = np.flatnonzero(reach >= self.floor)
        if len(active):
            self._score(active, rows, ties, x)

    def _score(self, active, rows, ties, x) -> None:
        import numpy as np

        q, floor = self.q[active], self.floor[active]
        a, b = q * x.min(axis=0), q * x.max(axis=0)
        low, gain = np.minimum(a, b), np.abs(b - a)
        order = np.argsort(gain, axis=1, kind="stable")
        total = np.cumsum(np.take_along_axis(gain, order, 1), axis=1)
        need = floor - low.sum(axis=1)
        # A vector on the threshold may still win by its smaller id: only what stays below is dropped.
        sorted_rest = total < need[:, None]
        rest = np.zeros_like(sorted_rest)
        np.put_along_axis(rest, order, sorted_rest, axis=1)
        slack = np.where(rest, gain, 0).sum(axis=1)
        base = np.where(rest, low, 0).sum(axis=1)
        # Essential terms of all vectors, then the others for those that can still reach it.
        part = _product(np.where(rest, 0, q), x) + base[:, None]
        qi, vi = np.nonzero(part + slack[:, None] >= floor[:, None])
        if len(qi) > DENSE * part.size:
            # So many compete that the other terms cost less as one product, too.
            part += _product(np.where(rest, q, 0), x) - base[:, None]
            qi, vi = np.nonzero(part >= floor[:, None])
            self._merge_hits(active[qi], vi, part[qi, vi], rows, ties)
            return
        score = part[qi, vi]
        left = slack[qi]
        most = int(sorted_rest.sum(axis=1).max(initial=0))
        for end in range(most, 0, -PROBE):
            terms = order[:, max(0, end - PROBE) : end]
            probed = np.take_along_axis(rest, terms, 1)
            w = np.where(probed, np.take_along_axis(q, terms, 1), 0)
            g = np.where(probed, np.take_along_axis(gain, terms, 1), 0).sum(axis=1)
            lo = np.where(probed, np.take_along_axis(low, terms, 1), 0).sum(axis=1)
            score = score + (w[qi] * x[vi[:, None], terms[qi]]).sum(axis=1) - lo[qi]
            left = left - g[qi]
            on = score + left >= floor[qi]
            qi, vi, score, left = qi[on], vi[on], score[on], left[on]
        self._merge_hits(active[qi], vi, score, rows, ties)

    def _merge_hits(self, qi, vi, score, rows, ties) -> None:
        import numpy as np

        other = self.rows[qi] != rows[vi]
        qi, vi, score = qi[other], vi[other], score[other]
        new = np.stack([qi, ties[vi], score.astype(np.int64), rows[vi]], axis=1)
        self._merge(new)

    def _merge(self, new) -> None:
        import numpy as np

        rows = np.concatenate([self.scores, new])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 1], -rows[:, 2], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - first
        self.scores = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.floor[last[:, 0]] = np.maximum(self.floor[last[:, 0]], last[:, 2])


def _product(q, x):
    return q @ x.T


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """`query_id, rank, vec_id, score`: each query's `k` best among the other vectors.

    Both tables are `row, vec_id, v`, `row` a number of its own for each; each row of `queries` is a
    query, and candidates are all rows of `vectors` but its own. Queries go to the vectors in blocks of
    about QUERY_BLOCK, which bounds what is sent at once; a task keeps `k` hits per query and the
    hits of all tasks are merged by query. Each block's hits are written before the next block
    starts. Ties go to the smaller vec_id, null last; fewer vectors give fewer ranks; vectors of another
    length than the query's are no candidates. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    sizes = queries.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()
    folder = shared_folder(spark, "top-k")
    spark.createDataFrame([], HITS).write.parquet(folder)
    for size in sizes:
        blocks = -(-size["n"] // QUERY_BLOCK)
        own = queries.where(F.size("v") == size["d"])
        fit = vectors.where(F.size("v") == size["d"])
        # Any vectors do: their scores only tell how good a hit must be at least.
        probes = fit.limit(PROBES).collect()
        for block in range(blocks):
            rows = own.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()
            if not rows:
                continue
            hits = _block_hits(fit, rows, k, probes)
            hits.write.mode("append").parquet(folder)
    hits = spark.read.schema(HITS).parquet(folder)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The tie of a vector without an id.
_NAMELESS = (1 << 63) - 1


def _floor(own, weights, k: int, probes: list):
    """The k-th best score of each query among `probes`, less what rounding could add."""
    import numpy as np

    x = np.array([r["v"] for r in probes], dtype=np.float64).reshape(len(probes), -1)
    score = weights.astype(np.float64) @ x.T
    score[own[:, None] == np.array([r["row"] for r in probes])] = -np.inf
    if len(probes) < k:
        return np.full(len(own), -np.inf)
    size = np.abs(weights).sum(axis=1) * np.abs(x).max(initial=0.0)
    return np.partition(score, len(probes) - k, axis=1)[:, len(probes) - k] - 1e-9 * size - 1


def _block_hits(vectors: DataFrame, queries: list, k: int, probes: list) -> DataFrame:
    import numpy as np

    own = np.array([r["row"] for r in queries], dtype=np.int64)
    ids = np.array([r["vec_id"] for r in queries], dtype=np.int64)
    weights = np.array([r["v"] for r in queries], dtype=np.int64).reshape(len(queries), -1)
    floor = _floor(own, weights, k, probes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        shard, chunk = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).to_numpy()
            ties = batch.column(1).fill_null(_NAMELESS).to_numpy()
            values = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            # Sums of products stay exact in doubles below 2**53, and BLAS is used only there.
            top = float(np.abs(values).max(initial=0)) * float(np.abs(weights).max(initial=0))
            kind = np.float64 if top * max(1, values.shape[1]) < 2**52 else np.int64
            if shard is None:
                shard = Shard(own, weights.astype(kind), k, floor)
            elif kind is np.int64:
                shard.q = weights
            at = 0
            while at < len(rows):
                n = CHUNKS[min(chunk, len(CHUNKS) - 1)]
                shard.add(rows[at : at + n], ties[at : at + n], values[at : at + n].astype(shard.q.dtype))
                at, chunk = at + n, chunk + 1
        if shard is not None and len(shard.scores):
            hits = shard.scores
            vec_ids = pa.array(hits[:, 1], mask=hits[:, 1] == _NAMELESS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[hits[:, 0]]), pa.array(ids[hits[:, 0]]), vec_ids, pa.array(hits[:, 3]), pa.array(hits[:, 2])],
                names=["query_row", "query_id", "vec_id", "row", "score"],
            )

    return vectors.select("row", "vec_id", "v").mapInArrow(search, HITS)


def search_embeddings(table: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """`top_k` of the vectors whose vec_id is divisible by `every`, against all of `table`.

    See `integer_vectors` for null and non-finite vectors, `top_k` for repeated ids and the rest.
    Extra columns are not read. Scores of over 64 bits are not defined.
    """
    vectors = kept(integer_vectors(table), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
