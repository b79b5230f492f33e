"""Quality classifier: gated attention over the passages of a document."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, kept

PASSAGE_WORDS = 64
#: Labelled documents of each class to fit on, at most, and passages of all of them together.
FIT_DOCS = 3000
FIT_PASSAGES = 200_000
#: Longer documents, in passages, are scored but not fitted on.
FIT_LONGEST = 4_000
EPOCHS = 60
HIDDEN, GATES = 16, 8
THRESHOLD = 0.3

#: Classes of bytes: lower and upper case, digits, stops, other punctuation, symbols, beyond ASCII.
_KINDS = 8
_KIND = np.full(256, 7, dtype=np.int64)
for _kind, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b".,;:",
        b"!?",
        b"'\"()-/[]_",
        b"#*$%&|<>@\\^~+={}`",
    )
):
    _KIND[list(_bytes)] = _kind
FEATURES = _KINDS + 7


def encode(texts: list[bytes]) -> list[np.ndarray]:
    """A row of FEATURES per passage of PASSAGE_WORDS words; a text without words has one of zeros.

    Shares of byte classes, length of words and its spread, how many words, pairs and triples of
    the passage are distinct, and how many triples the text has more than once.
    """
    from shelfmark.llm.words import Words, mix64

    words = Words(texts)
    out = []
    kinds = _KIND[words.data]
    three = np.uint64(3)
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
        n = int(b - a)
        if not n:
            out.append(np.zeros((1, FEATURES), dtype=np.float32))
            continue
        cuts = np.arange(0, n, PASSAGE_WORDS)
        sizes = np.diff(np.append(cuts, n)).astype(np.float64)
        passage = np.arange(n) // PASSAGE_WORDS
        p = len(cuts)
        lengths = words.lengths[a:b].astype(np.float64)
        chars = np.add.reduceat(lengths, cuts)
        squares = np.add.reduceat(lengths * lengths, cuts)
        start, stop = words.starts[a], words.ends[b - 1]
        edges = words.starts[a:b][cuts]
        owner = np.searchsorted(edges, np.arange(start, stop), side="right") - 1
        white = np.isin(words.data[start:stop], (0x20, 9, 10, 11, 12, 13))
        counts = np.bincount(
            owner[~white] * _KINDS + kinds[start:stop][~white], minlength=p * _KINDS
        ).reshape(p, _KINDS)
        h = words.hashes[a:b]
        columns = [counts / chars[:, None]]
        for k in (1, 2, 3):
            run = h[: n - k + 1].copy()
            for j in range(1, k):
                run = mix64(run * three + h[j : n - k + 1 + j])
            of = passage[: len(run)]
            if len(run):
                own = np.unique(mix64(run) ^ mix64(of.astype(np.uint64)), return_index=True)[1]
                distinct = np.bincount(of[own], minlength=p)
                total = np.maximum(np.bincount(of, minlength=p), 1)
                columns.append((distinct / total)[:, None])
            else:
                columns.append(np.ones((p, 1)))
        if len(run):
            _, where, times = np.unique(run, return_inverse=True, return_counts=True)
            again = np.bincount(of, weights=times[where] > 1, minlength=p) / total
        else:
            again = np.zeros(p)
        mean = chars / sizes
        spread = np.sqrt(np.maximum(squares / sizes - mean**2, 0))
        columns += [again[:, None], (mean / 10)[:, None], (spread / 10)[:, None], (sizes / PASSAGE_WORDS)[:, None]]
        out.append(np.hstack(columns).astype(np.float32))
    return out


def encoded(texts: pa.Array) -> list[np.ndarray]:
    from shelfmark.llm.words import groups

    whole = [(t.as_py() or "").encode() for t in texts]
    return [x for group in groups(whole) for x in encode(group)]


@dataclass
class AttentionModel:
    """p = s(c.z + d), z the mean of passage codes h = tanh(W f + b) under gated attention.

    A passage's weight is the softmax over its document of w.(tanh(V h) * s(U h)).
    """

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        p = self.parts
        f = (x - self.mean) / self.scale
        h = np.tanh(f @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        g = v * u
        s = g @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        score = _sigmoid(z @ p["c"] + p["d"])
        return score, {"f": f, "h": h, "v": v, "u": u, "g": g, "a": a, "z": z, "sizes": sizes}

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        if not documents:
            return np.empty(0)
        sizes = [len(d) for d in documents]
        starts = np.cumsum([0, *sizes[:-1]])
        return self.forward(np.concatenate(documents).astype(np.float64), starts)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(documents: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> AttentionModel:
    """Learn the model by Adam on the log loss of the documents; same input, same model."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(documents).astype(np.float64)
    model = AttentionModel(
        every.mean(axis=0),
        every.std(axis=0) + 1e-3,
        {
            "W": rng.normal(0, 0.3, (FEATURES, HIDDEN)),
            "b": np.zeros(HIDDEN),
            "V": rng.normal(0, 0.3, (HIDDEN, GATES)),
            "U": rng.normal(0, 0.3, (HIDDEN, GATES)),
            "w": rng.normal(0, 0.3, GATES),
            "c": rng.normal(0, 0.3, HIDDEN),
            "d": np.zeros(()),
        },
    )
    p = model.parts
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    batch = 256
    for _ in range(EPOCHS):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            x = np.concatenate([documents[i] for i in chosen]).astype(np.float64)
            starts = np.cumsum([0, *[len(documents[i]) for i in chosen[:-1]]])
            score, m = model.forward(x, starts)
            gradient = _gradient(p, m, (score - labels[chosen]) / len(chosen), starts)
            step += 1
            for k in p:
                gk = gradient[k] + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * gk
                second[k] = 0.999 * second[k] + 0.001 * gk * gk
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[k] = p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def _gradient(p: dict, m: dict, off: np.ndarray, starts: np.ndarray) -> dict:
    """Gradients of the log loss; `off` is the score minus the label, by document."""
    sizes = m["sizes"]
    dz = np.repeat(off[:, None] * p["c"], sizes, axis=0)
    da = (dz * m["h"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(m["a"] * da, starts), sizes)
    ds = m["a"] * (da - mean)
    dg = ds[:, None] * p["w"]
    dv = dg * m["u"] * (1 - m["v"] ** 2)
    du = dg * m["v"] * m["u"] * (1 - m["u"])
    dh = m["a"][:, None] * dz + dv @ p["V"].T + du @ p["U"].T
    df = dh * (1 - m["h"] ** 2)
    return {
        "W": m["f"].T @ df,
        "b": df.sum(axis=0),
        "V": m["h"].T @ dv,
        "U": m["h"].T @ du,
        "w": m["g"].T @ ds,
        "c": m["z"].T @ off,
        "d": off.sum(),
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> AttentionModel | float:
    """Fit on at most `fit_docs` documents of each class, chosen by a hash of the doc_id.

    Held-out rows are never read. Labels null or other than 0 and 1 are left out; of several labels
    of one document the least counts. The sample is sent to find its documents, whose passages come
    to the driver: FIT_PASSAGES of FEATURES numbers at most. Documents of over FIT_LONGEST passages
    are left out of the fit, and those for which the others leave no room.
    Where a class is missing there is nothing to learn: the share of label 1, as a constant.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    draw = F.xxhash64("doc_id")
    sample = [
        r
        for q in (0, 1)
        for r in usable.where(F.col("quality") == q).orderBy(draw, "doc_id").limit(fit_docs).collect()
    ]
    if not sample:
        return 0.5
    spark = docs.sparkSession
    chosen = spark.createDataFrame(sample, "doc_id long, quality int")

    def passages(texts: pa.Array) -> pa.Array:
        return pa.array(
            [x.tobytes() if len(x) <= FIT_LONGEST else None for x in encoded(texts)], pa.binary()
        )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Written before it is encoded: nothing can move the encoding below the join, over all texts.
    found = kept(texts.join(F.broadcast(chosen), "doc_id"), "fit-sample")
    coded = found.select("doc_id", "quality", F.arrow_udf(passages, "binary")("text").alias("x"))
    rows = coded.orderBy(F.xxhash64("doc_id"), F.xxhash64("x")).limit(2 * fit_docs).collect()
    documents, marks, room = [], [], FIT_PASSAGES
    for r in rows:
        if r["x"] is None:
            continue
        x = np.frombuffer(r["x"], dtype=np.float32).reshape(-1, FEATURES)
        if len(x) <= room:
            documents.append(x)
            marks.append(r["quality"])
            room -= len(x)
    marks = np.array(marks, dtype=np.float64)
    if not len(marks) or marks.min() == marks.max():
        return float(marks.mean()) if len(marks) else 0.5
    return fit(documents, marks)


def score_column(model: AttentionModel | float, text: Column) -> Column:
    """Score of each whole text, 0 to 1; nothing but the text is an input."""
    if isinstance(model, float):
        return F.lit(model)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(encoded(texts)), pa.float64())

    return F.arrow_udf(score, "double")(text.cast("string"))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted` (1 if the score reaches `threshold`).

    Null and empty texts have one passage of zeros and get its score; a null doc_id is not held
    out and has no label. Repeated rows get equal scores. Other columns pass through, but those
    named like a result column are replaced; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("held_out", "score", "predicted")
    model = train(docs, labels)
    scored = docs.withColumn("score", score_column(model, F.col("text")))
    return scored.select(
        *docs.columns,
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
