"""Line dedup: winnowed line fingerprints, matches extended both ways, later repeated runs deleted."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bounded_batches, hot_values, kept, lookup
from shelfmark.llm.words import mix64

#: A run of equal lines is deleted where it repeats if it has so many words.
MIN_WORDS = 50

LINES = "struct<hashes:array<bigint>,words:array<int>,prints:array<bigint>,repeats:boolean>"


def _solid(text: str) -> list[str]:
    """Lines that have a word, without white space at their ends."""
    return [s for line in text.split("\n") if (s := line.strip(" \t\r\x0b\x0c"))]


def windows(hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`start, stop, place`: windows of lines, and in each the rightmost line of least hash.

    The window at a line reaches to the first line with which it has `least` words, and one that ends
    at a line reaches back in the same way. They depend on nothing outside: texts that share a run of
    `least` words share a window and the line chosen there, and each line of a shared run lies in a
    window inside that run.
    """
    n = len(hashes)
    before = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(before, before[:-1] + least)
    start = np.flatnonzero(ends <= n)
    stop = ends[start]
    back = np.searchsorted(before, before[1:] - least, side="right") - 1
    end = np.flatnonzero(back >= 0)
    # Where the window from its first line ends earlier; else that window is listed already.
    more = end[before[end] - before[back[end]] >= least]
    start, stop = np.concatenate([start, back[more]]), np.concatenate([stop, more + 1])
    if not len(start):
        return start, stop, start
    # Least places of stretches of 1, 2, 4 .. lines; two of them cover a window.
    size = stop - start
    place, level, least_at = np.empty_like(start), np.arange(n), 1
    while True:
        own = np.flatnonzero((size >= least_at) & (size < 2 * least_at))
        x, y = level[start[own]], level[stop[own] - least_at]
        place[own] = np.where(hashes[y] <= hashes[x], y, x)
        if 2 * least_at > size.max():
            return start, stop, place
        x, y = level[:-least_at], level[least_at:]
        level = np.where(hashes[y] <= hashes[x], y, x)
        least_at *= 2


_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def window_hashes(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of the lines of each window in turn; windows are compared line by line before they count."""
    n = len(hashes)
    up, down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, f)])) for f in (np.uint64(_BASE), _BACK))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes.view(np.uint64)) * up[:n], dtype=np.uint64)])
    return mix64((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64)).view(np.int64)


def _lines(texts: pa.Array) -> pa.Array:
    hashes, words, prints, repeats = [], [], [], []
    for text in texts:
        data = [x.encode() for x in _solid(text.as_py() or "")]
        h = np.array([int.from_bytes(blake2b(x, digest_size=8).digest(), "big", signed=True) for x in data], np.int64)
        w = np.array([len(x.split()) for x in data], np.int32)
        chosen = np.unique(windows(h, w)[2])
        distinct = np.unique(h[chosen])
        hashes.append(h)
        words.append(w)
        prints.append(distinct)
        repeats.append(len(distinct) < len(chosen))
    columns = [
        pa.array(hashes, pa.list_(pa.int64())),
        pa.array(words, pa.list_(pa.int32())),
        pa.array(prints, pa.list_(pa.int64())),
        pa.array(repeats, pa.bool_()),
    ]
    return pa.StructArray.from_arrays(columns, ["hashes", "words", "prints", "repeats"])


_OWN = "array<struct<shift:int,start:int,stop:int>>"
_FIRST = "array<struct<h:bigint,start:int,stop:int>>"


def _joined(shift: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of one shift that overlap or touch, as one."""
    order = np.lexsort((start, shift))
    out: list[list[int]] = []
    for d, a, b in zip(shift[order].tolist(), start[order].tolist(), stop[order].tolist()):
        if out and out[-1][0] == d and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], b)
        else:
            out.append([d, a, b])
    return [tuple(x) for x in out]


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows about the prints that stand elsewhere too: the first of each kind in a document, and
    for a later one the step back to the one before it."""
    link = pa.list_(pa.struct([("shift", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    first_kind = pa.list_(pa.struct([("h", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        own, firsts = [], []
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            hashes = col["hashes"][i].values.to_numpy()
            start, stop, place = windows(hashes, col["words"][i].values.to_numpy())
            shared = np.isin(hashes[place], col["shared"][i].values.to_numpy())
            repeated = np.zeros(len(place), dtype=bool)
            if col["repeats"][i].as_py():
                # A print that this text alone has, more than once.
                distinct, times = np.unique(hashes[np.unique(place)], return_counts=True)
                repeated = np.isin(hashes[place], distinct[times > 1])
            near = shared | repeated
            start, stop, shared = start[near], stop[near], shared[near]
            h = window_hashes(hashes, start, stop)
            order = np.lexsort((start, h))
            h, start, stop, shared = h[order], start[order], stop[order], shared[order]
            again = np.concatenate([[False], h[1:] == h[:-1]])
            at = np.flatnonzero(again)
            own.append(_joined(start[at] - start[at - 1], start[at], stop[at]))
            one = ~again & shared
            firsts.append(list(zip(h[one].tolist(), start[one].tolist(), stop[one].tolist())))
        yield pa.RecordBatch.from_arrays(
            [col["doc_id"], col["rid"], pa.array(own, link), pa.array(firsts, first_kind)],
            names=["doc_id", "rid", "own", "firsts"],
        )


SPANS = "rid string, start int, stop int"


def _reach(mine: np.ndarray, theirs: np.ndarray, at: int, shift: int, step: int) -> int:
    """How many lines from `at` on (before it, for step -1) are equal, `shift` lines apart."""
    if step > 0:
        most = min(len(mine) - at, len(theirs) - (at - shift))
    else:
        most = min(at, at - shift)
    done, chunk = 0, 8
    while done < most:
        size = min(chunk, most - done)
        a = at + done if step > 0 else at - done - size
        same = mine[a : a + size] == theirs[a - shift : a - shift + size]
        if not same.all():
            return done + (int(np.argmin(same)) if step > 0 else int(np.argmin(same[::-1])))
        done, chunk = done + size, 2 * chunk
    return most


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of equal lines of two documents, confirmed and grown both ways as far as they go."""
    for batch in batches:
        rids, starts, stops = [], [], []
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            rid = col["rid"][i].as_py()
            mine, theirs = (col[c][i].values.to_numpy() for c in ("hashes", "from_hashes"))
            words = np.concatenate([[0], np.cumsum(col["words"][i].values.to_numpy())])
            links = col["links"][i].values
            found = _joined(*[links.field(c).to_numpy() for c in ("shift", "start", "stop")])
            done = (None, 0)
            for shift, start, stop in found:
                if done[0] == shift and stop <= done[1]:
                    continue
                a = start
                while a < stop:
                    run = _reach(mine, theirs, a, shift, 1)
                    if not run:
                        a += 1
                        continue
                    first = a - _reach(mine, theirs, a, shift, -1)
                    if words[a + run] - words[first] >= MIN_WORDS:
                        rids.append(rid)
                        starts.append(first)
                        stops.append(a + run)
                    a += run + 1
                    done = (shift, a - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rids, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
            names=["rid", "start", "stop"],
        )


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the lines of their spans; what stands blank between two of a span goes too."""
    out = []
    for text, found in zip(texts, spans):
        found = found.as_py()
        text = text.as_py()
        if not found:
            out.append(text)
            continue
        gone = set()
        inner = set()
        for s in found:
            gone.update(range(s["start"], s["stop"]))
            inner.update(range(s["start"], s["stop"] - 1))
        kept_lines, at = [], -1
        for line in text.split("\n"):
            if line.strip(" \t\r\x0b\x0c"):
                at += 1
                if at not in gone:
                    kept_lines.append(line)
            elif at not in inner:
                kept_lines.append(line)
        out.append("\n".join(kept_lines))
    return pa.array(out, pa.string())


def _row_key(docs: DataFrame):
    """Names a row by doc_id and text: rows equal in both are one document."""
    t = F.hex(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), t)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """`rid, spans` of each document that loses lines.

    Only hashes move. Prints, the lines chosen in some window, are counted over all documents; those
    that one document has once, which are most, end there. About the others each document lists its
    windows: the first of a kind meets the first one of the corpus, by doc_id, a later one the one
    before it in the same text. So a text of n equal lines lists a window or two, and a window of n
    documents makes n rows; each line of every run lies in a window that has an earlier place, which
    is confirmed and extended there. Rows of a frequent print or window and of a much copied document
    are dealt to many tasks.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        _row_key(docs).alias("rid"),
        F.arrow_udf(_lines, LINES)(F.col("text").cast("string")).alias("x"),
    )
    lines = kept(rows.select("doc_id", "rid", "x.*"), "lines")
    prints = lines.select("rid", F.explode("prints").alias("h"))
    common = prints.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    common = kept(common, "common-prints")
    shared = lookup(prints, common, "h", "inner", hot_values(common, "h", "n"))
    # No more than the prints of one text; rows of one text name the same ones.
    shared = shared.groupBy("rid").agg(F.collect_set("h").alias("shared"))
    unique = lines.select("doc_id", "rid", "hashes", "words", "repeats").dropDuplicates(["rid"])
    near = unique.join(shared, "rid", "left").where("repeats or shared is not null")
    none = F.array().cast("array<bigint>")
    near = kept(near.withColumn("shared", F.coalesce("shared", none)), "line-lists")
    places = near.mapInArrow(_placed, f"doc_id long, rid string, own {_OWN}, firsts {_FIRST}")
    places = kept(places, "windows")
    windows_ = places.select("doc_id", "rid", F.explode("firsts").alias("w")).select("doc_id", "rid", "w.*")
    firsts = windows_.groupBy("h").agg(
        F.min(F.struct("doc_id", "rid", "start")).alias("first"), F.count("*").alias("n")
    )
    firsts = kept(firsts.where("n > 1"), "first-places")
    later = lookup(windows_, firsts.drop("n"), "h", "inner", hot_values(firsts, "h", "n"))
    later = later.where(F.col("rid") != F.col("first.rid"))
    stretch = F.struct((F.col("start") - F.col("first.start")).alias("shift"), "start", "stop")
    # No more than the windows of one text.
    across = later.groupBy("rid", F.col("first.rid").alias("from_rid")).agg(F.collect_list(stretch).alias("links"))
    within = places.where(F.size("own") > 0).select("rid", F.col("rid").alias("from_rid"), F.col("own").alias("links"))
    matches = kept(across.unionByName(within), "matches")
    mine = near.select("rid", "hashes", "words")
    theirs = near.select(F.col("rid").alias("from_rid"), F.col("hashes").alias("from_hashes"))
    sided = lookup(lookup(matches, theirs, "from_rid", "inner"), mine, "rid", "inner", hot_values(matches, "rid"))
    spans = sided.mapInArrow(_extend, SPANS).distinct().groupBy("rid")
    return kept(spans.agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")), "spans")


def dedup_lines(docs: DataFrame, spans: str | None = None) -> DataFrame:
    """`docs` with later repeated runs of lines deleted from `text`; no row is dropped.

    A run is a maximal stretch of consecutive lines that stands, line by line equal, at an earlier
    place of the corpus: in a document of smaller doc_id (null first) or further up in the same one.
    Runs of MIN_WORDS words or more are deleted where they come later; the first place of every line
    stays. Lines are compared without white space at their ends; lines without a word neither count
    nor part a run. `spans` names a column to add with the deleted stretches, in lines with a word.

    Null text stays null, empty text empty; a text all of whose lines stand earlier becomes
    empty. Rows equal in doc_id and text are one document and are edited alike. Other columns pass
    through; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    found = repeated_runs(docs).withColumnRenamed("rid", "_rid").withColumnRenamed("spans", "_spans")
    keyed = docs.withColumn("_rid", _row_key(docs))
    # The list of spans grows with the corpus, so it is never broadcast, however short it is here.
    joined = keyed.join(found.hint("merge"), "_rid", "left")
    text = F.col("text").cast("string")
    edited = F.arrow_udf(_without, "string")(text, F.col("_spans"))
    out = joined.withColumn("_edited", edited)
    columns = [F.col("_edited").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return out.select(*columns, *([F.col("_spans").alias(spans)] if spans else []))
