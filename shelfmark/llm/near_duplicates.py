"""Near-duplicates by MinHash: banding, signature verification, exact sets, star components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SALTS, hot_values, kept, lookup
from shelfmark.llm.components import components

SHINGLE_WORDS = 5
#: Linked if PERCENT of the union is shared, at least.
PERCENT = 75
#: A pair of exactly that similarity shares no band with a probability of (1 - 0.75**5)**40 = 2e-5.
BANDS = 40
ROWS = 5
#: Pairs whose signatures agree less are no links: 6 standard deviations under 0.75.
AGREE = 0.55

_RNG = np.random.default_rng(42)
_A = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

SIGNED = "struct<class:string,n_shingles:bigint,bands:array<bigint>,signature:binary>"


def minima(shingle_set: np.ndarray) -> np.ndarray:
    """Least value of each universal hash a * x + b over the set; long sets go in pieces."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingle_set), 2048):
        x = shingle_set[at : at + 2048]
        for j in range(0, BANDS * ROWS, 20):
            values = x[None, :] * _A[j : j + 20, None] + _B[j : j + 20, None]
            out[j : j + 20] = np.minimum(out[j : j + 20], values.min(axis=1))
    return out


def _band_hashes(least: np.ndarray) -> np.ndarray:
    from shelfmark.llm.words import mix64

    rows = least.reshape(BANDS, ROWS)
    h = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        h = mix64(h ^ mix64(rows[:, r] + np.uint64(r)))
    return h.view(np.int64)


def _lowered(texts: pa.Array) -> list[bytes]:
    """UTF-8 of the texts; bytes.lower changes A-Z alone."""
    return [(t.as_py() or "").encode().lower() for t in texts]


def _signed(texts: pa.Array) -> pa.Array:
    from shelfmark.llm.words import groups, mix64, shingles

    classes, sizes, bands, signatures = [], [], [], []
    for group in groups(_lowered(texts)):
        for s in shingles(group, SHINGLE_WORDS):
            sizes.append(len(s))
            if not len(s):
                classes.append(None)
                bands.append(None)
                signatures.append(None)
                continue
            least = minima(s)
            classes.append(blake2b(s.tobytes(), digest_size=16).hexdigest())
            bands.append(_band_hashes(least))
            # Minima of large sets are small: only mixed are their top bytes as good as random.
            signatures.append((mix64(least) >> np.uint64(56)).astype(np.uint8).tobytes())
    columns = [
        pa.array(classes, pa.string()),
        pa.array(sizes, pa.int64()),
        pa.array(bands, pa.list_(pa.int64())),
        pa.array(signatures, pa.binary()),
    ]
    return pa.StructArray.from_arrays(columns, ["class", "n_shingles", "bands", "signature"])


def signed(docs: DataFrame) -> DataFrame:
    """`doc_id, t` (hash of the text) and SIGNED of each row, as a table of the shared folder."""
    udf = F.arrow_udf(_signed, SIGNED)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), udf(text).alias("s")
    )
    return kept(rows.select("doc_id", "t", "s.*"), "signed")


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct shingle set: a number, its first document, and the signature.

    A document without an id is first only among such.
    """
    same_set = rows.where("class is not null").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t")).alias("first"),
        F.count("*").alias("n_docs"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
        F.first("signature").alias("signature"),
    )
    return kept(same_set.withColumn("id", F.monotonically_increasing_id()), "classes")


def _buckets(classes: DataFrame) -> DataFrame:
    """`band, id, center` of the classes that share a band with another; center is the least id.

    Bands are counted with partial sums. A band with a large share of all rows is dealt out.
    """
    members = classes.select("id", F.explode("bands").alias("band"))
    centers = members.groupBy("band").agg(F.min("id").alias("center"), F.count("*").alias("rows"))
    centers = kept(centers.where("rows > 1"), "centers")
    hot = hot_values(centers, "band", "rows")
    deal = F.when(F.col("band").isin(hot), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(0)
    copies = F.when(F.col("band").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = members.withColumn("salt", deal.cast("int"))
    copied = centers.select("band", "center", F.explode(copies).alias("salt"))
    return kept(dealt.join(copied, ["band", "salt"]).select("band", "id", "center"), "buckets")


def _agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """Share of equal minima; bytes of different ones agree by chance once in 256."""
    width = BANDS * ROWS
    x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, width) for v in (a, b))
    share = (x == y).mean(axis=1)
    return pa.array((share - 1 / 256) / (1 - 1 / 256), pa.float64())


def _sets(texts: pa.Array) -> pa.Array:
    from shelfmark.llm.words import groups, shingles

    found = [s.view(np.int64) for g in groups(_lowered(texts)) for s in shingles(g, SHINGLE_WORDS)]
    return pa.array(found, pa.list_(pa.int64()))


def _with(pairs: DataFrame, table: DataFrame, column: str, hot: dict[str, list]) -> DataFrame:
    """`column` of both classes of each pair, as `xa` and `xb`; a class of many pairs is dealt out."""
    for end in ("a", "b"):
        right = table.select(F.col("id").alias(end), F.col(column).alias(f"x{end}"))
        pairs = lookup(pairs, right, end, "inner", hot[end])
    return pairs


def _class_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """`id, s`: the full sets of the wanted classes, made again from the text of one document each."""
    first = wanted.join(classes, "id").select("id", F.col("first.doc_id").alias("fd"), F.col("first.t").alias("ft"))
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "t", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    rows = rows.join(first, rows["doc_id"].eqNullSafe(first["fd"]) & (rows["t"] == first["ft"]))
    if repeated:
        rows = rows.dropDuplicates(["id"])
    return kept(rows.select("id", F.arrow_udf(_sets, "array<bigint>")("text").alias("s")), "sets")


def _compared(pairs: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """`pairs (a, b)` with bounds of their distance 1 - J, and `linked` where the full sets say so.

    Sizes too far apart and signatures that agree too little rule a pair out; what remains is
    compared on full sets, made again from the texts of those classes alone.
    """
    pairs = kept(pairs, "pairs", short=True)
    hot = {end: hot_values(pairs, end) for end in ("a", "b")}
    sized = _with(pairs, classes, "n", hot).withColumnsRenamed({"xa": "na", "xb": "nb"})
    ratio = F.least("na", "nb") / F.greatest("na", "nb")
    sized = kept(sized.withColumn("ratio", ratio), "sized", short=True)
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    both = _with(sized.where(fits), classes, "signature", hot)
    agree = F.arrow_udf(_agreement, "double")
    judged = kept(both.withColumn("agree", agree("xa", "xb")).drop("xa", "xb"), "judged")
    likely = judged.where(F.col("agree") >= AGREE)
    wanted = likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()
    sets = _class_sets(wanted, classes, docs, repeated)
    full = _with(likely.select("a", "b", "na", "nb"), sets, "s", hot)
    overlap = full.withColumn("both", F.arrow_udf(_shared, "bigint")("xa", "xb")).select(
        "a", "b", "both", (F.col("na") + F.col("nb") - F.col("both")).alias("union")
    )
    exact = overlap.select(
        "a",
        "b",
        (1 - F.col("both") / F.col("union")).alias("low"),
        (1 - F.col("both") / F.col("union")).alias("high"),
        (100 * F.col("both") >= PERCENT * F.col("union")).alias("linked"),
    )
    one, no = F.lit(1.0).alias("high"), F.lit(False).alias("linked")
    far = sized.where(~fits).select("a", "b", (1 - F.col("ratio")).alias("low"), one, no)
    doubt = F.greatest(F.lit((100 - PERCENT) / 100), 1 - F.col("agree") - 0.2).alias("low")
    apart = judged.where(F.col("agree") < AGREE).select("a", "b", doubt, one, no)
    return kept(exact.unionByName(far).unionByName(apart), "compared")


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets, row by row."""
    out = []
    for x, y in zip(a, b):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        if len(x) > len(y):
            x, y = y, x
        # Sets are sorted as unsigned; signed views are sorted apart from one rotation.
        x, y = x.view(np.uint64), y.view(np.uint64)
        at = np.searchsorted(y, x)
        at[at == len(y)] = len(y) - 1
        out.append(int((y[at] == x).sum()))
    return pa.array(out, pa.int64())


def _labels(links: DataFrame) -> DataFrame:
    return kept(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels", short=True)


def _unsettled(buckets: DataFrame, compared: DataFrame, labels: DataFrame) -> DataFrame:
    """`g, id, far, label` of classes that may still be linked, in groups named by a component.

    A class is far where the center of its bucket lies in another component; it is to meet all others
    of such buckets. The distance of Jaccard is a metric: two classes whose distances to the center
    differ by over a quarter are not linked, which leaves out the many that lie near the center when
    the far ones lie well away.
    """
    near = compared.select(F.col("a").alias("center"), F.col("b").alias("id"), "low", "high")
    zero = F.lit(0.0)
    rows = buckets.join(near, ["center", "id"], "left").withColumns(
        {"low": F.coalesce("low", zero), "high": F.coalesce("high", zero)}
    )
    named = labels.select(F.col("id"), F.col("label"))
    rows = rows.join(named, "id", "left").withColumn("label", F.coalesce("label", "id"))
    centers = named.select(F.col("id").alias("center"), F.col("label").alias("own"))
    rows = lookup(kept(rows, "placed"), centers, "center").withColumn("own", F.coalesce("own", "center"))
    rows = kept(rows.where("id != center"), "owned")
    bound = rows.where("label != own").groupBy("band").agg(F.min("low").alias("least"), F.count("*").alias("n"))
    bound = kept(bound, "bounds")
    reach = (100 - PERCENT) / 100 + 1e-9
    met = lookup(rows, bound, "band", "inner").where(F.col("high") >= F.col("least") - reach)
    far = F.max(F.col("label") != F.col("own")).alias("far")
    return met.groupBy(F.col("own").alias("g"), "id").agg(far, F.max("label").alias("label"))


#: Classes of a block; what two blocks hold is in memory at once.
BLOCK = 32


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components that classes of two blocks give, no more than join them together."""
    for batch in batches:
        found_a, found_b = [], []
        for row in range(batch.num_rows):
            left, right = (batch.column(c)[row].values for c in (0, 1))
            ids, others = left.field("label").to_numpy(), right.field("label").to_numpy()
            sets = [s.values.to_numpy().view(np.uint64) for s in left.field("s")]
            theirs = [s.values.to_numpy().view(np.uint64) for s in right.field("s")]
            sizes = np.array([len(s) for s in theirs])
            every = np.concatenate(theirs)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], np.repeat(np.arange(len(theirs)), sizes)[order]
            root = {int(i): int(i) for i in (*ids, *others)}

            def top(i: int, root: dict[int, int] = root) -> int:
                while root[i] != i:
                    i = root[i]
                return i

            for i, s in zip(ids, sets):
                first, last = np.searchsorted(every, s, "left"), np.searchsorted(every, s, "right")
                n = last - first
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(theirs))
                linked = 100 * both >= PERCENT * (len(s) + sizes - both)
                for j in others[linked]:
                    a, b = top(int(i)), top(int(j))
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found_a.append(min(int(i), int(j)))
                        found_b.append(max(int(i), int(j)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"]
        )


#: Classes of a block of signatures.
SCREEN = 512


def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of classes of two blocks of which one of another component may be a link."""
    for batch in batches:
        found: set[int] = set()
        for row in range(batch.num_rows):
            left, right = (batch.column(c)[row].values for c in (0, 1))
            ids, others = left.field("id").to_numpy(), right.field("id").to_numpy()
            label, their = left.field("label").to_numpy(), right.field("label").to_numpy()
            n, m = left.field("n").to_numpy(), right.field("n").to_numpy()
            x, y = (
                np.frombuffer(b"".join(side.field("signature").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
                for side in (left, right)
            )
            for i in range(len(ids)):
                share = ((x[i] == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                fits = 100 * np.minimum(n[i], m) >= PERCENT * np.maximum(n[i], m)
                near = others[fits & (share >= AGREE) & (their != label[i])]
                if len(near):
                    found.add(int(ids[i]))
                    found.update(near.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["id"])


def _block_pairs(rows: DataFrame, block: int, one: Column) -> DataFrame:
    """`x, y`: each block of far classes of a group with each block of all of its classes."""
    sizes = rows.groupBy("g").agg(
        F.ceil(F.sum(F.col("far").cast("int")) / block).alias("rows"), F.ceil(F.count("*") / block).alias("columns")
    )
    dealt = kept(lookup(rows, kept(sizes, "group-sizes", short=True), "g", "inner", hot_values(rows, "g")), "group-rows")

    def blocks(part: DataFrame, own: str, other: str, name: str) -> DataFrame:
        placed = part.withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), F.col(own + "s")))
        packed = placed.groupBy("g", own, other + "s").agg(F.collect_list(one).alias(name))
        return packed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other + "s") - 1)))

    x = blocks(dealt.where("far"), "row", "column", "x").select("g", "row", "column", "x")
    y = blocks(dealt, "column", "row", "y").select("g", "row", "column", "y")
    return x.join(y, ["g", "row", "column"]).select("x", "y")


def _rest_links(unsettled: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """Links `a, b` of the far classes of each group with all of the group, block against block.

    A row is a pair of blocks, not of classes; blocks of a large group are spread over all tasks.
    First signatures meet, 200 bytes a class: a class that agrees with none of another component, of
    a fitting size, has no link to find. Full sets are made and sent for the classes left alone.
    Exact for every bucket, however large, as far as signatures are.
    """
    signed_rows = kept(lookup(unsettled, classes.select("id", "n", "signature"), "id", "inner", []), "group-signatures")
    pairs = _block_pairs(signed_rows, SCREEN, F.struct("id", "label", "n", "signature"))
    likely = kept(pairs.mapInArrow(_screened, "id long").distinct(), "likely")
    sets = _class_sets(likely, classes, docs, repeated)
    full = kept(lookup(unsettled, sets, "id", "inner", []), "group-sets")
    pairs = _block_pairs(full, BLOCK, F.struct("label", "s"))
    # Many blocks join the same two components; one link of theirs is enough.
    return kept(pairs.mapInArrow(_block_links, "a long, b long").distinct(), "rest-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, t, class, n_shingles, group, component_id, kept` of each row of `docs (doc_id, text)`.

    Documents with equal sets of shingles are one class. Each class is compared with the least
    class of every band it shares, not with all of them, and components are formed. Then classes
    still apart from the least one of their band meet the others that the triangle inequality
    leaves, block against block, so no link between classes that share a band is lost. Links are
    confirmed on full sets.

    `component_id` is the least doc_id of the component (nulls aside) and `kept` marks its rows.
    `group` is a number of the component, null where a class stands alone without copies.
    Text null or without words: no shingles, a component of its own. A null doc_id: takes part, and
    is kept only if no document of its component has an id; `component_id` is null then. Repeated rows are
    equal sets: the same class, and each of them is kept if its doc_id is the least. Extra columns
    are not read. An empty table gives an empty one.
    """
    rows = signed(docs)
    classes = _classes(rows)
    repeated = not rows.groupBy("doc_id", "t").count().where("count > 1").isEmpty()
    buckets = _buckets(classes)
    stars = buckets.where("id != center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    compared = _compared(stars, classes, docs, repeated)
    links = compared.where("linked").select("a", "b")
    labels = _labels(links)
    rest = kept(_unsettled(buckets, compared, labels), "unsettled")
    if not rest.isEmpty():
        more = _rest_links(rest, classes, docs, repeated)
        labels = _labels(links.unionByName(more))
    # Only sets of several documents or with links need a join; all others stand alone.
    joined = classes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    joined = kept(joined.select("class", "label", "n_docs", F.col("first.doc_id").alias("d")), "labelled")
    groups = joined.groupBy("label").agg(F.min("d").alias("component_id"), F.sum("n_docs").alias("size"))
    groups = kept(groups.where("size > 1").select("label", "component_id"), "groups", short=True)
    of_class = kept(lookup(joined.select("class", "label"), groups, "label", "inner").withColumnRenamed("label", "group"), "members")
    out = lookup(rows.select("doc_id", "t", "class", "n_shingles"), of_class.withColumn("_grouped", F.lit(True)), "class")
    component = F.when(F.col("_grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.withColumn("component_id", component).select(
        "doc_id", "t", "class", "n_shingles", "group", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component: the one with the least doc_id, columns as they are.

    Rows without words all stay. Of rows that repeat the least doc_id of their component, or share
    a null one, the one of least text hash stays, and of equal rows one.
    """
    found = kept(near_duplicates(docs), "near")
    alone = found.where("n_shingles = 0").select("doc_id", "t").distinct()
    grouped = found.where("n_shingles > 0 and kept")
    # Documents share a kept doc_id only where it repeats, so these groups are small.
    stay = grouped.where("doc_id is not null").groupBy("doc_id", "component_id").agg(F.min("t").alias("t"))
    nameless = grouped.where("doc_id is null").withColumn("own", F.coalesce(F.col("group").cast("string"), "class"))
    null_ids = nameless.groupBy("own").agg(F.min("t").alias("t"))
    chosen = stay.select("doc_id", "t").unionByName(null_ids.select(F.lit(None).cast("long").alias("doc_id"), "t"))
    repeats = found.groupBy("doc_id", "t").agg(F.count("*").alias("n"), F.max("n_shingles").alias("w"))
    repeats = kept(repeats.where("n > 1 and w > 0").select("doc_id", "t"), "repeats", short=True)
    keyed = docs.withColumns(
        {"_d": F.col("doc_id").cast("long"), "_t": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))}
    )

    def among(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.join(keys, df["_d"].eqNullSafe(keys["doc_id"]) & (df["_t"] == keys["t"]), how)

    stays = among(keyed, kept(alone.unionByName(chosen), "stay", short=True), "left_semi")
    if repeats.isEmpty():
        return stays.select(*docs.columns)
    once = among(stays, repeats, "left_anti")
    many = among(stays, repeats, "left_semi").dropDuplicates(["_d", "_t"])
    return once.unionByName(many).select(*docs.columns)
