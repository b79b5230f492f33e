"""Mixing sources to target weights by pivotal rounding of fractional copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import WORD, kept, let, lookup
from shelfmark.operators.skew import number_rows

#: Weights of the sources in code-point order, repeating; a null source comes last.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
FAN_IN = 32


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """`_source, source_size, n_units, target` from units `(_source, size, n)`.

    Targets share `share` of all sizes by weight and stop at `most` times their source's size; what
    is over goes to the others by weight, until none is above. Sources are ranked and summed as a
    distributed table; each round brings two sums to the driver.
    """
    sources = sizes.groupBy("_source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("n_units")
    )
    ranked = number_rows(
        sources.withColumns({"_all": F.lit(0), "_one": F.lit(1)}),
        "_all",
        [F.col("_source").asc()],
        "_one",
    )
    place = ((F.col("position") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1)
    table = kept(ranked.select("_source", "source_size", "n_units", weight.alias("weight")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap = most * F.col("source_size")
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= cap
        sums = table.agg(
            F.sum(F.when(full, cap)).alias("used"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if sums["capped"] == capped or not sums["open"]:
            break
        capped = sums["capped"]
        level = (share * total - (sums["used"] or 0.0)) / sums["open"]
    target = F.least(cap, F.col("weight") * F.lit(level or 0.0))
    return table.select("_source", "source_size", "n_units", target.alias("target"))


def _uniform(seed: int, *columns: Column) -> Column:
    """In [0, 1): the upper 53 bits of a hash, so a rerun draws the same."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def _pivot(units: Column, seed: int) -> Column:
    """Fold an array of units into `(rest, done)`: all but one unit end with no or one more copy.

    Two units exchange words until one of them is at 0 or 1, the direction drawn so that each keeps
    its expectation; the other one meets the next unit. The words of the two stay the same in sum.
    """
    kind = "struct<rest:struct<{0}>,done:array<struct<{0}>>>".format(
        "u:struct<id:bigint,key:string,doc_id:bigint,source:string,size:bigint,n:bigint,copies:bigint,"
        "source_size:bigint,target:double>,x:double"
    )
    start = F.struct(F.lit(None).alias("rest"), F.array().alias("done")).cast(kind)

    def unit(e: Column, x: Column) -> Column:
        return F.struct(e["u"].alias("u"), x.alias("x"))

    def meet(acc: Column, b: Column) -> Column:
        a = acc["rest"]
        sa, sb = a["u"]["size"], b["u"]["size"]
        up = F.least(sa * (1 - a["x"]), sb * b["x"])
        down = F.least(sa * a["x"], sb * (1 - b["x"]))
        draw = _uniform(seed, a["u"]["id"], b["u"]["id"])

        def moved(m: Column) -> Column:
            xa = a["x"] + m["d"] / sa
            xb = b["x"] - m["d"] / sb
            # Which of the two has come to a whole number follows from which bound the move has.
            a_done = F.when(m["d"] > 0, m["d"] == sa * (1 - a["x"])).otherwise(
                -m["d"] == sa * a["x"]
            )
            one, rest = F.when(a_done, unit(a, F.round(xa))).otherwise(unit(b, F.round(xb))), F.when(
                a_done, unit(b, xb)
            ).otherwise(unit(a, xa))
            return F.struct(rest.alias("rest"), F.concat(acc["done"], F.array(one)).alias("done"))

        chance = F.coalesce(F.try_divide(m_down := down, up + m_down), F.lit(1.0))
        move = F.struct(F.when(draw < chance, up).otherwise(-down).alias("d"))
        return let(move, moved)

    return F.aggregate(
        units,
        start,
        lambda acc, b: F.when(
            acc["rest"].isNull(), F.struct(b.alias("rest"), acc["done"].alias("done"))
        )
        .otherwise(meet(acc, b))
        .cast(kind),
    )


def round_copies(units: DataFrame, fan_in: int = FAN_IN, seed: int = 11) -> DataFrame:
    """Units with `copies`, the fraction `x` of each rounded to a whole copy or none.

    A level folds buckets of about `fan_in` units of a source and hands one rest per bucket to the
    next, where `fan_in` buckets meet: a reduction tree of log(units) levels, in which no task gets
    more than a few dozen units of a bucket. A source's last rest is drawn by its fraction, so its
    words miss the target by less than one document.
    """
    inner = F.struct("id", "key", "doc_id", "source", "size", "n", "copies", "source_size", "target")
    fraction = (F.col("x") > 0) & (F.col("size") > 0)
    buckets = F.ceil(F.col("n_units") / fan_in).cast("long")
    level = (
        units.where(fraction)
        .withColumn("_buckets", buckets)
        .select(
            "_source",
            "_buckets",
            F.pmod("id", "_buckets").alias("_bucket"),
            F.struct(inner.alias("u"), F.col("x")).alias("e"),
        )
    )
    whole = units.where(~fraction).select(inner.alias("u"), F.lit(0.0).alias("x"))
    done = [whole]
    depth = 0
    while True:
        folded = level.groupBy("_source", "_buckets", "_bucket").agg(
            F.sort_array(F.collect_list("e")).alias("_units")
        )
        folded = kept(
            folded.select("_source", "_buckets", "_bucket", _pivot(F.col("_units"), seed + depth).alias("f")),
            "mix-level",
        )
        done.append(folded.select(F.inline("f.done")))
        most = folded.agg(F.max("_buckets")).first()[0] or 1
        if most <= 1:
            last = F.when(_uniform(seed, F.col("f.rest.u.id")) < F.col("f.rest.x"), 1.0).otherwise(0.0)
            done.append(folded.select(F.col("f.rest.u").alias("u"), last.alias("x")))
            break
        level = folded.select(
            "_source",
            F.ceil(F.col("_buckets") / fan_in).cast("long").alias("_buckets"),
            F.floor(F.col("_bucket") / fan_in).alias("_bucket"),
            F.col("f.rest").alias("e"),
        )
        depth += 1
    rounded = done[0]
    for part in done[1:]:
        rounded = rounded.unionByName(part)
    return rounded.select(
        "u.key",
        "u.doc_id",
        "u.source",
        "u.size",
        "u.n",
        "u.source_size",
        "u.target",
        (F.col("u.copies") + F.col("x").cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, fan_in: int = FAN_IN, seed: int = 11) -> DataFrame:
    """Copies of each document, so that sources come to their target share of words.

    `docs` needs `doc_id`, `text` and `source`; other columns are not read. Result: `key` (of the
    text), `doc_id`, `source`, `size` (words), `n` equal rows, `source_size`, `target`, `copies` (of the
    n rows together, 0 to 2n). A document's expected copies are its source's target over its size;
    whole copies are certain and the fraction is rounded by `round_copies`. Draws come from hashes,
    so reruns agree. A hot source is dealt to many tasks wherever it meets its target.

    Null text has size 0 and gets the certain copies; a null source is one more source, the last;
    a null doc_id is a value like others. Rows equal in doc_id, source and text are one unit of n.
    An empty table gives an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    units = docs.select(
        F.xxhash64(text).alias("_h"),
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    units = (
        units.groupBy("_h", "doc_id", "source", "size")
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "key": F.col("_h").cast("string"),
                "id": F.xxhash64(F.lit(seed), "doc_id", "_h", "source"),
                "_source": F.when(F.col("source").isNull(), F.lit("n")).otherwise(
                    F.concat(F.lit("="), F.col("source"))
                ),
            }
        )
        .drop("_h")
    )
    units = kept(units, "mix-units")
    aimed = lookup(units, source_targets(units), "_source")
    exact = F.coalesce(F.try_divide(F.col("target") * F.col("n"), "source_size"), F.lit(0.0))
    parts = aimed.withColumn("_copies", exact).withColumns(
        {"copies": F.floor("_copies"), "x": F.col("_copies") - F.floor("_copies")}
    )
    return round_copies(kept(parts.drop("_copies"), "mix-aimed"), fan_in, seed)


def each_row(copies: DataFrame) -> DataFrame:
    """A row per document again: equal rows share their copies as evenly as they can."""
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_nth")
    share = F.floor(F.col("copies") / F.col("n")) + (
        F.col("_nth") <= F.col("copies") % F.col("n")
    ).cast("long")
    return copies.select("*", nth).withColumn("copies", share).drop("_nth")


def mixed_documents(docs: DataFrame, fan_in: int = FAN_IN, seed: int = 11) -> DataFrame:
    """`docs` with each row as often as the mix takes it (see `mix`); columns stay as they are.

    Decisions are joined back by doc_id, source and a hash of the text, which are near-unique, so no
    key is hot; equal rows are numbered to share their copies.
    """
    shares = mix(docs, fan_in, seed)
    shares = kept(shares.select("key", "doc_id", "source", "n", "copies"), "mix-copies")
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))).cast("string"))
    once = shares.where("n = 1").drop("n")
    many = shares.where("n > 1")

    def joined(right: DataFrame) -> DataFrame:
        right = right.select(
            F.col("key").alias("_rkey"),
            F.col("doc_id").alias("_rdoc"),
            F.col("source").alias("_rsource"),
            *[F.col(c).alias(f"_r{c}") for c in right.columns if c in ("n", "copies")],
        )
        on = (
            (keyed["_key"] == F.col("_rkey"))
            & keyed["doc_id"].eqNullSafe(F.col("_rdoc"))
            & keyed["source"].eqNullSafe(F.col("_rsource"))
        )
        return keyed.join(right, on)

    def repeat(df: DataFrame, times: Column) -> DataFrame:
        counted = df.where(times > 0)
        return counted.withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), times))).select(
            *docs.columns
        )

    out = repeat(joined(once), F.col("_rcopies"))
    if not many.isEmpty():
        nth = F.row_number().over(Window.partitionBy("_rkey", "_rdoc", "_rsource").orderBy("_rkey"))
        rows = joined(many).withColumn("_nth", nth)
        share = F.floor(F.col("_rcopies") / F.col("_rn")) + (
            F.col("_nth") <= F.col("_rcopies") % F.col("_rn")
        ).cast("long")
        out = out.unionByName(repeat(rows, share))
    return out
