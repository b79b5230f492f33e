"""Quality rules of documents, and verdicts on their hosts from shrunk failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import WHITE, WORD, kept, let, lookup

#: A document fails `short` under so many words, `repeats` over that share of repeated words, and so on.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
RULES = ("short", "repeats", "symbols", "dup_lines")

#: A host is rejected when the shrunk rate of one of its rules is above this.
HOST_LIMIT = 0.5


def _repeated(words: Column) -> Column:
    """Words that lie in a window of three found twice or more, each word once.

    Windows are compared by a 64-bit hash: a text of a million windows confuses two of them with a
    probability of 3e-8. Sorting windows by hash puts equal ones side by side; their starts, sorted,
    cover three words each, less where the next one begins.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
            i.alias("i"),
        ),
    )

    def twice(ws: Column) -> Column:
        return F.transform(
            F.filter(
                ws,
                lambda x, j: F.coalesce(F.get(ws, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ws, j + 1)["h"] == x["h"], F.lit(False)),
            ),
            lambda x: x["i"],
        )

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - i, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )

    count = let(F.sort_array(windows), lambda ws: let(F.sort_array(twice(ws)), covered))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(count)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the text, with counts of the whole text; null text counts as empty."""
    whole = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    split = whole.withColumns(
        {
            "_words": F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)),
            "_lines": F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    return split.select(
        *[c for c in docs.columns if c != text],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", WHITE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_words")).alias("n_repeat_words"),
    )


def rule_failures() -> dict[str, Column]:
    """Each rule as a condition on the counts; all of them compare integers."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


#: Bounds of a prior's strength, in documents.
STRENGTHS = (1.0, 1e6)


def shrunk_rates(hosts: DataFrame) -> DataFrame:
    """`hosts` with `rate_<rule>`: failures over documents, drawn to the corpus by a beta prior.

    The prior of a rule has the mean of all documents. Its strength follows by moments of the
    beta-binomial distribution: of the hosts' spread about the mean, what drawing their documents
    makes by itself is taken off, and the rest, over its largest possible value, is the correlation
    of documents of one host. Where hosts spread no more than by chance, or all have one document,
    rates go to the mean. Hosts of few documents move furthest. Only one row of moments reaches the
    driver.
    """
    n = F.col("n_docs")
    sums = [F.sum(f"bad_{r}").alias(r) for r in RULES]
    totals = hosts.agg(
        F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n.cast("double") * n).alias("squares"), *sums
    ).first()
    if not totals["n"]:
        return hosts.withColumns({f"rate_{r}": F.lit(0.0) for r in RULES})
    mean = {r: totals[r] / totals["n"] for r in RULES}
    spread = hosts.agg(
        *[F.sum(n * F.pow(F.col(f"bad_{r}") / n - mean[r], F.lit(2.0))).alias(r) for r in RULES]
    ).first()
    by_chance = totals["k"] - 1
    most = totals["n"] - totals["squares"] / totals["n"] - by_chance
    rates = {}
    for r in RULES:
        room = mean[r] * (1 - mean[r])
        within = (spread[r] - room * by_chance) / (room * most) if room > 0 and most > 1e-9 else 0.0
        strength = min(max(1 / within - 1, STRENGTHS[0]), STRENGTHS[1]) if within > 0 else STRENGTHS[1]
        rates[f"rate_{r}"] = (F.col(f"bad_{r}") + mean[r] * strength) / (n + strength)
    return hosts.withColumns(rates)


def apply_host_rules(
    docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """Each row of `docs` without the text, with counts, `base_failed` and `kept`.

    Counts come from one pass and are kept as a table; hosts are counted from it with partial sums,
    and the rejected ones joined back, rows of a large host dealt to many tasks. `base_failed`:
    under 50 words, or over half of them repeated. `kept`: not `base_failed`, and no rule has a
    shrunk failure rate over `limit` on the document's host.

    Null or empty text has no words and fails. Documents of a null host belong to one host of
    their own. Repeated rows count and are judged one by one. Columns that have the name of a result
    column are replaced, others pass through; an empty table gives an empty one.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    own = (*made, "base_failed", "kept", "host_rejected", "_host", "_text", "_words", "_lines")
    docs = docs.drop(*[c for c in own if c not in (text, host)])
    names = [c for c in docs.columns if c != text]
    stats = text_statistics(docs, text).withColumn(
        "_host", F.when(F.col(host).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(host)))
    )
    stats = kept(stats, "rule-counts")
    bad = rule_failures()
    hosts = stats.groupBy("_host").agg(
        F.count("*").alias("n_docs"),
        *[F.sum(bad[r].cast("long")).alias(f"bad_{r}") for r in RULES],
    )
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    rates = shrunk_rates(kept(hosts, "rule-hosts"))
    rejected = rates.select("_host", (worst > limit).alias("host_rejected"))
    judged = lookup(stats, rejected, "_host")
    failed = bad["short"] | bad["repeats"]
    return judged.select(
        *names, *made, failed.alias("base_failed"), "host_rejected", (~failed & ~F.col("host_rejected")).alias("kept")
    )
