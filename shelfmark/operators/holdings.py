"""Expected articles against the files held, here and remotely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.urls import pdf_name
from shelfmark.operators.skew import hot_keys, lookup

YEAR_FLOOR = 1940  # fixed value: issues before it are not counted as expected


def file_key(column: Column, ignore_case: bool) -> Column:
    """A file name as it is compared."""
    return F.lower(column) if ignore_case else column


def manifest(held: DataFrame, remote: DataFrame | None = None, ignore_case: bool = False) -> DataFrame:
    """`(_name, held, remote)`, one row per file name however many listings hold it."""
    listed = held.select(
        file_key(F.col("name"), ignore_case).alias("_name"),
        F.lit(True).alias("held"),
        F.lit(False).alias("remote"),
    )
    if remote is not None:
        listed = listed.unionAll(
            remote.select(
                file_key(F.col("name"), ignore_case).alias("_name"),
                F.lit(False).alias("held"),
                F.lit(True).alias("remote"),
            )
        )
    return listed.groupBy("_name").agg(
        F.bool_or("held").alias("held"), F.bool_or("remote").alias("remote")
    )


def with_holdings(
    articles: DataFrame,
    held: DataFrame,
    remote: DataFrame | None = None,
    ignore_case: bool = False,
    base: DataFrame | None = None,
) -> DataFrame:
    """Adds `held` and `remote` to each article; both listings are met in one join.

    `base` is the table `articles` was filtered from: its URLs tell hot file names without running
    the filter twice.
    """
    name = file_key(pdf_name(F.col("url")), ignore_case).alias("_name")
    hot = hot_keys((articles if base is None else base).select(name), "_name")
    flagged = lookup(
        articles.withColumn("_name", name), manifest(held, remote, ignore_case), "_name", hot=hot
    )
    return flagged.drop("_name").withColumns(
        {flag: F.coalesce(flag, F.lit(False)) for flag in ("held", "remote")}
    )


def _name_lookup(
    articles: DataFrame, held: DataFrame, how: str, ignore_case: bool, base: DataFrame | None
) -> DataFrame:
    name = file_key(pdf_name(F.col("url")), ignore_case).alias("_name")
    hot = hot_keys((articles if base is None else base).select(name), "_name")
    names = held.select(file_key(F.col("name"), ignore_case).alias("_name")).distinct()
    return lookup(articles.withColumn("_name", name), names, "_name", how, hot=hot).drop("_name")


def holdings_semi(
    articles: DataFrame,
    held: DataFrame,
    ignore_case: bool = False,
    base: DataFrame | None = None,
) -> DataFrame:
    """Articles whose file is held."""
    return _name_lookup(articles, held, "left_semi", ignore_case, base)


def pending_anti(
    articles: DataFrame,
    held: DataFrame,
    ignore_case: bool = False,
    base: DataFrame | None = None,
) -> DataFrame:
    """Articles whose file is not held."""
    return _name_lookup(articles, held, "left_anti", ignore_case, base)


def issue_articles_left(issues: DataFrame, articles: DataFrame) -> DataFrame:
    """Every issue with the number of its articles, none counted as 0."""
    counts = articles.groupBy("issue_url").agg(F.count("*").alias("n_articles"))
    joined = lookup(issues, counts, "issue_url")
    return joined.withColumn("n_articles", F.coalesce("n_articles", F.lit(0).cast("long")))


def _per_issue(issues: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    joined = lookup(issues.select("issue_url", "year", "no_docs"), counts, "issue_url")
    zero = F.lit(0).cast("long")
    return joined.select(
        "year",
        "no_docs",
        "issue_url",
        *[F.coalesce(name, zero).alias(name) for name in names],
    )


def held_per_issue(
    issues: DataFrame, articles: DataFrame, held: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """`(year, no_docs, issue_url, expected, downloaded)` of every issue."""
    flagged = with_holdings(articles.select("issue_url", "url"), held, ignore_case=ignore_case)
    counts = flagged.groupBy("issue_url").agg(
        F.count("*").alias("expected"), F.count_if("held").alias("downloaded")
    )
    return _per_issue(issues, counts, ["expected", "downloaded"])


def held_totals(per_issue: DataFrame, floor: int = YEAR_FLOOR) -> DataFrame:
    """One row: files held in all, and articles expected of issues since `floor`."""
    since = F.when(F.col("year") >= floor, F.col("expected")).otherwise(0)
    return per_issue.agg(
        F.coalesce(F.sum("downloaded"), F.lit(0)).alias("held_total"),
        F.coalesce(F.sum(since), F.lit(0)).alias("expected_since"),
    )


def remote_reconcile(
    issues: DataFrame,
    articles: DataFrame,
    held: DataFrame,
    remote: DataFrame,
    floor: int = YEAR_FLOOR,
    ignore_case: bool = False,
) -> DataFrame:
    """Per issue: expected articles, those held, those held remotely, those to upload.

    Only issues since `floor` are examined; the others count 0 throughout.
    """
    flagged = with_holdings(articles.select("issue_url", "url"), held, remote, ignore_case)
    return reconcile(issues, flagged, floor)


def reconcile(issues: DataFrame, flagged: DataFrame, floor: int = YEAR_FLOOR) -> DataFrame:
    """`remote_reconcile` of articles that are flagged with `held` and `remote` already."""
    counts = flagged.groupBy("issue_url").agg(
        F.count("*").alias("expected"),
        F.count_if("held").alias("downloaded"),
        F.count_if("remote").alias("uploaded"),
        F.count_if(F.col("held") & ~F.col("remote")).alias("upload_candidates"),
    )
    names = ["expected", "downloaded", "uploaded", "upload_candidates"]
    examined = F.col("year") >= floor
    return _per_issue(issues, counts, names).withColumns(
        {name: F.when(examined, F.col(name)).otherwise(0) for name in names}
    )


def upload_candidates(
    issues: DataFrame,
    articles: DataFrame,
    held: DataFrame,
    remote: DataFrame,
    floor: int = YEAR_FLOOR,
    ignore_case: bool = False,
) -> DataFrame:
    """Articles of issues since `floor` whose file is held but not remotely: `(issue_url, url, name)`."""
    examined = issues.where(F.col("year") >= floor).select("issue_url").distinct()
    narrow = articles.select("issue_url", "url")
    wanted = lookup(narrow, examined, "issue_url", "left_semi")
    return to_upload(with_holdings(wanted, held, remote, ignore_case, base=narrow))


def to_upload(flagged: DataFrame) -> DataFrame:
    """`(issue_url, url, name)` of the articles whose file is held but not remotely."""
    return flagged.where(F.col("held") & ~F.col("remote")).select(
        "issue_url", "url", pdf_name(F.col("url")).alias("name")
    )


def remote_per_issue(
    issues: DataFrame,
    articles: DataFrame,
    held: DataFrame,
    remote: DataFrame,
    floor: int = YEAR_FLOOR,
) -> DataFrame:
    """Distinct file names held and held remotely, per issue since `floor`.

    Names are made distinct per issue before they are counted, in two shuffles that both combine
    map-side, so the names of a large issue do not meet in one task.
    """
    flagged = with_holdings(articles.select("issue_url", "url"), held, remote)
    names = (
        flagged.select("issue_url", pdf_name(F.col("url")).alias("name"), "held", "remote")
        .where(F.col("name").isNotNull())
        .distinct()
    )
    counts = names.groupBy("issue_url").agg(
        F.count_if("held").alias("downloaded"), F.count_if("remote").alias("uploaded")
    )
    return _per_issue(issues, counts, ["downloaded", "uploaded"]).where(F.col("year") >= floor)


def progress_per_issue(flagged: DataFrame, order: tuple[str, ...] = ("url",)) -> DataFrame:
    """Of articles flagged with `held`: how many per issue, how many held, and the next one to fetch.

    The next one is the first pending article with a URL in `order`, nulls last, ties by URL.
    """
    keys = [c for name in order for c in (F.isnull(name).alias(f"{name}_null"), F.col(name).alias(f"{name}_key"))]
    pending = ~F.col("held") & F.col("url").isNotNull()
    return flagged.groupBy("issue_url").agg(
        F.count_if("held").alias("downloaded"),
        F.count("*").alias("total"),
        F.min(F.when(pending, F.struct(*keys, "url")))["url"].alias("next_url"),
    )


def completeness_gate(issues: DataFrame, articles: DataFrame) -> DataFrame:
    """One row: may the article table be published?

    `complete` holds when no issue lacks articles. `complete_by_count` compares the number of
    distinct issues, null included, with the number of issue rows.
    """
    sides = issues.groupBy("issue_url").agg(
        F.count("*").alias("_rows"), F.lit(0).cast("long").alias("_articles")
    ).unionAll(
        articles.groupBy("issue_url").agg(
            F.lit(0).cast("long").alias("_rows"), F.count("*").alias("_articles")
        )
    )
    by_issue = sides.groupBy("issue_url").agg(
        F.sum("_rows").alias("_rows"), F.sum("_articles").alias("_articles")
    )
    counted = by_issue.agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("issue_rows"),
        F.count_if(F.col("_rows") > 0).alias("issues"),
        F.count_if(F.col("_articles") > 0).alias("issues_with_articles"),
        F.count_if((F.col("_rows") > 0) & (F.col("_articles") == 0)).alias("missing"),
    )
    return counted.withColumns(
        {
            "complete": F.col("missing") == 0,
            "complete_by_count": F.col("issues_with_articles") == F.col("issue_rows"),
        }
    )
