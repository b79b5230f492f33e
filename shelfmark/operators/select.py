"""Choice of work: ranges of years, articles of chosen issues, the next one to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.skew import hot_keys, lookup, number_rows

URL_ORDER = ("url",)
EXPORT_ORDER = ("file_name", "record_ordinal")


def table_order(articles: DataFrame) -> tuple[str, ...]:
    """The order of the exports, ties by URL, where the table carries it; else that of the URLs."""
    return (*EXPORT_ORDER, *URL_ORDER) if {*EXPORT_ORDER} <= {*articles.columns} else URL_ORDER


def _ascending(order: tuple[str, ...]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def in_years(start: int, end: int, year: str = "year") -> Column:
    """Both ends count; a null year is outside."""
    return F.col(year).between(start, end)


def filter_year_range(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.where(in_years(start, end))


def filter_year_floor(df: DataFrame, floor: int) -> DataFrame:
    return df.where(F.col("year") >= floor)


def distinct_issue_year(articles: DataFrame) -> DataFrame:
    return articles.select("issue_url", "year").distinct()


def distinct_issue(articles: DataFrame) -> DataFrame:
    return articles.select("issue_url").distinct()


def sort_issue_url(articles: DataFrame) -> DataFrame:
    """Sorted by issue and URL, nulls last. Equal rows may go to several tasks, by where they are now."""
    return articles.orderBy(
        F.col("issue_url").asc_nulls_last(), F.col("url").asc_nulls_last(), F.spark_partition_id()
    )


def first_per_issue(articles: DataFrame, order: tuple[str, ...] = URL_ORDER) -> DataFrame:
    """First article of each issue; rows without an issue belong to none.

    Each input partition passes on one row per issue at most, so a large issue is no large shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("issue_url").orderBy(*_ascending(order)))
    return (
        articles.where(F.col("issue_url").isNotNull())
        .withColumn("_rank", rank)
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def issue_articles_semi(articles: DataFrame, start: int, end: int) -> DataFrame:
    """All articles of issues with an article in the years, those of other years too."""
    chosen = distinct_issue(filter_year_range(articles, start, end))
    return lookup(articles, chosen, "issue_url", "left_semi")


def issue_articles_inner(articles: DataFrame, start: int, end: int) -> DataFrame:
    """Articles of each chosen `(issue, year)`; an issue with k such years has its articles k times.

    The years of an issue travel as one array, no longer than the range; `selected_year` is its item.
    """
    chosen = (
        distinct_issue_year(filter_year_range(articles, start, end))
        .groupBy("issue_url")
        .agg(F.sort_array(F.collect_list("year")).alias("_years"))
    )
    joined = lookup(articles, chosen, "issue_url", "inner")
    return joined.withColumn("selected_year", F.explode("_years")).drop("_years")


def articles_per_issue(articles: DataFrame, start: int, end: int) -> DataFrame:
    """`(issue_url, year, n_articles)` for each chosen `(issue, year)`, all articles of the issue counted.

    One pass: counts by issue and year first, the rest on those few rows.
    """
    by_year = articles.groupBy("issue_url", "year").agg(F.count("*").alias("_n"))
    by_issue = by_year.groupBy("issue_url").agg(
        F.sum("_n").alias("n_articles"),
        F.sort_array(F.collect_list(F.when(in_years(start, end), F.col("year")))).alias("_years"),
    )
    return by_issue.where(F.col("issue_url").isNotNull()).select(
        "issue_url", F.explode("_years").alias("year"), "n_articles"
    )


def collect_queue(pending: DataFrame, order: tuple[str, ...] = URL_ORDER) -> DataFrame:
    """The queue of each issue: pending articles with their place, equal rows once with their number.

    `order` and the issue must tell all other rows apart.
    """
    counted = pending.groupBy(*pending.columns).agg(F.count("*").alias("copies"))
    return number_rows(counted, "issue_url", _ascending(order), "copies")


def next_pending(pending: DataFrame, order: tuple[str, ...] = URL_ORDER) -> DataFrame:
    return first_per_issue(pending, order)


def missing_issues(issues: DataFrame, present: DataFrame, key: str = "issue_url") -> DataFrame:
    """Issues with no row in `present`, by issue URL or by the name of their export file."""
    return lookup(issues, present.select(key).distinct(), key, "left_anti", hot=hot_keys(issues, key))


def issues_without_archive(
    issues: DataFrame, names: DataFrame, archive: Column, start: int, end: int
) -> DataFrame:
    """Issues of the years whose archive, named `archive`, is not among `names (name)`, with that name."""
    wanted = issues.where(in_years(start, end)).withColumn("archive", archive)
    have = names.select(F.col("name").alias("archive")).distinct()
    return lookup(wanted, have, "archive", "left_anti")


def union_by_name(*feeds: DataFrame) -> DataFrame:
    """Rows of all feeds; a column a feed lacks is null there."""
    merged, *others = feeds
    for feed in others:
        merged = merged.unionByName(feed, allowMissingColumns=True)
    return merged
