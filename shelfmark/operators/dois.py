"""DOIs of chosen articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.urls import doi_normalise, doi_suffix
from shelfmark.operators.select import issue_articles_inner, issue_articles_semi
from shelfmark.operators.skew import hot_keys, lookup


def doi_list(articles: DataFrame, start: int, end: int, distinct: bool = False) -> DataFrame:
    """DOIs of the articles of chosen issues.

    An issue with several chosen years repeats its DOIs; `distinct` lists each once.
    """
    narrow = articles.select("issue_url", "year", "url")
    if distinct:
        chosen = issue_articles_semi(narrow, start, end)
        return chosen.select(doi_normalise(F.col("url")).alias("doi")).distinct()
    chosen = issue_articles_inner(narrow, start, end)
    return chosen.select("issue_url", "selected_year", doi_normalise(F.col("url")).alias("doi"))


def pending_dois(dois: DataFrame, held: DataFrame, base: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """DOIs whose file is not held."""

    def name(column):
        return F.concat(doi_suffix(column, compat), F.lit(".pdf"))

    if base is None:
        hot = hot_keys(dois.select(name(F.col("doi")).alias("_name")), "_name")
    else:
        hot = hot_keys(base.select(name(doi_normalise(F.col("url"))).alias("_name")), "_name")
    names = held.select(F.col("name").alias("_name")).distinct()
    named = dois.withColumn("_name", name(F.col("doi")))
    return lookup(named, names, "_name", "left_anti", hot=hot).drop("_name")
