"""Scans, filters, selection of work, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import select
from shelfmark.operators.holdings import pending_anti
from shelfmark.plans import bindings
from shelfmark.plans.queries.registry import END, FLOOR, START, as_text, query, views
from shelfmark.sources.files import filter_ext, with_url

_IN_RANGE = f"year BETWEEN {START} AND {END}"


@query("scan_issues", views("issues") + " SELECT * FROM issues")
def _(spark, d):
    return as_text(bindings.issues(spark, d), "no_docs")


@query("scan_articles", views("articles") + " SELECT issue_url, url, year FROM articles")
def _(spark, d):
    older = bindings.articles(spark, d).withColumnRenamed("url", "stable_url")
    return with_url(older)


@query(
    "scan_holdings",
    views("holdings") + " SELECT name FROM holdings",
)
def _(spark, d):
    return filter_ext(bindings.holdings(spark, d), "name", ".pdf").distinct()


@query(
    "scan_remote_holdings",
    """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id
       FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'N'""",
)
def _(spark, d):
    listing = bindings.remote_holdings(spark, d)
    return listing.where(F.col("mime_type") == "application/pdf").select("id")


@query("filter_year_range", views("articles") + f" SELECT * FROM articles WHERE {_IN_RANGE}")
def _(spark, d):
    return select.filter_year_range(bindings.articles(spark, d), START, END)


@query("filter_year_floor", views("issues") + f" SELECT issue_url, year FROM issues WHERE year >= {FLOOR}")
def _(spark, d):
    return select.filter_year_floor(bindings.issues(spark, d), FLOOR).select("issue_url", "year")


@query("filter_ext", "SELECT page_id, url FROM pages WHERE url LIKE '%.html' AND contains(url, '/en/')")
def _(spark, d):
    return filter_ext(bindings.table(spark, d, "pages").select("page_id", "url"), "url", ".html", "/en/")


@query(
    "first_per_issue",
    views("articles")
    + f""" SELECT issue_url, url, year FROM articles WHERE {_IN_RANGE}
           QUALIFY row_number() OVER (PARTITION BY issue_url ORDER BY url) = 1""",
)
def _(spark, d):
    return select.first_per_issue(
        select.filter_year_range(bindings.articles(spark, d), START, END)
    )


@query(
    "issue_articles_semi",
    views("articles")
    + f""" SELECT * FROM articles
           WHERE issue_url IN (SELECT issue_url FROM articles WHERE {_IN_RANGE})""",
)
def _(spark, d):
    return select.issue_articles_semi(bindings.articles(spark, d), START, END)


@query(
    "issue_articles_inner",
    views("articles")
    + f""" SELECT a.issue_url, a.url, a.year, s.year AS selected_year
           FROM articles a JOIN (SELECT DISTINCT issue_url, year FROM articles WHERE {_IN_RANGE}) s
             ON a.issue_url = s.issue_url""",
)
def _(spark, d):
    return select.issue_articles_inner(bindings.articles(spark, d), START, END)


@query(
    "articles_per_issue",
    views("articles")
    + f""" SELECT s.issue_url, s.year, n.n_articles
           FROM (SELECT DISTINCT issue_url, year FROM articles WHERE {_IN_RANGE}) s
           JOIN (SELECT issue_url, count(*) AS n_articles FROM articles GROUP BY 1) n USING (issue_url)""",
)
def _(spark, d):
    return select.articles_per_issue(bindings.articles(spark, d), START, END)


@query(
    "missing_issues",
    views("issues", "articles")
    + """ SELECT issue_url, year FROM issues
          WHERE issue_url NOT IN (SELECT issue_url FROM articles)""",
)
def _(spark, d):
    missing = select.missing_issues(bindings.issues(spark, d), bindings.articles(spark, d))
    return missing.select("issue_url", "year")


_PENDING = "FROM named WHERE name NOT IN (SELECT name FROM holdings)"


@query(
    "collect_queue",
    views("named", "holdings")
    + f""" SELECT issue_url, url, count(*) AS copies, min(place) AS position
           FROM (SELECT issue_url, url,
                        row_number() OVER (PARTITION BY issue_url ORDER BY url) AS place {_PENDING})
           GROUP BY issue_url, url""",
)
def _(spark, d):
    narrow = bindings.articles(spark, d).select("issue_url", "url")
    return select.collect_queue(pending_anti(narrow, bindings.holdings(spark, d)))


@query(
    "next_pending",
    views("named", "holdings") + f" SELECT issue_url, min(url) AS url {_PENDING} GROUP BY issue_url",
)
def _(spark, d):
    narrow = bindings.articles(spark, d).select("issue_url", "url")
    return select.next_pending(pending_anti(narrow, bindings.holdings(spark, d)))


@query("sort_issue_url", views("articles") + " SELECT * FROM articles ORDER BY issue_url, url")
def _(spark, d):
    return select.sort_issue_url(bindings.articles(spark, d))


@query(
    "union_by_name",
    views("articles", "issues")
    + """ SELECT issue_url, url, year, CAST(NULL AS VARCHAR) AS journal FROM articles
          UNION ALL SELECT issue_url, NULL, year, journal FROM issues""",
)
def _(spark, d):
    return select.union_by_name(
        bindings.articles(spark, d), bindings.issues(spark, d).select("issue_url", "year", "journal")
    )


@query("distinct_issue_year", views("articles") + " SELECT DISTINCT issue_url, year FROM articles")
def _(spark, d):
    return select.distinct_issue_year(bindings.articles(spark, d))


@query("distinct_issue", views("articles") + " SELECT DISTINCT issue_url FROM articles")
def _(spark, d):
    return select.distinct_issue(bindings.articles(spark, d))
