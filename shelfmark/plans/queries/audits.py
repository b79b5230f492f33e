"""Expected articles against held files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfmark.operators import holdings as ops
from shelfmark.operators.select import table_order
from shelfmark.plans import bindings
from shelfmark.plans.jobs import job_bucketed_audit
from shelfmark.plans.queries.registry import FLOOR, REGISTRY, as_text, query, views
from shelfmark.session import shared_dir
from shelfmark.sources import bucketed

PER_ISSUE = (
    views("issues", "flagged")
    + """, per_issue AS (
        SELECT i.year, i.no_docs, i.issue_url, count(f.url) AS expected,
               count(*) FILTER (f.held) AS downloaded, count(*) FILTER (f.remote) AS uploaded,
               count(*) FILTER (f.held AND NOT f.remote) AS upload_candidates
        FROM issues i LEFT JOIN flagged f ON i.issue_url = f.issue_url
        GROUP BY i.year, i.no_docs, i.issue_url)"""
)


def _corpus(spark, d):
    return bindings.issues(spark, d), bindings.articles(spark, d), bindings.holdings(spark, d)


@query(
    "issue_articles_left",
    views("issues", "articles")
    + """ SELECT i.issue_url, i.year, count(a.url) AS n_articles
          FROM issues i LEFT JOIN articles a ON i.issue_url = a.issue_url GROUP BY 1, 2""",
)
def _(spark, d):
    issues, articles, _ = _corpus(spark, d)
    return ops.issue_articles_left(issues.select("issue_url", "year"), articles)


@query(
    "holdings_semi",
    views("named", "holdings")
    + " SELECT issue_url, url, year FROM named WHERE name IN (SELECT name FROM holdings)",
)
def _(spark, d):
    _, articles, held = _corpus(spark, d)
    return ops.holdings_semi(articles, held)


@query(
    "pending_anti",
    views("named", "holdings")
    + " SELECT issue_url, url, year FROM named WHERE name NOT IN (SELECT name FROM holdings)",
)
def _(spark, d):
    _, articles, held = _corpus(spark, d)
    return ops.pending_anti(articles, held)


@query(
    "held_per_issue",
    PER_ISSUE + " SELECT year, no_docs, issue_url, expected, downloaded FROM per_issue",
)
def _(spark, d):
    return as_text(ops.held_per_issue(*_corpus(spark, d)), "no_docs")


@query(
    "held_total",
    PER_ISSUE + " SELECT CAST(sum(downloaded) AS BIGINT) AS held_total FROM per_issue",
)
def _(spark, d):
    return ops.held_totals(ops.held_per_issue(*_corpus(spark, d)), FLOOR).select("held_total")


@query(
    "expected_since",
    PER_ISSUE
    + f""" SELECT CAST(sum(expected) AS BIGINT) AS expected_since
           FROM per_issue WHERE year >= {FLOOR}""",
)
def _(spark, d):
    issues, articles, _ = _corpus(spark, d)
    counts = ops.issue_articles_left(issues.select("issue_url", "year"), articles)
    return counts.where(F.col("year") >= FLOOR).agg(F.sum("n_articles").alias("expected_since"))


@query(
    "progress_per_issue",
    views("flagged_places")
    + """ SELECT issue_url, count(*) FILTER (held) AS downloaded, count(*) AS total,
                 arg_min(url, (file_name, record_ordinal, url)) FILTER (NOT held) AS next_url
          FROM flagged_places GROUP BY issue_url""",
)
def _(spark, d):
    articles, held = bindings.placed_articles(spark, d), bindings.holdings(spark, d)
    return ops.progress_per_issue(ops.with_holdings(articles, held), table_order(articles))


@query(
    "completeness_gate",
    views("issues", "articles")
    + """, missing AS (
            SELECT count(*) AS n FROM issues
            WHERE issue_url NOT IN (SELECT issue_url FROM articles))
          SELECT count(*) AS issue_rows, count(DISTINCT issue_url) AS issues,
                 (SELECT count(DISTINCT issue_url) FROM articles) AS issues_with_articles,
                 (SELECT n FROM missing) AS missing, (SELECT n FROM missing) = 0 AS complete,
                 (SELECT count(DISTINCT issue_url) FROM articles) = count(*) AS complete_by_count
          FROM issues""",
)
def _(spark, d):
    issues, articles, _ = _corpus(spark, d)
    return ops.completeness_gate(issues, articles)


@query(
    "remote_reconcile",
    PER_ISSUE
    + f""" SELECT year, no_docs, issue_url,
                  CASE WHEN year >= {FLOOR} THEN expected ELSE 0 END AS expected,
                  CASE WHEN year >= {FLOOR} THEN downloaded ELSE 0 END AS downloaded,
                  CASE WHEN year >= {FLOOR} THEN uploaded ELSE 0 END AS uploaded,
                  CASE WHEN year >= {FLOOR} THEN upload_candidates ELSE 0 END AS upload_candidates
           FROM per_issue""",
)
def _(spark, d):
    per_issue = ops.remote_reconcile(
        *_corpus(spark, d), bindings.remote_holdings(spark, d), floor=FLOOR
    )
    return as_text(per_issue, "no_docs")


@query(
    "remote_per_issue",
    views("issues", "flagged")
    + f""" SELECT i.year, i.no_docs, i.issue_url,
                  count(DISTINCT f.name) FILTER (f.held) AS downloaded,
                  count(DISTINCT f.name) FILTER (f.remote) AS uploaded
           FROM issues i LEFT JOIN flagged f ON i.issue_url = f.issue_url
           WHERE i.year >= {FLOOR} GROUP BY 1, 2, 3""",
)
def _(spark, d):
    per_issue = ops.remote_per_issue(
        *_corpus(spark, d), bindings.remote_holdings(spark, d), floor=FLOOR
    )
    return as_text(per_issue, "no_docs")


@query(
    "upload_candidates",
    views("issues", "flagged")
    + f""" SELECT f.issue_url, f.url, f.name FROM flagged f
           WHERE f.held AND NOT f.remote
             AND f.issue_url IN (SELECT issue_url FROM issues WHERE year >= {FLOOR})""",
)
def _(spark, d):
    return ops.upload_candidates(
        *_corpus(spark, d), bindings.remote_holdings(spark, d), floor=FLOOR
    )


def _bucketed(spark, d):
    """The store of a table folder, in the shared folder."""
    store = f"{shared_dir(spark)}/bucketed-{uuid.uuid4().hex}"
    _, articles, held = _corpus(spark, d)
    bucketed.bucket_articles(articles, store)
    bucketed.bucket_listings(held, bindings.remote_holdings(spark, d), store)
    return store


@query("holdings_semi_bucketed", REGISTRY["holdings_semi"].sql)
def _(spark, d):
    return bucketed.holdings_semi(spark, _bucketed(spark, d))


@query("pending_anti_bucketed", REGISTRY["pending_anti"].sql)
def _(spark, d):
    return bucketed.pending_anti(spark, _bucketed(spark, d))


@query("remote_reconcile_bucketed", REGISTRY["remote_reconcile"].sql)
def _(spark, d):
    flagged = bucketed.with_holdings(spark, _bucketed(spark, d))
    return as_text(job_bucketed_audit(bindings.issues(spark, d), flagged, FLOOR).per_issue, "no_docs")
