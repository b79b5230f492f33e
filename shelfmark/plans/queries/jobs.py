"""The jobs end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfmark.functions.urls import issue_file_id_b
from shelfmark.operators.citations import parse_or_reject
from shelfmark.operators.select import in_years, missing_issues
from shelfmark.plans import bindings, jobs
from shelfmark.plans.queries.audits import PER_ISSUE
from shelfmark.plans.queries.records import RECORDS
from shelfmark.plans.queries.registry import END, FLOOR, START, as_text, query, views
from shelfmark.session import shared_dir
from shelfmark.sources.files import named_issue
from shelfmark.streaming import arrivals
from shelfmark.streaming.exports import current_articles, stream_exports


@query(
    "job_issue_index",
    """SELECT 'https://www.jstor.org/stable/' || o_orderkey AS issue_url,
              CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS issue_text,
              'J' || o_custkey AS journal
       FROM orders""",
)
def _(spark, d):
    return jobs.job_issue_index(bindings.order_toc_a(spark, d)).drop("no_docs")


_LOADED = """
    WITH good AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
    loaded AS (
      SELECT 'https://ex.org/stable/' || o_orderkey AS issue_url, o_orderkey || '.txt' AS file_name,
             CAST(0 AS INTEGER) AS record_ordinal, '10.2307/' || o_orderkey AS cite_key,
             'Customer ' || o_custkey AS author, 'The ' || o_orderpriority || ', and more' AS title,
             'https://ex.org/a/' || o_orderkey || '?customer=' || o_custkey AS url,
             CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS mail
      FROM good
      UNION ALL
      SELECT 'https://ex.org/stable/' || o_orderkey, o_orderkey || '.txt', CAST(1 AS INTEGER),
             '10.2307/' || o_orderkey || 'b', NULL, o_orderpriority,
             'https://ex.org/a/' || o_orderkey || 'b', NULL, o_orderstatus || '@ex.org'
      FROM good)"""
_LOADED_COLUMNS = ("issue_url", "file_name", "record_ordinal", "cite_key", "author", "title", "url", "year")


def _load(spark, d):
    return jobs.job_load_citations(bindings.order_exports(spark, d), bindings.issues(spark, d))


def _with_mail(articles):
    mail = F.try_element_at("extra", F.lit("mail")).alias("mail")
    return as_text(articles.select(*_LOADED_COLUMNS, mail), "year")


@query("job_load_citations", _LOADED + " SELECT * FROM loaded")
def _(spark, d):
    return _with_mail(_load(spark, d).articles)


@query(
    "job_load_citations_missing",
    "SELECT 'https://ex.org/stable/' || o_orderkey AS issue_url FROM orders WHERE o_orderstatus = 'P'",
)
def _(spark, d):
    return _load(spark, d).missing.select("issue_url")


@query(
    "job_load_citations_gate",
    _LOADED
    + """ SELECT count(*) AS issue_rows, count(*) AS issues,
                 (SELECT count(DISTINCT issue_url) FROM loaded) AS issues_with_articles,
                 count(*) FILTER (o_orderstatus = 'P') AS missing,
                 count(*) FILTER (o_orderstatus = 'P') = 0 AS complete,
                 (SELECT count(DISTINCT issue_url) FROM loaded) = count(*) AS complete_by_count
          FROM orders""",
)
def _(spark, d):
    return _load(spark, d).gate


@query("stream_exports", _LOADED + " SELECT * FROM loaded")
def _(spark, d):
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    exports = bindings.arriving_order_exports(spark, d)
    stream_exports(exports, f"{place}/table", f"{place}/state").awaitTermination()
    return _with_mail(current_articles(spark, f"{place}/table"))


_ORDERS_B = """WITH b AS (
      SELECT o_orderkey AS k, 'https://www.sciencedirect.com/journal/j' || o_custkey || '/vol/' || o_orderkey AS issue_url,
             'j' || o_custkey || '_vol_' || o_orderkey || '.bib' AS file_name, o_orderstatus <> 'P' AS good,
             o_orderpriority AS title, CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS year FROM orders)"""


def _load_b(spark, d):
    named = named_issue(bindings.order_exports_b(spark, d), bindings.issues_b(spark, d), issue_file_id_b(F.col("issue_url")))
    return as_text(parse_or_reject(named, "b"), "year")


@query(
    "job_load_citations_b",
    _ORDERS_B + " SELECT issue_url, file_name, 'K' || k AS cite_key, title, year FROM b WHERE good",
)
def _(spark, d):
    good = _load_b(spark, d).where("problem IS NULL")
    return good.select("issue_url", "file_name", "cite_key", "title", "year")


@query(
    "job_load_citations_b_rejected",
    _ORDERS_B
    + """ SELECT issue_url, file_name, 'failed export' AS problem FROM b WHERE NOT good
          UNION ALL SELECT NULL, 'x' || k || '.bib', 'no issue' FROM b WHERE k % 10 = 0""",
)
def _(spark, d):
    return _load_b(spark, d).where("problem IS NOT NULL").select("issue_url", "file_name", "problem")


@query(
    "missing_issues_by_file",
    _ORDERS_B + " SELECT issue_url, file_name FROM b WHERE NOT good",
)
def _(spark, d):
    """Issues whose export file, named after the issue's URL, has not come."""
    issues = bindings.issues_b(spark, d)
    issues = issues.withColumn("file_name", issue_file_id_b(F.col("issue_url")))
    come = bindings.order_exports_b(spark, d).where(~F.contains("value", F.lit(bindings.BAD_EXPORT)))
    return missing_issues(issues, come, "file_name").select("issue_url", "file_name")


@query(
    "job_archive_queue",
    views("issues")
    + f""" SELECT issue_url, year, list_last(string_split(issue_url, '/')) || '.zip' AS archive
           FROM issues JOIN orders ON issue_url = 'https://ex.org/stable/' || o_orderkey
           WHERE year BETWEEN {START} AND {END} AND o_custkey % 3 <> 0""",
)
def _(spark, d):
    archive = F.concat(bindings.issue_stem(), F.lit(".zip"))
    queue = jobs.job_archive_queue(bindings.issues(spark, d), bindings.order_files(spark, d), archive, START, END)
    return queue.select("issue_url", "year", "archive")


def _arrived(spark, d):
    place = f"{shared_dir(spark)}/arrivals-{uuid.uuid4().hex}"
    names = bindings.arriving_order_files(spark, d)
    arrivals.stream_arrivals(names, f"{place}/table", f"{place}/state").awaitTermination()
    known = arrivals.arrived(spark, f"{place}/table")
    return arrivals.issue_arrivals(bindings.issues(spark, d), known, bindings.issue_stem())


@query(
    "stream_arrivals",
    """SELECT 'https://ex.org/stable/' || o_orderkey AS issue_url,
              CAST((o_orderstatus <> 'P') AS INTEGER) + CAST((o_custkey % 7 = 0) AS INTEGER) AS n_exports,
              CAST((o_custkey % 3 = 0) AS INTEGER) AS n_archives,
              o_orderstatus <> 'P' OR o_custkey % 7 = 0 AS has_export, o_custkey % 3 = 0 AS has_archive
       FROM orders""",
)
def _(spark, d):
    has = [F.col(f"{kind}_at").isNotNull().alias(f"has_{kind}") for kind in ("export", "archive")]
    counts = [F.col(n).cast("int").alias(n) for n in ("n_exports", "n_archives")]
    return _arrived(spark, d).select("issue_url", *counts, *has)


@query(
    "stream_arrivals_pending",
    views("issues")
    + f""" SELECT issue_url, year FROM issues JOIN orders ON issue_url = 'https://ex.org/stable/' || o_orderkey
           WHERE year BETWEEN {START} AND {END} AND o_custkey % 3 <> 0""",
)
def _(spark, d):
    """The archive queue again, from the state of the stream."""
    pending = _arrived(spark, d).where(F.col("archive_at").isNull() & in_years(START, END))
    return pending.select("issue_url", "year")


@query("job_load_records", RECORDS)
def _(spark, d):
    load = jobs.job_load_records(bindings.record_pages(spark, d))
    return load.records.drop("authors_list", "affiliations_list", "citations_list")


@query(
    "job_load_records_quarantined",
    """SELECT page_id || '.htm' AS file_name, CAST(0 AS INTEGER) AS record_ordinal,
              'no record on the page; no document type; no header' AS problem FROM pages""",
)
def _(spark, d):
    load = jobs.job_load_records(bindings.record_pages(spark, d).unionByName(bindings.other_pages(spark, d)))
    return load.quarantined.select("file_name", "record_ordinal", "problem")


_CHOSEN = (
    views("flagged_places")
    + f""", chosen AS (
        SELECT * FROM flagged_places WHERE issue_url IN (
          SELECT issue_url FROM placed WHERE year BETWEEN {START} AND {END}))"""
)


@query(
    "job_work_queue",
    _CHOSEN
    + """ SELECT issue_url, count(*) FILTER (held) AS downloaded, count(*) AS total,
                 replace(arg_min(url, (file_name, record_ordinal, url)) FILTER (NOT held), 'https://ex.org/', 'https://proxy.example.org/')
                   AS next_url
          FROM chosen GROUP BY issue_url HAVING count(*) FILTER (NOT held) > 0""",
)
def _(spark, d):
    return jobs.job_work_queue(
        bindings.placed_articles(spark, d),
        bindings.holdings(spark, d),
        START,
        END,
        F.lit("proxy.example.org"),
    ).progress


@query(
    "job_work_queue_positions",
    _CHOSEN
    + """ SELECT issue_url, url, file_name, record_ordinal, count(*) AS copies, min(place) AS position
          FROM (SELECT *, row_number() OVER (
                            PARTITION BY issue_url ORDER BY file_name, record_ordinal, url) AS place
                FROM chosen WHERE NOT held)
          GROUP BY issue_url, url, file_name, record_ordinal""",
)
def _(spark, d):
    work = jobs.job_work_queue(
        bindings.placed_articles(spark, d), bindings.holdings(spark, d), START, END
    )
    return jobs.ordered_queue(work)


_CHOSEN_DOIS = (
    views("dois")
    + f""", chosen AS (
        SELECT a.issue_url, s.year AS selected_year, a.doi
        FROM dois a JOIN (SELECT DISTINCT issue_url, year FROM dois
                          WHERE year BETWEEN {START} AND {END}) s ON a.issue_url = s.issue_url),
      held AS (SELECT regexp_replace(doi, '^.*/', '') AS stem FROM dois WHERE l_returnflag = 'R'),
      pending AS (SELECT * FROM chosen
                  WHERE regexp_replace(doi, '^.*/', '') NOT IN (SELECT stem FROM held))"""
)


@query("job_doi_list", _CHOSEN_DOIS + " SELECT issue_url, selected_year, doi FROM pending")
def _(spark, d):
    return jobs.job_doi_list(
        bindings.doi_articles(spark, d), bindings.doi_holdings(spark, d), START, END
    )


@query("job_doi_list_distinct", _CHOSEN_DOIS + " SELECT DISTINCT doi FROM pending")
def _(spark, d):
    return jobs.job_doi_list(
        bindings.doi_articles(spark, d), bindings.doi_holdings(spark, d), START, END, distinct=True
    )


def _corpus(spark, d):
    return bindings.issues(spark, d), bindings.articles(spark, d), bindings.holdings(spark, d)


@query(
    "job_holdings_audit",
    PER_ISSUE + " SELECT year, no_docs, issue_url, expected, downloaded FROM per_issue",
)
def _(spark, d):
    audit = jobs.job_holdings_audit(*_corpus(spark, d), floor=FLOOR)
    return as_text(audit.per_issue, "no_docs")


@query(
    "job_holdings_audit_totals",
    PER_ISSUE
    + f""" SELECT CAST(sum(downloaded) AS BIGINT) AS held_total,
                  CAST(sum(expected) FILTER (year >= {FLOOR}) AS BIGINT) AS expected_since
           FROM per_issue""",
)
def _(spark, d):
    return jobs.job_holdings_audit(*_corpus(spark, d), floor=FLOOR).totals


@query(
    "job_remote_audit",
    PER_ISSUE
    + f""" SELECT year, no_docs, issue_url,
                  CASE WHEN year >= {FLOOR} THEN expected ELSE 0 END AS expected,
                  CASE WHEN year >= {FLOOR} THEN downloaded ELSE 0 END AS downloaded,
                  CASE WHEN year >= {FLOOR} THEN uploaded ELSE 0 END AS uploaded,
                  CASE WHEN year >= {FLOOR} THEN upload_candidates ELSE 0 END AS upload_candidates
           FROM per_issue""",
)
def _(spark, d):
    audit = jobs.job_remote_audit(
        *_corpus(spark, d), bindings.remote_holdings(spark, d), floor=FLOOR
    )
    return as_text(audit.per_issue, "no_docs")
