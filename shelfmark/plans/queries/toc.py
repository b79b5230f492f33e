"""Links and issues from pages."""

from __future__ import annotations

from shelfmark.operators import toc as ops
from shelfmark.plans import bindings
from shelfmark.plans.queries.registry import SPACE, query


def _decoded(text: str) -> str:
    return f"replace(replace(replace({text}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


_LINKS = rf"""
    WITH found AS (
      SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
             regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts
      FROM pages),
    links AS (
      SELECT page_id, url, CAST(i - 1 AS INTEGER) AS position, {_decoded("hrefs[i]")} AS href,
             trim({_decoded("texts[i]")}, {SPACE}) AS text
      FROM found, unnest(generate_series(1, len(hrefs))) AS g(i))"""


@query("links_extract", _LINKS + " SELECT page_id, position, href, text FROM links")
def _(spark, d):
    return ops.links_extract(bindings.spread_table(spark, d, "pages").select("page_id", "html"))


@query(
    "toc_issues_a",
    _LINKS
    + """ SELECT 'https://www.jstor.org' || href AS issue_url,
                 CAST(length(url) + 1900 AS INTEGER) AS year, text AS issue_text, url AS journal
          FROM links""",
)
def _(spark, d):
    pages = bindings.toc_pages(spark, d).select("journal", "html")
    return ops.toc_issues_a(pages).drop("no_docs")


@query(
    "filter_missing_attr",
    "SELECT page_id, CAST(length(url) + 1900 AS VARCHAR) AS data_year FROM pages",
)
def _(spark, d):
    return ops.year_blocks(bindings.toc_pages(spark, d)).select("page_id", "data_year")


@query(
    "toc_issues_b",
    """SELECT 'https://ex.org/j/' || o_custkey || '/' || o_orderkey AS issue_url,
              CAST(year(o_orderdate) AS INTEGER) AS year,
              'Pages 1-99 (' || strftime(o_orderdate, '%B %Y') || ')__Volume ' || o_custkey AS issue_text,
              'J' || o_custkey AS journal
       FROM orders""",
)
def _(spark, d):
    return ops.toc_issues_b(bindings.order_toc_b(spark, d)).select(
        "issue_url", "year", "issue_text", "journal"
    )
