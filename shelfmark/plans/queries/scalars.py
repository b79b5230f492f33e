"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import text, urls
from shelfmark.plans import bindings
from shelfmark.plans.queries.registry import SPACE, query, views


@query(
    "issue_file_id_a",
    """SELECT issue_url, o_orderkey || '.txt' AS file_name
       FROM (SELECT 'https://www.jstor.org/stable/10.2307/' || o_orderkey AS issue_url, o_orderkey
             FROM orders)""",
)
def _(spark, d):
    url = F.concat(F.lit(urls.ISSUE_PREFIX_A), F.col("o_orderkey").cast("string"))
    orders = bindings.table(spark, d, "orders").select(url.alias("issue_url"))
    return orders.withColumn("file_name", urls.issue_file_id_a(F.col("issue_url")))


@query(
    "issue_file_id_b",
    """SELECT 'https://www.sciencedirect.com/journal/' || o_custkey || '/vol/' || o_orderkey AS issue_url,
              o_custkey || '_vol_' || o_orderkey || '.bib' AS export_name,
              o_custkey || '_vol_' || o_orderkey || '.zip' AS archive_name
       FROM orders""",
)
def _(spark, d):
    url = F.concat(
        F.lit(urls.ISSUE_PREFIX_B),
        F.col("o_custkey").cast("string"),
        F.lit("/vol/"),
        F.col("o_orderkey").cast("string"),
    )
    orders = bindings.table(spark, d, "orders").select(url.alias("issue_url"))
    return orders.select(
        "issue_url",
        urls.issue_file_id_b(F.col("issue_url")).alias("export_name"),
        urls.issue_file_id_b(F.col("issue_url"), extension=".zip").alias("archive_name"),
    )


@query(
    "pdf_name",
    "SELECT page_id, list_last(string_split(url, '/')) || '.pdf' AS name FROM pages",
)
def _(spark, d):
    return bindings.table(spark, d, "pages").select(
        "page_id", urls.pdf_name(F.col("url")).alias("name")
    )


@query("doi_normalise", views("dois") + " SELECT issue_url, doi FROM dois")
def _(spark, d):
    return bindings.doi_articles(spark, d).select(
        "issue_url", urls.doi_normalise(F.col("url")).alias("doi")
    )


@query(
    "doi_suffix",
    views("dois")
    + """ SELECT doi, regexp_replace(doi, '^.*/', '') AS last_segment, substr(doi, 9) AS after_registrant
          FROM dois""",
)
def _(spark, d):
    dois = bindings.doi_articles(spark, d).select(urls.doi_normalise(F.col("url")).alias("doi"))
    return dois.select(
        "doi",
        urls.doi_suffix(F.col("doi")).alias("last_segment"),
        urls.doi_suffix(F.col("doi"), compat=True).alias("after_registrant"),
    )


@query(
    "url_host",
    "SELECT page_id, nullif(regexp_extract(url, 'https://(.+?)/', 1), '') AS host FROM pages",
)
def _(spark, d):
    return bindings.table(spark, d, "pages").select(
        "page_id", urls.url_host(F.col("url")).alias("host")
    )


@query(
    "url_rehost",
    """SELECT page_id, regexp_replace(url || '?u=' || url, 'https?://(.+?)/',
                                      'https://proxy.example.org/', 'g') AS url
       FROM pages""",
)
def _(spark, d):
    twice = F.concat("url", F.lit("?u="), "url")
    return bindings.table(spark, d, "pages").select(
        "page_id", urls.url_rehost(twice, F.lit("proxy.example.org")).alias("url")
    )


@query(
    "url_absolutise",
    "SELECT o_orderkey, 'https://www.jstor.org/stable/' || o_orderkey AS url FROM orders",
)
def _(spark, d):
    href = F.concat(F.lit("/stable/"), F.col("o_orderkey").cast("string"))
    return bindings.table(spark, d, "orders").select(
        "o_orderkey", urls.url_absolutise(href).alias("url")
    )


@query(
    "download_filename",
    """SELECT page_id, list_last(string_split(url, '/')) AS file_name,
              CAST(NULL AS VARCHAR) AS without_mark
       FROM pages""",
)
def _(spark, d):
    return bindings.table(spark, d, "pages").select(
        "page_id",
        urls.download_filename(F.concat("url", F.lit("?download=true"))).alias("file_name"),
        urls.download_filename(F.col("url")).alias("without_mark"),
    )


@query("attr_slice", "SELECT page_id, url FROM pages")
def _(spark, d):
    attribute = F.concat(F.lit("location.href='"), "url", F.lit("'"))
    return bindings.table(spark, d, "pages").select(
        "page_id", urls.attr_slice(attribute).alias("url")
    )


@query("newline_strip", "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents")
def _(spark, d):
    crlf = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    return bindings.table(spark, d, "documents").select(
        "doc_id", text.newline_strip(crlf).alias("text")
    )


@query(
    "nbsp_normalise",
    """SELECT doc_id, text AS spaced, replace(text, ' ', '') AS removed FROM documents""",
)
def _(spark, d):
    hard = F.translate("text", " ", text.NBSP)
    return bindings.table(spark, d, "documents").select(
        "doc_id",
        text.nbsp_normalise(hard).alias("spaced"),
        text.nbsp_normalise(hard, "").alias("removed"),
    )


@query("markup_strip", "SELECT page_id, regexp_replace(html, '<.+?>', '', 'g') AS text FROM pages")
def _(spark, d):
    return bindings.table(spark, d, "pages").select(
        "page_id", text.markup_strip(F.col("html")).alias("text")
    )


@query("whitespace_strip", f"SELECT doc_id, trim(text, {SPACE}) AS text FROM documents")
def _(spark, d):
    padded = F.concat(F.lit("\t  "), "text", F.lit(" 　\r\n\x1f"))
    return bindings.table(spark, d, "documents").select(
        "doc_id", text.whitespace_strip(padded).alias("text")
    )


@query("doc_type", "SELECT doc_id, ' ' || lang || ' ' AS document_type FROM documents")
def _(spark, d):
    block = F.concat(F.lit("Document Type: "), "lang", F.lit(" Publication Stage: Final "), "text")
    return bindings.table(spark, d, "documents").select(
        "doc_id", text.doc_type(block).alias("document_type")
    )


@query(
    "issue_label",
    "SELECT o_orderkey, o_orderstatus || '__' || o_orderpriority AS issue_text FROM orders",
)
def _(spark, d):
    return bindings.table(spark, d, "orders").select(
        "o_orderkey",
        text.issue_label(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("issue_text"),
    )


@query(
    "year_cast",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS plain,
              CAST(year(o_orderdate) AS INTEGER) AS decimal_form, CAST(NULL AS VARCHAR) AS no_year
       FROM orders""",
)
def _(spark, d):
    year = F.year("o_orderdate").cast("string")
    return bindings.table(spark, d, "orders").select(
        "o_orderkey",
        text.year_cast(F.concat(F.lit(" "), year)).alias("plain"),
        text.year_cast(F.concat(year, F.lit(".0"))).alias("decimal_form"),
        text.year_cast(F.col("o_orderpriority")).cast("string").alias("no_year"),
    )
