"""Citation exports to records and articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import citations as ops
from shelfmark.plans import bindings
from shelfmark.plans.queries.registry import SPACE, as_text, query, views

_ISSUE = "'https://ex.org/stable/' || doc_id"

# One record with the whole text, then one per line.
_DOCUMENT_ARTICLES = (
    views("line")
    + f""" SELECT {_ISSUE} AS issue_url, CAST(0 AS INTEGER) AS record_ordinal, 'article' AS type,
                  'W' || doc_id AS cite_key, 'Whole ' || lang || ' text' AS title,
                  trim(replace(text, chr(10), ''), {SPACE}) AS abstract,
                  CAST(NULL AS VARCHAR) AS url, CAST(1990 AS INTEGER) AS year
           FROM documents
           UNION ALL
           SELECT {_ISSUE}, CAST(pos + 1 AS INTEGER), 'article', 'L' || doc_id || '-' || pos,
                  trim(line, {SPACE}), NULL, 'https://ex.org/d?doc=' || doc_id || '&line=' || pos,
                  CAST(1991 AS INTEGER)
           FROM line"""
)

_ARTICLE_COLUMNS = (
    "issue_url",
    "record_ordinal",
    "type",
    "cite_key",
    "title",
    "abstract",
    "url",
    "year",
)


@query(
    "bibtex_parse_a",
    """SELECT 'https://ex.org/stable/' || l_orderkey AS issue_url,
              '10.2307/' || key AS cite_key, 'article' AS type,
              CAST(l_suppkey AS VARCHAR) AS issn, 'https://ex.org/a/' || key AS url,
              CAST(l_linenumber AS VARCHAR) AS number, '1-' || l_partkey AS pages,
              CAST(year(l_shipdate) AS INTEGER) AS year
       FROM (SELECT *, l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS key
             FROM lineitem)""",
)
def _(spark, d):
    return ops.bibtex_parse(bindings.lineitem_exports(spark, d)).select(
        "issue_url", "cite_key", "type", "issn", "url", "number", "pages", "year"
    )


@query("bibtex_parse_a_documents", _DOCUMENT_ARTICLES)
def _(spark, d):
    return ops.bibtex_parse(bindings.document_exports(spark, d)).select(*_ARTICLE_COLUMNS)


@query("bibtex_parse_b", _DOCUMENT_ARTICLES)
def _(spark, d):
    exports = bindings.document_exports(spark, d, "b")
    return ops.bibtex_parse(exports, "b").select(*_ARTICLE_COLUMNS)


_NESTED_COLUMNS = ("issue_url", "record_ordinal", "type", "cite_key", "title", "author", "publisher", "journal", "note", "month", "year")


@query(
    "bibtex_parse_nested",
    """WITH o AS (
         SELECT 'https://ex.org/stable/' || o_orderkey AS issue_url, CAST(o_orderkey AS VARCHAR) AS k,
                'Press of J' || o_custkey AS press, o_orderpriority AS kind,
                CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS year FROM orders)
       SELECT issue_url, CAST(0 AS INTEGER) AS record_ordinal, 'article' AS type, 'A' || k AS cite_key,
              'Mail @home x, see, key = ' || k || ', b, more' AS title, CAST(NULL AS VARCHAR) AS author,
              press AS publisher, press || ': ' || kind || ' 7' AS journal,
              'Said ", key =  and ", year = 1' AS note, 'jan # kind' AS month, year FROM o
       UNION ALL
       SELECT issue_url, CAST(1 AS INTEGER), 'article', 'P' || k, 'In (parentheses), year = none',
              'A) and (B', NULL, press, NULL, NULL, year FROM o
       UNION ALL
       SELECT issue_url, CAST(2 AS INTEGER), 'book', 'B' || k, 'Never closed, @home x',
              NULL, NULL, NULL, NULL, NULL, '1900' FROM o
       UNION ALL
       SELECT issue_url, CAST(3 AS INTEGER), 'misc', 'C' || k, 'Closed twice', NULL, NULL, NULL, NULL, NULL, '1901' FROM o""",
)
def _(spark, d):
    articles = ops.bibtex_parse(bindings.nested_exports(spark, d))
    extra = [F.try_element_at("extra", F.lit(name)).alias(name) for name in ("note", "month")]
    return as_text(articles.select("*", *extra), "year").select(*_NESTED_COLUMNS)


def _literal_sql(banner: str, record_mark: str, skipped: int, field_mark: str) -> str:
    """The literal splitting, on the text as rendered, with line breaks already out."""
    return (
        views("line")
        + f""", flat AS (
            SELECT d.doc_id,
                   '{banner}@article{{W' || d.doc_id || ', title = {{Whole {{' || d.lang
                   || '}} text}}, abstract = {{' || replace(d.text, chr(10), '')
                   || '}}, year = {{1990}}}}' || l.body AS value
            FROM documents d JOIN (
              SELECT doc_id, string_agg('@article{{L' || doc_id || '-' || pos
                       || ', URL = {{https://ex.org/d?doc=' || doc_id || '&line=' || pos
                       || '}}, title = {{' || line || '}}, year = {{1991}}}}', '' ORDER BY pos) AS body
              FROM line GROUP BY doc_id) l ON d.doc_id = l.doc_id),
          pieces AS (
            SELECT doc_id, CAST(i - 1 - {skipped} AS INTEGER) AS record_ordinal, all_pieces[i] AS piece
            FROM (SELECT doc_id, string_split(value, '{record_mark}') AS all_pieces FROM flat),
                 unnest(generate_series({skipped + 1}, len(all_pieces))) AS g(i)),
          records AS (
            SELECT doc_id, record_ordinal,
                   CASE WHEN contains(piece, '{{') THEN substr(piece, 1, strpos(piece, '{{') - 1)
                        ELSE left(piece, CAST(length(piece) - 1 AS BIGINT)) END AS type,
                   string_split(replace(substr(piece, strpos(piece, ',') + 1), '{{', ''),
                                '{field_mark}') AS parts
            FROM pieces),
          fields AS (
            SELECT doc_id, record_ordinal, type, i, string_split(translate(parts[i], '{{}}', ''), '=') AS h
            FROM records, unnest(generate_series(1, len(parts))) AS g(i)
            WHERE contains(parts[i], '=')),
          trimmed AS (
            SELECT {_ISSUE} AS issue_url, record_ordinal, type, i, trim(h[1], {SPACE}) AS key,
                   trim(h[2], {SPACE}) AS value
            FROM fields)
          SELECT issue_url, record_ordinal, type, key, value FROM trimmed
          QUALIFY row_number() OVER (PARTITION BY issue_url, record_ordinal, key ORDER BY i DESC) = 1"""
    )


def _literal_fields(spark, d, dialect):
    exports = bindings.document_exports(spark, d, dialect)
    records = ops.citation_records(exports, dialect, compat=True)
    return records.select(
        "issue_url", "record_ordinal", "type", F.explode("fields").alias("key", "value")
    )


@query("bibtex_parse_a_compat", _literal_sql("@comment{{Provided}}", "@", 2, "}, "))
def _(spark, d):
    return _literal_fields(spark, d, "a")


@query("bibtex_parse_b_compat", _literal_sql("", "@article", 1, "},"))
def _(spark, d):
    return _literal_fields(spark, d, "b")


@query(
    "filter_bad_export",
    """SELECT o_orderkey || '.txt' AS file_name, 'https://ex.org/stable/' || o_orderkey AS issue_url
       FROM orders WHERE o_orderstatus = 'P'""",
)
def _(spark, d):
    _, rejected = ops.filter_bad_export(bindings.order_exports(spark, d))
    return rejected


@query(
    "filter_has_eq",
    views("line")
    + f""" SELECT {_ISSUE} AS issue_url, CAST(0 AS INTEGER) AS record_ordinal, 3 AS n_fields
           FROM documents
           UNION ALL SELECT {_ISSUE}, CAST(pos + 1 AS INTEGER), 3 FROM line""",
)
def _(spark, d):
    records = ops.citation_records(bindings.document_exports(spark, d))
    return records.select("issue_url", "record_ordinal", F.size("fields").alias("n_fields"))


_UNEVEN = """SELECT 'https://ex.org/stable/' || l_orderkey AS issue_url, CAST(l_linenumber AS INTEGER) AS line,
                    CAST(1 + l_linenumber // 2 AS INTEGER) AS n_fields FROM lineitem"""


def _fields_of_uneven(spark, d, compat):
    records = ops.citation_records(bindings.uneven_exports(spark, d), compat=compat)
    line = F.regexp_extract("file_name", r"-(\d+)\.txt$", 1).cast("int").alias("line")
    return records.select("issue_url", line, F.size("fields").alias("n_fields"))


@query("filter_has_eq_parts", _UNEVEN)
def _(spark, d):
    return _fields_of_uneven(spark, d, compat=False)


@query("filter_has_eq_parts_compat", _UNEVEN)
def _(spark, d):
    return _fields_of_uneven(spark, d, compat=True)


@query(
    "record_ordinal",
    views("line")
    + f""" SELECT {_ISSUE} AS issue_url, CAST(0 AS INTEGER) AS record_ordinal FROM documents
           UNION ALL SELECT {_ISSUE}, CAST(pos + 1 AS INTEGER) FROM line""",
)
def _(spark, d):
    pieces = ops.record_pieces(bindings.document_exports(spark, d))
    return pieces.select("issue_url", "record_ordinal")
