"""Saved result pages to records."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import records as ops
from shelfmark.plans import bindings
from shelfmark.plans.queries.registry import query, views

_HEADER = """
    CAST(n_chars % 100 + 1920 AS VARCHAR) AS year, 'Journal of ' || source AS journal,
    CAST(n_chars AS VARCHAR) AS volume, CAST(doc_id AS VARCHAR) AS issue, '1-' || n_chars AS pages"""

_AFFILIATIONS = "'a--University of ' || source || ' & Sons' || chr(10) || 'b--' || lang"
_AUTHORS = "'A, ' || lang || '.--a--' || chr(10) || 'B, ' || source || '.--b----c--'"

RECORDS = (
    views("line")
    + f""", cited AS (
        SELECT doc_id, string_agg(pos || '|' || line || ' ', '--' || chr(10) ORDER BY pos) AS citations
        FROM line WHERE line <> '' GROUP BY doc_id),
      numbered AS (
        SELECT l.*, c.citations, r.record_ordinal, r.record_ordinal = 0 AS f
        FROM lines l LEFT JOIN cited c ON l.doc_id = c.doc_id
        CROSS JOIN (SELECT CAST(unnest([0, 1]) AS INTEGER) AS record_ordinal) r)
      SELECT doc_id || '.html' AS file_name, record_ordinal,
             CASE WHEN f THEN {_AUTHORS} END AS authors, parts[1] AS title, {_HEADER},
             CASE WHEN f THEN '10.5555/' || doc_id END AS doi,
             CASE WHEN f THEN {_AFFILIATIONS} END AS affiliations,
             CASE WHEN f THEN text END AS abstract,
             CASE WHEN f THEN coalesce(citations, '') END AS citations,
             'Article' AS document_type, CASE WHEN f THEN source END AS index_keywords,
             lang AS author_keywords
      FROM numbered"""
)


def _records(spark, d):
    return ops.scopus_records(bindings.record_pages(spark, d))


@query("scopus_records", RECORDS)
def _(spark, d):
    return _records(spark, d).drop(
        "authors_list", "affiliations_list", "citations_list", "problem"
    )


_HEADER_SQL = f"SELECT doc_id, {_HEADER} FROM documents"


@query("scopus_header", _HEADER_SQL)
def _(spark, d):
    lines = bindings.table(spark, d, "documents").select(
        "doc_id", bindings.reference_line().alias("line")
    )
    return lines.withColumns(ops.scopus_header(F.col("line"))).drop("line")


@query(
    "scopus_header_compat",
    _HEADER_SQL
    + """ UNION ALL
      SELECT doc_id, CAST(n_chars % 100 + 1920 AS VARCHAR), 'Journal', 'of',
             substr(source, 2, greatest(length(source) - 2, 0)), '1-' || n_chars FROM documents""",
)
def _(spark, d):
    line = bindings.reference_line()
    # A comma in the journal's name, where the literal reading goes wrong.
    parted = F.replace(line, F.lit("Journal of"), F.lit("Journal, of"))
    lines = bindings.table(spark, d, "documents").select("doc_id", F.explode(F.array(line, parted)).alias("line"))
    return lines.withColumns(ops.scopus_header(F.col("line"), compat=True)).drop("line")


@query(
    "scopus_authors",
    """SELECT doc_id || '.html' AS file_name, CAST(0 AS INTEGER) AS record_ordinal,
              CAST(0 AS INTEGER) AS author_position, 'A, ' || lang || '.' AS author, 'a' AS marks
       FROM documents
       UNION ALL
       SELECT doc_id || '.html', CAST(0 AS INTEGER), CAST(1 AS INTEGER), 'B, ' || source || '.', 'b,c'
       FROM documents""",
)
def _(spark, d):
    rows = ops.author_rows(_records(spark, d))
    return rows.withColumn("marks", F.array_join("marks", ","))


@query(
    "scopus_affiliations",
    """SELECT doc_id || '.html' AS file_name, CAST(0 AS INTEGER) AS position,
              'a--University of ' || source || ' & Sons' AS affiliation
       FROM documents
       UNION ALL
       SELECT doc_id || '.html', CAST(1 AS INTEGER), 'b--' || lang FROM documents""",
)
def _(spark, d):
    return ops.affiliation_rows(_records(spark, d)).drop("record_ordinal")


_CELLS = (
    views("line")
    + """, cells AS (
        SELECT doc_id || '.html' AS file_name, CAST(0 AS INTEGER) AS record_ordinal,
               CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER)
                 AS reference_position, pos, line
        FROM line WHERE line <> '')"""
)


@query(
    "scopus_citations",
    _CELLS
    + """ SELECT file_name, record_ordinal, reference_position, CAST(0 AS INTEGER) AS span_position,
                 CAST(pos AS VARCHAR) AS text FROM cells
          UNION ALL
          SELECT file_name, record_ordinal, reference_position, CAST(1 AS INTEGER), line || ' '
          FROM cells""",
)
def _(spark, d):
    return ops.citation_rows(_records(spark, d))


@query(
    "filter_nonempty_cell",
    _CELLS + " SELECT file_name, reference_position, pos || '|' || line || ' ' AS cell FROM cells",
)
def _(spark, d):
    spans = ops.citation_cells(_records(spark, d))
    return spans.select(
        "file_name", "reference_position", F.array_join("cell", "|").alias("cell")
    )


@query(
    "section_position",
    """SELECT doc_id || '.html' AS file_name, CAST(r AS INTEGER) AS record_ordinal,
              CAST(p AS INTEGER) AS position
       FROM documents,
            (VALUES (0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (1, 0), (1, 3)) AS t(r, p)""",
)
def _(spark, d):
    blocks = ops.record_blocks(bindings.record_pages(spark, d))
    return ops.section_positions(blocks).drop("section")
