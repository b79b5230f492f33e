"""Saved result pages of a bibliographic database to records.

A record is a container; its sections count by position: header, affiliations, abstract, author
keywords, index keywords, citations. An empty section keeps its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.markup import (
    bare_text,
    elements,
    first_element,
    normal_tags,
    text_after,
    without_tags,
)
from shelfmark.functions.entities import unescape, unescape_nested
from shelfmark.functions.text import (
    doc_type,
    hard_spaces,
    markup_strip,
    nbsp_normalise,
    pieces_after,
    pinned,
    whitespace_strip,
)
from shelfmark.schemas import RECORD_COLUMNS

# Class names of the export.
CONTAINER = "container"
SECTION = "margin: 0px 0px 13px 0px"
FIELD = "txt"
BOLD_FIELD = "txtBold"

SECTIONS = ("header", "affiliations", "abstract", "author_keywords", "index_keywords", "citations")

# The reference line: (year) journal, volume (issue), pp. first-last. Other remarks.
_YEAR = r"^\s*\(([^)]*)\)"
_PAGES = r",\s*pp?\.\s+(.*?)\s*(?:\.(?:\s|$)|$)"
_HEAD = r"(?is)^\s*\([^)]*\)\s*(.*?)\s*(?:,\s*(?:pp?\.|art\. no\.).*)?$"
#: A volume has a digit, is a Roman number, or is one word before an issue with a digit.
_VOLUME = r",\s*([A-Za-z]?\d[^\s,()]*|[IVXLCDM]+|[A-Za-z.]+(?=\s*\([^)]*\d))\s*(?:\(([^)]*)\))?\s*$"
#: Left in the journal: numbers after a comma, which no pattern took.
_UNREAD = r",[^,]*\d[^,]*$"


def record_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per container: `(…, record_ordinal, block)`; a page without one has a null block."""
    kept = [c for c in pages.columns if c != html]
    found = F.posexplode_outer(elements(normal_tags(F.col(html)), "div", cls=CONTAINER))
    return pages.select(*kept, found.alias("_place", "block")).select(
        *kept, F.coalesce("_place", F.lit(0)).alias("record_ordinal"), "block"
    )


def record_sections(blocks: DataFrame) -> DataFrame:
    """Adds the sections of each record as an array in order of position."""
    return blocks.withColumn("sections", elements(F.col("block"), "div", cls=SECTION, exact=True))


def section_positions(blocks: DataFrame) -> DataFrame:
    """One row per section: `(…, position, section)`; empty ones are dropped, positions are not."""
    kept = [c for c in blocks.columns if c != "block"]
    return (
        record_sections(blocks)
        .select(*kept, F.posexplode_outer("sections").alias("position", "section"))
        .where(F.col("section") != "")
    )


def _section(name: str) -> Column:
    found = F.get(F.col("sections"), F.lit(SECTIONS.index(name)))
    return F.nullif(found, F.lit(""))


def header_parts(header: Column, fields: Column) -> dict[str, Column]:
    """Raw parts of a header section and its fields, whose number tells if authors are among them."""
    has_doi = F.contains(header, F.lit("DOI:"))
    has_authors = F.size(fields) > F.when(has_doi, 2).otherwise(1)
    return {
        "authors": F.when(has_authors, F.get(fields, F.lit(0))),
        "reference": F.get(fields, F.when(has_authors, 1).otherwise(0)),
        "title": first_element(header, "span", nested=True, cls=BOLD_FIELD),
        "doi": F.when(has_doi, F.get(fields, F.size(fields) - 1)),
    }


def scopus_header(line: Column, compat: bool = False) -> dict[str, Column]:
    """Year, journal, volume, issue and pages of a reference line."""
    text = nbsp_normalise(line)
    if compat:
        parts = F.split(text, ",")
        first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        words = F.split(second, " ")
        numbered = ~F.contains(second, F.lit("p."))
        issue = whitespace_strip(F.get(words, F.lit(2)))
        return {
            "year": F.substring(F.substring_index(first, ")", 1), 2, 2**31 - 1),
            "journal": whitespace_strip(F.get(F.split(first, r"\)"), F.lit(1))),
            "volume": F.when(numbered, F.get(words, F.lit(1))),
            "issue": F.when(
                numbered, F.substring(issue, F.lit(2), F.greatest(F.length(issue) - 2, F.lit(0)))
            ),
            "pages": F.get(F.split(F.element_at(parts, -1), r"\. "), F.lit(1)),
        }

    def found(source: Column, pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(source, pattern, group), F.lit(""))

    head = found(text, _HEAD)
    return {
        "year": found(text, _YEAR),
        "journal": whitespace_strip(F.regexp_replace(head, _VOLUME, "")),
        "volume": found(head, _VOLUME),
        "issue": found(head, _VOLUME, 2),
        "pages": found(text, _PAGES),
    }


def scopus_authors(field: Column) -> Column:
    """One line per author, affiliation marks between double dashes; entities still encoded."""
    marked = F.regexp_replace(field, r"</?sup>", "--")
    return markup_strip(F.replace(marked, F.lit(" , "), F.lit("\n")))


def scopus_affiliations(section: Column) -> Column:
    """Lines between breaks, as an array; entities still encoded.

    What stands before the first break and after the last one is no affiliation.
    """
    marked = F.replace(F.replace(section, F.lit("<sup>"), F.lit("")), F.lit("</sup>"), F.lit("--"))
    lines = F.split(marked, r"<br\s*/?>")
    return F.when(F.size(lines) >= 3, F.slice(lines, F.lit(2), F.size(lines) - 2))


def scopus_citations(section: Column) -> Column:
    """Texts of the spans of each non-empty cell; entities still encoded."""
    cells = F.filter(elements(section, "td", nested=True), lambda cell: F.length(without_tags(cell)) > 0)
    return F.transform(
        cells,
        lambda cell: F.transform(elements(cell, "span", nested=True), without_tags),
    )


def scopus_records(pages: DataFrame, compat: bool = False) -> DataFrame:
    """Pages `(file_name, html)` to records, in one narrow stage.

    Beside the fourteen text columns there are the lists they were joined from, and `problem`, which
    names what could not be read and is null for a sound record.
    """
    blocks = record_sections(record_blocks(pages))
    kept = [c for c in blocks.columns if c not in ("block", "sections")]
    # In steps, so that each part is cut once before anything is derived from it.
    cut = blocks.select(
        *kept,
        F.col("block").isNull().alias("_no_block"),
        text_after(F.col("block"), "Type:").alias("_type"),
        *[_section(name).alias(f"_{name}") for name in SECTIONS],
    ).withColumn("_fields", elements(F.col("_header"), "span", nested=True, cls=FIELD))
    header = header_parts(F.col("_header"), F.col("_fields"))
    raw = cut.select(
        *kept,
        "_no_block",
        F.col("_header").isNotNull().alias("_has_header"),
        F.col("_abstract").isNotNull().alias("_has_abstract"),
        hard_spaces(doc_type(F.col("_type"))).alias("document_type"),
        hard_spaces(scopus_authors(header["authors"])).alias("authors"),
        *[bare_text(header[name]).alias(name) for name in ("reference", "title", "doi")],
        hard_spaces(F.array_join(scopus_affiliations(F.col("_affiliations")), "\n")).alias(
            "affiliations"
        ),
        *[
            bare_text(first_element(F.col(f"_{name}"), "span", nested=True, cls=FIELD)).alias(name)
            for name in ("abstract", "author_keywords", "index_keywords")
        ],
        scopus_citations(F.col("_citations")).alias("_citations"),
    )
    texts = ("authors", "reference", "title", "doi", "abstract", "author_keywords", "index_keywords")
    # All fields of a record go through one expression, as it holds every entity there is.
    every = ("document_type", *texts, "affiliations")
    flat = raw.withColumn("_texts", F.transform(F.array(*every), unescape))
    fields = {name: F.get("_texts", F.lit(i)) for i, name in enumerate(every)}
    decoded = flat.select(
        *kept,
        "_no_block",
        "_has_header",
        "_has_abstract",
        *[fields[name].alias(name) for name in ("document_type", *texts)],
        nbsp_normalise(fields["affiliations"], "").alias("affiliations"),
        F.transform(
            unescape_nested(F.col("_citations")),
            lambda cell: F.transform(cell, lambda span: nbsp_normalise(span)),
        ).alias("citations_list"),
    )
    line = scopus_header(F.col("reference"), compat)
    problem = F.concat_ws(
        "; ",
        F.when(F.col("_no_block"), F.lit("no record on the page")),
        F.when(F.col("document_type").isNull(), F.lit("no document type")),
        F.when(~F.col("_has_header"), F.lit("no header")),
        F.when(F.col("_has_header") & F.col("title").isNull(), F.lit("no title")),
        F.when(
            F.col("_has_header") & (F.col("year").isNull() | F.col("journal").isNull()),
            F.lit("unreadable reference line"),
        ),
        F.when(F.lit(not compat) & F.col("journal").rlike(_UNREAD), F.lit("unreadable volume")),
        F.when(F.col("_has_abstract") & F.col("abstract").isNull(), F.lit("unreadable abstract")),
    )
    return (
        decoded.withColumns(line)
        .withColumns(
            {
                "document_type": F.col("document_type")
                if compat
                else whitespace_strip(F.col("document_type")),
                "citations": F.array_join(
                    F.transform("citations_list", lambda cell: F.array_join(cell, "|")), "--\n"
                ),
                "authors_list": F.split("authors", "\n"),
                "affiliations_list": F.split("affiliations", "\n"),
                "problem": pinned(F.nullif(problem, F.lit(""))),
            }
        )
        .select(
            *kept,
            *RECORD_COLUMNS,
            "authors_list",
            "affiliations_list",
            "citations_list",
            "problem",
        )
    )


def author_rows(records: DataFrame) -> DataFrame:
    """One row per author: `(file_name, record_ordinal, author_position, author, marks)`."""
    parts = F.split(F.col("_line"), "--")
    return _exploded(records, "authors_list", "author_position", "_line").select(
        "file_name",
        "record_ordinal",
        "author_position",
        whitespace_strip(F.get(parts, F.lit(0))).alias("author"),
        F.filter(
            F.transform(pieces_after(parts), whitespace_strip),
            lambda mark: mark != "",
        ).alias("marks"),
    )


def affiliation_rows(records: DataFrame) -> DataFrame:
    """One row per affiliation: `(file_name, record_ordinal, position, affiliation)`."""
    return _exploded(records, "affiliations_list", "position", "affiliation")


def citation_cells(records: DataFrame) -> DataFrame:
    """One row per non-empty cell: `(file_name, record_ordinal, reference_position, cell)`."""
    return _exploded(records, "citations_list", "reference_position", "cell")


def citation_rows(records: DataFrame) -> DataFrame:
    """One row per span: `(file_name, record_ordinal, reference_position, span_position, text)`."""
    return citation_cells(records).select(
        "file_name",
        "record_ordinal",
        "reference_position",
        F.posexplode("cell").alias("span_position", "text"),
    )


def _exploded(records: DataFrame, items: str, position: str, item: str) -> DataFrame:
    # An inner explode lets Spark infer a filter on the list, which would compute the list twice.
    return records.select(
        "file_name", "record_ordinal", F.posexplode_outer(items).alias(position, item)
    ).where(F.col(position).isNotNull())


def split_quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound records, and those with a problem."""
    return (
        records.where(F.col("problem").isNull()).drop("problem"),
        records.where(F.col("problem").isNotNull()),
    )
