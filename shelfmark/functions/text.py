"""Column functions on plain text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What str.strip() removes. All such characters lie below U+3001.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
NBSP = "\u00a0"
# Longer than any array of pieces a string can be split into, short enough to add to.
ALL_REST = 2**30


def without(text: Column, *marks: str) -> Column:
    """Drop fixed texts. `translate` would look up every character; this is a byte search."""
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def pieces_after(pieces: Column, skipped: int = 1) -> Column:
    """The array without its first items; mentions `pieces` once, so it is computed once."""
    return F.slice(pieces, F.lit(skipped + 1), F.lit(ALL_REST))


def let(value: Column, use) -> Column:
    """`use(value)`, with `value` computed once per row also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def whitespace_strip(text: Column) -> Column:
    """Trim Unicode white space; SQL trim alone takes only the space character."""
    return F.btrim(text, F.lit(WHITESPACE))


def newline_strip(text: Column) -> Column:
    """Join lines: CR and LF go, nothing takes their place."""
    return without(text, "\r", "\n")


def nbsp_normalise(text: Column, to: str = " ") -> Column:
    return F.replace(text, F.lit(NBSP), F.lit(to))


def markup_strip(text: Column) -> Column:
    """Drop tags that open and close on one line."""
    return F.regexp_replace(text, r"<[^\n]+?>", "")


def doc_type(text: Column) -> Column:
    """What stands between `Type:` and `Publication`; null where they are not on one line."""
    return F.get(F.regexp_extract_all(text, F.lit(r"Type:([^\n]*?)Publication"), F.lit(1)), F.lit(0))


def issue_label(status: Column, link_text: Column) -> Column:
    return F.concat(status, F.lit("__"), link_text)


def year_cast(text: Column) -> Column:
    """Text to a year; null where it is none. `1946.0`, as spreadsheets write it, counts as 1946."""
    digits = F.regexp_extract(whitespace_strip(text), r"^([+-]?\d+)(?:\.0+)?$", 1)
    return digits.try_cast("int")


def year_from_status(status: Column) -> Column:
    """The four characters before the last one of the last word: `(April 2020)` gives 2020."""
    return F.substring(F.substring_index(status, " ", -1), -5, 4)


def hard_spaces(text: Column) -> Column:
    """Decode the commonest entity in place, which spares most text the search for others."""
    return F.replace(text, F.lit("&nbsp;"), F.lit(NBSP))


def pinned(column: Column) -> Column:
    """The same value, but a filter on it stays above the projection that computes it.

    Spark would otherwise copy the whole expression below, and evaluate it twice.
    """
    return F.when(F.spark_partition_id() >= 0, column)
