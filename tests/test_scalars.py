"""Column functions on literal inputs."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import entities, text, urls

CASES = [
    (urls.issue_file_id_a, "https://www.jstor.org/stable/10.2307/i123", "i123.txt"),
    (urls.issue_file_id_a, "https://other.org/x", "https://other.org/x.txt"),
    (
        urls.issue_file_id_b,
        "https://www.sciencedirect.com/journal/j/vol/1/issue/2",
        "j_vol_1_issue_2.bib",
    ),
    (urls.issue_url_of_file_a, "i1.txt", "https://www.jstor.org/stable/10.2307/i1"),
    (urls.pdf_name, "https://x/stable/354", "354.pdf"),
    (urls.pdf_name, "a/b/", ".pdf"),
    (urls.pdf_name, None, None),
    (urls.doi_normalise, "https://www.jstor.org/stable/354", "10.2307/354"),
    (urls.doi_normalise, "https://www.jstor.org/stable/10.1086/12", "10.1086/12"),
    (urls.doi_suffix, "10.23456/a/b", "b"),
    (lambda c: urls.doi_suffix(c, compat=True), "10.2307/354", "354"),
    (lambda c: urls.doi_suffix(c, compat=True), "10.23456/a/b", "/a/b"),
    (urls.url_host, "https://h.x/y", "h.x"),
    (urls.url_host, "abc", None),
    (urls.url_host, "http://h.x/y", None),
    (lambda c: urls.url_rehost(c, F.lit("L")), "http://a.b/c?u=https://d.e/f", "https://L/c?u=https://L/f"),
    (lambda c: urls.url_rehost(c, F.lit(r"p$1\2")), "http://a.b/c", r"https://p$1\2/c"),
    (urls.url_absolutise, "/stable/i1", "https://www.jstor.org/stable/i1"),
    (urls.download_filename, "//h/d/file.pdf?download=true", "file.pdf"),
    (urls.download_filename, "d/?download=true", ""),
    (urls.download_filename, "//h/d/file.pdf", None),
    (urls.attr_slice, "location.href='//h/f.pdf'", "//h/f.pdf"),
    (urls.attr_slice, "short", ""),
    (text.newline_strip, "a\r\nb\nc\rd", "abcd"),
    (text.nbsp_normalise, "a b", "a b"),
    (lambda c: text.nbsp_normalise(c, ""), "a b", "ab"),
    (text.markup_strip, "a<b>c</b><>d<e\n>f", "ac" + "<>d<e\n>f"),
    (text.whitespace_strip, "\t \x1f a b　\r\n", "a b"),
    (text.whitespace_strip, " \n ", ""),
    (text.doc_type, "Document Type: Article Publication Stage", " Article "),
    (text.doc_type, "Type:Publication", ""),
    (text.doc_type, "Type: a\nPublication", None),
    (text.year_cast, " 1946 ", 1946),
    (text.year_cast, "1946.0", 1946),
    (text.year_cast, "1946.5", None),
    (text.year_cast, "in press", None),
    (text.year_cast, "99999999999", None),
    (text.year_from_status, "Pages 1-9 (April 2020)", "2020"),
    (text.year_from_status, "2020", "202"),
    (text.year_from_status, "", ""),
    (entities.unescape, "a &amp; b&nbsp;&eacute;&#8212;&lt;", "a & b é—<"),
    (entities.unescape, "&amp;nbsp;", "&nbsp;"),
    (entities.unescape, "plain", "plain"),
    (entities.unescape, None, None),
]


@pytest.mark.parametrize("function, given, expected", CASES)
def test_column_function(evaluate, function, given, expected):
    assert evaluate(function, given) == expected


def test_issue_label(evaluate):
    assert evaluate(text.issue_label, "April 2020", "Vol 1") == "April 2020__Vol 1"


def test_nested_entities(spark):
    row = spark.range(1).select(
        entities.unescape_nested(
            F.array(F.array(F.lit("a&amp;b"), F.lit(None)), F.array(F.lit("c")))
        ).alias("x")
    )
    assert row.first().x == [["a&b", None], ["c"]]
