"""Result pages to records."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import records as ops
from shelfmark.plans.jobs import job_load_records

SECTION = '<div class="margin: 0px 0px 13px 0px">'
TAIL = "Document Type: Article Publication Stage: Final</div>"
HEADER = (
    f'{SECTION}<span class="txt">A, B.<sup>a</sup> , C &amp; D.<sup>b</sup></span>'
    '<span class="txtBold">Title &lt;1&gt;</span>'
    '<span class="txt">(2019) RES, 86 (3), pp. 1-2. </span>DOI: <span class="txt">10.1/x</span></div>'
)
FULL = (
    f'<div class="container">{HEADER}'
    f"{SECTION}Affiliations:<br/><sup>a</sup>&nbsp;U1 &amp; Co<br><sup>b</sup>&nbsp;U2<br/></div>"
    f'{SECTION}<div>x</div><span class="txt">Abs &eacute;</span></div>'
    f'{SECTION}<span class="txt">k1; k2</span></div>{SECTION}</div>'
    f"{SECTION}<table><tr><td><span>R1</span><span>a&nbsp;b</span></td><td></td>"
    f"<td><span>R2 &amp;</span></td></tr></table></div>{TAIL}"
)


def load(spark, html, compat=False):
    pages = spark.createDataFrame([("p.html", html)], "file_name string, html string")
    return ops.scopus_records(pages, compat)


def test_full_record(spark):
    [row] = load(spark, FULL).collect()
    assert row.asDict() == {
        "file_name": "p.html",
        "record_ordinal": 0,
        "authors": "A, B.--a--\nC & D.--b--",
        "title": "Title <1>",
        "journal": "RES",
        "volume": "86",
        "issue": "3",
        "year": "2019",
        "pages": "1-2",
        "doi": "10.1/x",
        "affiliations": "a--U1 & Co\nb--U2",
        "abstract": "Abs é",
        "citations": "R1|a b--\nR2 &",
        "document_type": "Article",
        "index_keywords": None,
        "author_keywords": "k1; k2",
        "authors_list": ["A, B.--a--", "C & D.--b--"],
        "affiliations_list": ["a--U1 & Co", "b--U2"],
        "citations_list": [["R1", "a b"], ["R2 &"]],
        "problem": None,
    }


def test_document_type_is_not_trimmed_with_compat(spark):
    assert load(spark, FULL, compat=True).first().document_type == " Article "


@pytest.mark.parametrize(
    "header, authors, doi",
    [
        ('<span class="txt">A.</span><span class="txt">(1999) J, 1, pp. 2-3. </span>', "A.", None),
        ('<span class="txt">(1999) J, 1, pp. 2-3. </span>', None, None),
        (
            '<span class="txt">(1999) J, 1, pp. 2-3. </span>DOI: <span class="txt">10.1/y</span>',
            None,
            "10.1/y",
        ),
    ],
)
def test_number_of_fields_tells_if_there_are_authors(spark, header, authors, doi):
    html = f'<div class="container">{SECTION}<span class="txtBold">T</span>{header}</div>{TAIL}'
    [row] = load(spark, html).collect()
    assert (row.authors, row.doi, row.journal, row.pages) == (authors, doi, "J", "2-3")


def test_rows_of_authors_and_citations(spark):
    records = load(spark, FULL)
    authors = [(r.author_position, r.author, r.marks) for r in ops.author_rows(records).collect()]
    assert authors == [(0, "A, B.", ["a"]), (1, "C & D.", ["b"])]
    spans = [
        (r.reference_position, r.span_position, r.text) for r in ops.citation_rows(records).collect()
    ]
    assert spans == [(0, 0, "R1"), (0, 1, "a b"), (1, 0, "R2 &")]


def test_few_breaks_give_no_affiliation(spark):
    html = f'<div class="container">{HEADER}{SECTION}Affiliations: none<br/></div>{TAIL}'
    assert load(spark, html).first().affiliations is None


def test_quarantine(spark):
    broken = f'<div class="container">{SECTION}<span class="txtBold">T</span><span class="txt">no line</span></div></div>'
    pages = spark.createDataFrame(
        [("p.html", FULL + broken + FULL)], "file_name string, html string"
    )
    result = job_load_records(pages)
    assert [r.record_ordinal for r in result.records.orderBy("record_ordinal").collect()] == [0, 2]
    [bad] = result.quarantined.collect()
    assert (bad.record_ordinal, bad.title) == (1, "T")
    assert bad.problem == "no document type; unreadable reference line"


def test_single_quotes_and_nested_fields(spark):
    html = FULL.replace('"', "'").replace("Abs &eacute;", "A <span class='txt'>in</span> out")
    [row] = load(spark, html).collect()
    assert (row.title, row.journal, row.doi, row.problem) == ("Title <1>", "RES", "10.1/x", None)
    assert row.abstract == "A in out"


def test_a_page_without_records_is_quarantined(spark):
    for html in ("<p>Try later</p>", "", None):
        [bad] = load(spark, html).collect()
        assert bad.record_ordinal == 0 and bad.problem.startswith("no record on the page")


def test_a_volume_that_is_not_read_is_quarantined(spark):
    [bad] = load(spark, FULL.replace("86 (3)", "86 Suppl. x 3")).collect()
    assert bad.problem == "unreadable volume"


def test_a_filter_does_not_parse_twice(spark):
    """The filter on `problem` stays above the projection, so entities are decoded once."""
    pages = spark.createDataFrame([("p.html", FULL)], "file_name string, html string")
    plan = job_load_records(pages).records._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("transform(" in line or "regexp" in line for line in filters)


LINES = [
    (
        "(2011) RES, Suppl (3), pp. 1-2",
        ("2011", "RES", "Suppl", "3", "1-2"),
        ("2011", "RES", "Suppl", "3", "1-2"),
    ),
    (
        "(2019) Review of Economic Studies, 86 (3), pp. 1001-1034. Cited 3 times. ",
        ("2019", "Review of Economic Studies", "86", "3", "1001-1034"),
        ("2019", "Review of Economic Studies", "86", "3", "1001-1034"),
    ),
    (
        "(1950) Econ J, pp. 1-2. ",
        ("1950", "Econ J", None, None, "1-2"),
        ("1950", "Econ J", None, None, "1-2"),
    ),
    (
        "(2001) R, 68 , pp. 5-6. ",
        ("2001", "R", "68", None, "5-6"),
        ("2001", "R", "68", "", "5-6"),
    ),
    (
        "(2005) Energy, Policy, and Law (London), 12 (2), pp. 3-4. ",
        ("2005", "Energy, Policy, and Law (London)", "12", "2", "3-4"),
        ("2005", "Energy", "Policy", None, "3-4"),
    ),
    (
        "(2010) J X, 5 (1-2), art. no. 17, . ",
        ("2010", "J X", "5", "1-2", None),
        ("2010", "J X", "5", "1-2", ""),
    ),
]


@pytest.mark.parametrize("line, strict, literal", LINES)
def test_reference_line(spark, line, strict, literal):
    names = ("year", "journal", "volume", "issue", "pages")
    row = spark.createDataFrame([(line,)], "line string")
    for compat, expected in ((False, strict), (True, literal)):
        found = row.select(
            *[c.alias(n) for n, c in ops.scopus_header(F.col("line"), compat).items()]
        ).first()
        assert tuple(found[n] for n in names) == expected


def test_no_python_in_the_load(spark):
    pages = spark.createDataFrame([("p.html", FULL)], "file_name string, html string")
    plan = job_load_records(pages).records._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
