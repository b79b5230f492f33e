"""Files in, tables out."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.urls import issue_file_id_b
from shelfmark.operators.citations import BAD_EXPORT, bibtex_parse
from shelfmark.plans.jobs import JobParameters, job_holdings_audit, job_load_citations
from shelfmark.sources import files, sinks
from tests.test_citations import SAMPLE_A, SAMPLE_B
from tests.test_records import FULL

PREFIX = "https://www.jstor.org/stable/10.2307/"


@pytest.fixture
def export_dir(tmp_path):
    folder = tmp_path / "exports"
    (folder / "more").mkdir(parents=True)
    (folder / "i1.txt").write_text(SAMPLE_A, encoding="utf-8", newline="")
    (folder / "more" / "i2.txt").write_text(f"{BAD_EXPORT}\n", encoding="utf-8")
    (folder / "i3.html").write_text("no export", encoding="utf-8")
    return str(folder)


def issue_table(spark, *names):
    rows = [(PREFIX + n, 1950, None, "J", None) for n in names]
    return spark.createDataFrame(rows, schemas.ISSUES)


def test_exports_are_whole_files(spark, export_dir):
    found = {r.file_name: r for r in files.scan_exports(spark, export_dir).collect()}
    assert found.keys() == {"i1.txt", "i2.txt"}
    assert found["i1.txt"].value == SAMPLE_A
    assert found["i1.txt"].issue_url == PREFIX + "i1"


def test_html_exports(spark, tmp_path):
    (tmp_path / "a.html").write_text(FULL, encoding="utf-8")
    (tmp_path / "a.txt").write_text("x", encoding="utf-8")
    [row] = files.scan_html_exports(spark, str(tmp_path)).collect()
    assert (row.file_name, row.html) == ("a.html", FULL)


def test_holdings_listing_reads_no_content(spark, tmp_path):
    for name in ("1.pdf", "2.pdf", "3.txt", "Citations_1.bib", "other.bib"):
        (tmp_path / name).write_text("12345")
    listing = files.scan_holdings(spark, str(tmp_path))
    assert sorted((r.name, r.length) for r in listing.collect()) == [("1.pdf", 5), ("2.pdf", 5)]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    named = files.scan_holdings(spark, str(tmp_path), "*.bib", contains="Citations_")
    assert [r.name for r in named.collect()] == ["Citations_1.bib"]


def test_file_names_with_special_characters(spark, tmp_path):
    names = {"a b.pdf", "c+d.pdf", "e%20f.pdf", "g?h.pdf", "é.pdf"}
    for name in names:
        (tmp_path / name).write_text("x")
        (tmp_path / name.replace("pdf", "txt")).write_text("x")
    assert {r.name for r in files.scan_holdings(spark, str(tmp_path)).collect()} == names
    exports = files.scan_exports(spark, str(tmp_path)).collect()
    assert {r.file_name.replace("txt", "pdf") for r in exports} == names


def test_remote_manifest(spark, tmp_path):
    rows = [("1.pdf", "a", "application/pdf"), ("f", "b", "folder")]
    spark.createDataFrame(rows, schemas.REMOTE_HOLDINGS).write.parquet(str(tmp_path / "m"))
    found = files.scan_remote_holdings(spark, str(tmp_path / "m"), mime_type="folder")
    assert [r.id for r in found.collect()] == ["b"]


def test_journal_list_with_byte_order_mark(spark, tmp_path):
    listed = {"masterlist": [{schemas.JOURNAL_KEY: n} for n in ("A, Press ", "B", "A, Press")]}
    path = tmp_path / "list.json"
    path.write_text(json.dumps(listed, indent=4), encoding="utf-8-sig")
    found = files.scan_journal_list(spark, str(path)).collect()
    assert [(r.position, r.journal) for r in found] == [(0, "A, Press"), (1, "B"), (2, "A, Press")]


def test_older_article_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("issue_url,stable_url,year\ni,u1,1950\n")
    (tmp_path / "b.csv").write_text("issue_url,URL,stable_url\ni,,u2\n")
    assert files.scan_articles_csv(spark, str(tmp_path / "a.csv")).first().url == "u1"
    assert files.scan_articles_csv(spark, str(tmp_path / "b.csv")).first().url == "u2"
    (tmp_path / "c.csv").write_text("issue_url\ni\n")
    with pytest.raises(ValueError):
        files.scan_articles_csv(spark, str(tmp_path / "c.csv"))


def test_issue_of_a_file_whose_name_cannot_be_reversed(spark):
    base = "https://www.sciencedirect.com/journal/"
    issues = spark.createDataFrame([(base + "j/vol/1",), (base + "j/vol/2",)], "issue_url string")
    exports = spark.createDataFrame(
        [("j_vol_1.bib", None, SAMPLE_B), ("other.bib", None, SAMPLE_B)], schemas.EXPORTS
    )
    articles = files.assign_issue(
        bibtex_parse(exports, "b"), issues, issue_file_id_b(F.col("issue_url"))
    )
    assert {(r.issue_url, r.title) for r in articles.collect()} == {
        (base + "j/vol/1", "T X"),
        (base + "j/vol/1", "U"),
    }


def test_load_and_gated_publication(spark, export_dir, tmp_path):
    exports = files.scan_exports(spark, export_dir)
    target, staging = str(tmp_path / "articles"), str(tmp_path / "staging")
    both = issue_table(spark, "i1", "i2")
    load = job_load_citations(exports, both)
    assert [r.file_name for r in load.rejected.collect()] == ["i2.txt"]
    assert [r.issue_url for r in load.missing.collect()] == [PREFIX + "i2"]

    result = sinks.sink_articles(load.articles, both, target, staging)
    assert (result.complete, result.missing, result.issues_with_articles) == (False, 1, 1)
    assert not (tmp_path / "articles").exists()

    result = sinks.sink_articles(load.articles, issue_table(spark, "i1"), target, staging)
    assert result.complete and result.complete_by_count
    published = files.scan_articles(spark, target)
    assert published.schema == schemas.ARTICLES
    assert published.count() == 2

    # A publication that fails leaves the old table.
    with pytest.raises(OSError):
        sinks.publish(spark, str(tmp_path / "nothing"), target)
    assert files.scan_articles(spark, target).count() == 2

    # A repeated issue row does no harm, unless rows are counted.
    twice = issue_table(spark, "i1", "i1")
    assert sinks.sink_articles(load.articles, twice, target, staging).complete
    counted = sinks.sink_articles(load.articles, twice, target, staging, compat=True)
    assert not counted.complete_by_count


def test_issues_and_records_and_reports(spark, tmp_path):
    issues = issue_table(spark, "i1", "i2")
    sinks.sink_issues(issues, str(tmp_path / "issues"))
    stored = files.scan_issues(spark, str(tmp_path / "issues"))
    assert stored.schema == schemas.ISSUES

    pages = spark.createDataFrame([("p.html", FULL)], "file_name string, html string")
    from shelfmark.operators.records import scopus_records

    records = scopus_records(pages)
    sinks.sink_records(records, str(tmp_path / "records"))
    assert spark.read.parquet(str(tmp_path / "records")).first().citations_list == [
        ["R1", "a b"],
        ["R2 &"],
    ]
    sinks.sink_records(records, str(tmp_path / "csv"), "csv")
    flat = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"').first()
    assert (flat.title, flat.authors) == ("Title <1>", "A, B.--a--\nC & D.--b--")

    articles = spark.createDataFrame(
        [(PREFIX + "i1", "https://x/1", 1950)], "issue_url string, url string, year int"
    )
    held = spark.createDataFrame([("1.pdf",)], "name string")
    audit = job_holdings_audit(stored, articles, held)
    sinks.sink_report(audit.per_issue, str(tmp_path / "report"), 1940)
    totals = spark.read.parquet(str(tmp_path / "report" / "totals")).first()
    assert (totals.held_total, totals.expected_since) == (1, 1)


def test_parameters(tmp_path):
    path = tmp_path / "inputs.json"
    path.write_text('{"start_year": 1946, "end_year": 2012, "pivot_scrape_indicator": 1, "x": 2}')
    parameters = JobParameters.read(str(path))
    assert (parameters.start_year, parameters.end_year) == (1946, 2012)
    assert parameters.pivot_scrape_indicator is True
    path.write_text('{"year": 1992}')
    assert JobParameters.read(str(path)).end_year == 1992


def test_csv_goes_by_its_header(spark, tmp_path):
    (tmp_path / "issues.csv").write_text('year,issue_url,Jstor_issue_text,journal\n1946.0,i,"No. 1, May",J\n')
    row = files.scan_issues(spark, str(tmp_path / "issues.csv"), "csv").first()
    assert row.asDict() == {
        "issue_url": "i", "year": 1946, "issue_text": "No. 1, May", "journal": "J", "no_docs": None,
    }
    (tmp_path / "articles.csv").write_text("issue_url,URL,year\ni,u,1946.0\ni,v,in press\n")
    articles = files.scan_articles(spark, str(tmp_path / "articles.csv"), "csv")
    assert [r.url for r in articles.where("year between 1946 and 1950").collect()] == ["u"]
    (tmp_path / "bad.csv").write_text("year,journal\n1946,J\n")
    with pytest.raises(ValueError):
        files.scan_issues(spark, str(tmp_path / "bad.csv"), "csv")


def test_csv_keeps_nested_columns(spark, tmp_path):
    exports = spark.createDataFrame([("f.txt", "i", "@article{k,\n mail = {x},\n title = {T}\n}")], schemas.EXPORTS)
    articles = bibtex_parse(exports)
    sinks.write_table(articles, str(tmp_path / "csv"), "csv")
    stored = files.scan_table(spark, str(tmp_path / "csv"), schemas.ARTICLES, "csv").first()
    assert (stored.title, stored.extra, stored.record_ordinal) == ("T", {"mail": "x"}, 0)


def test_files_of_no_issue_or_of_several(spark):
    issues = spark.createDataFrame([("a",), ("b",), ("B",)], "issue_url string")
    exports = spark.createDataFrame([(n, None, "x") for n in ("a", "b", "c")], schemas.EXPORTS)
    named = files.named_issue(exports, issues, F.lower("issue_url"))
    found = {(r.file_name, r.issue_url, r.problem) for r in named.collect()}
    assert found == {("a", "a", None), ("b", None, "several issues"), ("c", None, "no issue")}
